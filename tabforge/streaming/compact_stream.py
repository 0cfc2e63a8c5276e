"""Incremental history compaction (S-12) with Structured Streaming.

A ``binaryFile`` stream over the delta folder tracks which files were seen
(its checkpoint replaces deleting the deltas); only the ``path`` column is
selected, so file contents are not shipped through the stream. Each
micro-batch groups its new files by header and appends them to the history
through the batch routine. ``foreachBatch`` is at-least-once, so each batch id
is written under its own folder and a replayed id overwrites itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.sources.history import read_deltas
from tabforge.sources.stage import exists


def compact_history_stream(spark: SparkSession, folder: str, checkpoint: str, history: str | None = None,
                           max_files_per_trigger: int = 1000):
    """Run to completion on what is there now (``availableNow``); returns the
    history DataFrame (all appended batches, values as CSV text)."""
    history = history or f"{folder}/_stream_history"
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.csv")
              .option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(folder)
              .select("path").where(~F.col("path").endswith("/history.csv")))

    import hashlib
    stream_id = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]  # batch ids restart per checkpoint

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r[0] for r in batch.collect())  # file names of one micro-batch
        if not files:
            return
        # CSV text kept as is: batches never disagree on a type; cast on read
        rows = read_deltas(batch.sparkSession, files, infer=False)
        rows.write.mode("overwrite").parquet(f"{history}/stream={stream_id}/batch={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_history(spark, history)


def read_history(spark: SparkSession, history: str) -> DataFrame | None:
    """All appended batches; None before the first one. Read errors are raised."""
    if not exists(spark, history):
        return None
    return spark.read.option("mergeSchema", True).parquet(history).drop("stream", "batch")
