"""Every block of queries against every block of donors, without copies of rows.

Both sides are packed into pages (Arrow batches of at most ``PAGE_BYTES``) and stored once in the
shared folder. A cartesian product of the two page tables hands each task one part of either side,
which it reads from there: nothing is shuffled or written per pair of blocks, and a task holds at
most ``SIDE_BYTES`` of donors. The task takes its queries through the donor pages one after the
other and keeps the best found so far, so it emits one short list per query.

A page knows the range of its groups and the range of one coordinate (for queries: what they can
reach), and pages whose ranges do not meet are not handed over."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

PAGE_BYTES = 8 << 20
SIDE_BYTES = 128 << 20
#: Tasks a core, and the fewest queries that are worth a task.
TASKS, FEWEST = 4, 256
_META = "page long, glo long, ghi long, lo double, hi double, data binary"


def _pack(rows: int):
    """Arrow batches with __gh, __lo and __hi -> pages of at most ``rows`` rows of the other columns."""
    import pyarrow.compute as pc

    def page(held: list, number: int) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ends = [pc.min(t["__gh"]), pc.max(t["__gh"]), pc.min(t["__lo"]), pc.max(t["__hi"])]
        t = t.drop_columns(["__gh", "__lo", "__hi"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, t.schema) as out:
            out.write_table(t)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *[pa.array([e.as_py()], k) for e, k in zip(ends, kinds)],
             pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["page", "glo", "ghi", "lo", "hi", "data"])

    def run(batches):
        held, n, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, rows - n)
                batch = batch.slice(some.num_rows)
                held.append(some)
                n += some.num_rows
                if n == rows:
                    yield page(held, number)
                    held, n, number = [], 0, number + 1
        if held:
            yield page(held, number)
    return run


def _paged(df: DataFrame, order: list, rows: int, parts: int) -> DataFrame:
    by = ["__gh", *order, F.xxhash64("__id")]
    spread = df.repartitionByRange(parts, *by).sortWithinPartitions(*by) if parts > 1 else df.coalesce(1).sortWithinPartitions(*by)
    return cut_lineage(spread.mapInArrow(_pack(rows), _META))


def _ready(df: DataFrame) -> DataFrame:
    add = {"__gh": F.xxhash64("__g") if "__g" in df.columns else F.lit(0).cast("long")}
    add |= {c: F.lit(0.0) for c in ("__lo", "__hi") if c not in df.columns}
    return df.withColumns(add)


def meet(queries: DataFrame, donors: DataFrame, row_bytes: int, state: Callable, schema: str, order: list = ()) -> DataFrame:
    """``queries`` and ``donors`` with __id and optionally __g and a range __lo, __hi of each row.

    ``state(query table)`` is made once per page of queries; its ``meet(donor table)`` is called for
    each page of donors that can matter, and ``result()`` gives the rows (pandas, ``schema``) of the
    page. Rows lie in pages by group, then by the columns ``order``."""
    nq, nd = queries.count(), donors.count()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    most = max(1, PAGE_BYTES // row_bytes)
    d_parts = max(1, math.ceil(nd * row_bytes / SIDE_BYTES))
    q_parts = max(math.ceil(nq * row_bytes / SIDE_BYTES), min(math.ceil(nq / FEWEST), math.ceil(TASKS * cores / d_parts)), 1)
    q = _paged(_ready(queries), list(order), max(1, min(most, math.ceil(nq / q_parts))), q_parts)
    d = _paged(_ready(donors), list(order), most, d_parts)
    q = q.select(*[F.col(c).alias(f"q_{c}") for c in q.columns])
    both = q.join(d.hint("shuffle_replicate_nl"), (F.col("glo") <= F.col("q_ghi")) & (F.col("ghi") >= F.col("q_glo"))
                  & (F.col("lo") <= F.col("q_hi")) & (F.col("hi") >= F.col("q_lo")))

    def table(scalar) -> pa.Table:
        return pa.ipc.open_stream(scalar.as_buffer()).read_all()

    def run(batches):
        page = held = None
        for batch in batches:
            for i in range(batch.num_rows):
                p = batch.column(0)[i].as_py()
                if p != page:
                    if held is not None:
                        yield pa.RecordBatch.from_pandas(held.result(), preserve_index=False)
                    page, held = p, state(table(batch.column(1)[i]))
                held.meet(table(batch.column(2)[i]))
        if held is not None:
            yield pa.RecordBatch.from_pandas(held.result(), preserve_index=False)
    return both.select("q_page", "q_data", "data").mapInArrow(run, schema)
