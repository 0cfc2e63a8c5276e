"""Shared storage of the cluster for intermediate tables and files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabforge.session import ensure_checkpoint_dir


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder (spark.checkpoint.dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends
    there, and the table survives the loss of any executor."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, on: list[str], rows: int) -> DataFrame:
    """The ``rows`` rows of ``df`` with the smallest hash of the columns ``on`` (all, if fewer).
    A threshold from the row count drops most others first, so that each partition does not send
    ``rows`` rows of its own: about twice ``rows`` move, however many partitions there are."""
    place = F.pmod(F.xxhash64(*on), F.lit(1 << 32))
    n = df.count()
    if n > 4 * rows:
        df = df.where(place < F.lit(int((1 << 32) * 2 * rows / n)))
    return df.orderBy(place, *on).limit(rows)


def salted_join(left: DataFrame, right: DataFrame, on: str, by: Column | str, how: str, salts: int = 32) -> DataFrame:
    """Join on ``on`` where many rows of ``left`` may share a key: they are dealt by a hash of
    ``by`` over ``salts`` copies of ``right`` (few rows)."""
    left = left.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    return left.join(right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), [on, "salt"], how).drop("salt")
