"""Profiling (A-01 ... A-09). Each profile is one aggregate pass over all
columns, emitted as a long (metric, value) table so that it can be appended to
the run log without a schema change."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.clean import NUMERIC_TYPES

# Wide tables are profiled in chunks so that one aggregate stays a sane size.
AGG_CHUNK = 400


def _chunks(items: list, n: int = AGG_CHUNK):
    for i in range(0, len(items), n):
        yield items[i:i + n]


def _long(df_wide: DataFrame, names: list[str], value_type: str = "double") -> DataFrame:
    """One-row wide aggregate -> (metric, value) rows via ``stack``."""
    if not names:
        return df_wide.sparkSession.createDataFrame([], f"metric string, value {value_type}")
    args = ", ".join(f"'{n}', CAST(`{n}` AS {value_type})" for n in names)
    return df_wide.selectExpr(f"stack({len(names)}, {args}) AS (metric, value)")


# A-01 + A-02
def profile(df: DataFrame) -> DataFrame:
    """``dataframe rows`` and ``missing.{col}`` for columns holding a NULL."""
    exprs = [F.count(F.lit(1)).alias("dataframe rows")]
    exprs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"missing.{c}") for c in df.columns]
    wide = df.agg(*exprs)
    names = ["dataframe rows"] + [f"missing.{c}" for c in df.columns]
    out = _long(wide, names, "bigint")
    return out.where((F.col("metric") == "dataframe rows") | (F.col("value") > 0))


def null_counts(df: DataFrame) -> DataFrame:
    return profile(df).where(F.col("metric") != "dataframe rows")


# A-03
def schema_report(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string")


# A-04
def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by key: a distributed TakeOrdered, not a sort."""
    return df.orderBy(F.col(key)).limit(n)


# A-05
def column_means(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    parts = []
    for chunk in _chunks(cols):
        wide = df.agg(*[F.avg(F.col(f"`{c}`")).alias(f"stats.{c}_mean") for c in chunk])
        parts.append(_long(wide, [f"stats.{c}_mean" for c in chunk]))
    return _union(parts, df, "metric string, value double")


# A-06
def column_modes(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Most frequent value per categorical column, smallest value on ties.

    Unpivot to (column, value), count per pair with map-side combine, then pick
    per column: a hot value only grows one counter, never one task's input."""
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    if not cols:
        return df.sparkSession.createDataFrame([], "metric string, value string")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.column", "kv.value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("value"))
    return best.select(F.concat(F.lit("stats."), F.col("column"), F.lit("_mode")).alias("metric"), "value")


def _union(parts: list[DataFrame], df: DataFrame, schema: str) -> DataFrame:
    if not parts:
        return df.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# A-07
def dtype_histogram(df: DataFrame, prefix: str) -> DataFrame:
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        k = f.dataType.simpleString()
        counts[k] = counts.get(k, 0) + 1
    rows = [(f"dtypes.{prefix}.{k}", v) for k, v in sorted(counts.items())]
    return df.sparkSession.createDataFrame(rows, "metric string, value bigint")


# A-08
def class_counts(df: DataFrame, fold: str = "fold", label: str = "label") -> DataFrame:
    """``y_{fold}_{class}`` -> count."""
    g = df.groupBy(fold, label).agg(F.count(F.lit(1)).alias("value"))
    return g.select(F.concat(F.lit("y_"), F.col(fold), F.lit("_"), F.col(label).cast("string")).alias("metric"),
                    "value")
