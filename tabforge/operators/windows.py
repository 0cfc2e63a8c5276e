"""Ordered operators (W-01 ... W-05).

Running sums and lags over a whole table or over groups never use a window
whose partition is a whole group: rows are range-partitioned by
(group, order, key) and each task works on its slice. Only the group that
crosses from one slice into the next needs state from outside, so one row per
slice is collected and one carried value per slice is broadcast; the number of
groups does not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

_PID, _POS = "__tf_pid", "__tf_pos"


def _ranged(df: DataFrame, keys: list[str], num_partitions: int | None = None) -> DataFrame:
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = (df.repartitionByRange(n, *[F.col(k) for k in keys])
                .sortWithinPartitions(*[F.col(k) for k in keys])
                .withColumn(_POS, F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)  # counts and rows must see one layout
    pid = F.shiftright(F.col(_POS), 33)
    return ranged.withColumn(_PID, pid)


def slice_edges(ranged: DataFrame, gcols: list[str], agg) -> list[tuple]:
    """(slice, first group, last group, ``agg`` over the last group's rows) of each slice, in order."""
    g = F.struct(*[F.col(f"`{c}`") for c in gcols]) if gcols else F.struct(F.lit(0).alias("all"))
    per = ranged.groupBy(_PID, g.alias("__tf_g")).agg(agg.alias("t"), F.min(_POS).alias("a"), F.max(_POS).alias("z"))
    edges = per.groupBy(_PID).agg(F.min_by("__tf_g", "a").alias("fg"), F.max_by("__tf_g", "z").alias("lg"),
                                  F.max_by(F.struct("t"), "z").alias("last"))
    return [(r[_PID], r["fg"], r["lg"], r["last"]["t"]) for r in sorted(edges.collect(), key=lambda r: r[_PID])]


def _carried(ranged: DataFrame, gcols: list[str], rows: list[tuple], kind: str) -> DataFrame:
    """Add ``__tf_carry``: the value of ``rows`` (slice, value) on the rows of the slice's first
    group, NULL elsewhere. ``rows`` has at most one entry per slice."""
    carry = ranged.sparkSession.createDataFrame(rows, f"__tf_slice bigint, __tf_value {kind}")
    first = Window.partitionBy(_PID).orderBy(_POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = ranged.join(F.broadcast(carry), F.col(_PID) == F.col("__tf_slice"), "left")
    same = F.lit(True)
    if gcols:
        g = F.struct(*[F.col(f"`{c}`") for c in gcols])
        same = g.eqNullSafe(F.first(g).over(first))
    return j.withColumn("__tf_carry", F.when(same, F.col("__tf_value"))).drop("__tf_slice", "__tf_value")


def cumulative_sum(df: DataFrame, value: str, order, out: str | None = None, group: str | None = None,
                   key: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Running total of ``value`` by ``order`` (within ``group``); NULL rows stay
    NULL and are skipped by the total (the primitive's contract)."""
    out = out or f"CUM_SUM({value})"
    order_cols = [order] if isinstance(order, str) else list(order)
    if key and key not in order_cols:
        order_cols = order_cols + [key]
    gcols = [group] if group else []
    ranged = _ranged(df, gcols + order_cols, num_partitions)
    x = F.col(f"`{value}`")
    rows, last_group, run = [], None, 0.0
    for pid, fg, lg, total in slice_edges(ranged, gcols, F.sum(x)):
        carry = run if rows and fg == last_group else 0.0
        rows.append((pid, float(carry)))
        run = (carry if fg == lg else 0.0) + float(total or 0.0)
        last_group = lg
    j = _carried(ranged, gcols, rows, "double")
    w = (Window.partitionBy(_PID, *gcols).orderBy(_POS)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = F.coalesce(F.sum(x).over(w), F.lit(0.0)) + F.coalesce("__tf_carry", F.lit(0.0))
    res = j.withColumn(out, F.when(x.isNotNull(), running))
    return res.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{out}`"))


def percent_change(df: DataFrame, value: str, order, out: str | None = None, group: str | None = None,
                   key: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """(x - previous x) / previous x by ``order`` within ``group``; NULL when
    there is no previous row, or it is NULL or 0."""
    out = out or f"PERCENT_CHANGE({value})"
    order_cols = [order] if isinstance(order, str) else list(order)
    if key and key not in order_cols:
        order_cols = order_cols + [key]
    gcols = [group] if group else []
    ranged = _ranged(df, gcols + order_cols, num_partitions)
    x = F.col(f"`{value}`")
    # the last value of each slice, handed to the next slice if its first group goes on
    rows, before = [], None
    for pid, fg, lg, last in slice_edges(ranged, gcols, F.max_by(x, F.col(_POS))):
        if before is not None and before[0] == fg:
            rows.append((pid, None if before[1] is None else float(before[1])))
        before = (lg, last)
    j = _carried(ranged, gcols, rows, "double")
    w = Window.partitionBy(_PID, *gcols).orderBy(_POS)
    first = F.row_number().over(w) == 1
    lag = F.when(first, F.col("__tf_carry")).otherwise(F.lag(x).over(w))
    res = j.withColumn("__tf_lag", lag).withColumn(
        out, F.when(F.col("__tf_lag").isNull() | (F.col("__tf_lag") == 0), F.lit(None).cast("double"))
        .otherwise((x - F.col("__tf_lag")) / F.col("__tf_lag")))
    return res.select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{out}`"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """(value, count, rank) of the ``n`` most frequent non-NULL values, ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc("value")).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("count"), F.asc("value"))))


def top_ranked(df: DataFrame, score: str, name: str, n: int = 20, prefix: str = "feature_rank_") -> DataFrame:
    """Top ``n`` by score (desc), ties by name -> (metric ``feature_rank_i``, value name)."""
    top = df.orderBy(F.desc(score), F.asc(name)).limit(n)  # TakeOrdered: n rows reach the window
    rk = F.row_number().over(Window.orderBy(F.desc(score), F.asc(name))) - 1
    return top.select(F.concat(F.lit(prefix), rk.cast("string")).alias("metric"), F.col(name).alias("value"))


def best_row(df: DataFrame, score: str, tie: str, maximize: bool = True) -> DataFrame:
    o = F.desc(score) if maximize else F.asc(score)
    return df.orderBy(o, F.asc(tie)).limit(1)
