"""Distributed ranking primitives that never put a whole group in one task.

* ``global_index``: dense 0-based position by an order, optionally within a
  group. Range partitioning spreads the rows; each task numbers its own rows and
  one carried count per slice shifts them into place. No window over a whole group.
* ``keep_smallest``: per group, keep the n rows with the smallest (score, key).
  Histogram refinement narrows each group's cut to one bucket; only that
  bucket's rows are ranked exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

_PID = "__tf_pid"
_POS = "__tf_pos"


def _default_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def global_index(df: DataFrame, order, index_col: str = "index", group: str | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col`` = 0-based position of the row by ``order`` (within
    ``group`` when given). The order must be unique (append the key)."""
    order_cols = [order] if isinstance(order, str) else list(order)
    keys = ([group] if group else []) + order_cols
    n = num_partitions or _default_partitions(df)
    ranged = (df.repartitionByRange(n, *[F.col(k) for k in keys])
                .sortWithinPartitions(*[F.col(k) for k in keys])
                .withColumn(_POS, F.monotonically_increasing_id()))
    # One materialisation: the counts and the numbered rows see the same layout.
    ranged = cut_lineage(ranged)
    pid = F.shiftright(F.col(_POS), 33)
    within = F.col(_POS) - F.shiftleft(pid, 33)
    ranged = ranged.withColumn(_PID, pid).withColumn(_POS, within)
    if not group:
        counts = sorted((r[_PID], r["n"]) for r in ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n")).collect())
        rows, before = [], 0                      # one row per slice
        for pid_, n_ in counts:
            rows.append((pid_, before))
            before += n_
        offsets = df.sparkSession.createDataFrame(rows, f"{_PID} bigint, __tf_shift bigint")
        out = ranged.join(F.broadcast(offsets), _PID)
    else:
        # a group starts anew in every slice but the one it crosses into: one carried count per slice
        per = cut_lineage(ranged.groupBy(_PID, F.struct(F.col(f"`{group}`").alias("v")).alias("__tf_g"))
                          .agg(F.min(_POS).alias("a"), F.count(F.lit(1)).alias("n")))
        edges = per.groupBy(_PID).agg(F.min_by("__tf_g", "a").alias("fg"), F.max_by(F.struct("__tf_g", "n"), "a").alias("l")).collect()
        rows, before = [], (None, 0)
        for r in sorted(edges, key=lambda r: r[_PID]):
            carry = before[1] if before[0] == r["fg"] else 0
            rows.append((r[_PID], carry))
            before = (r["l"]["__tf_g"], r["l"]["n"] + (carry if r["fg"] == r["l"]["__tf_g"] else 0))
        carried = df.sparkSession.createDataFrame(rows, "__tf_slice bigint, __tf_carry bigint")
        offsets = per.join(F.broadcast(carried), F.col(_PID) == F.col("__tf_slice")).select(
            F.col(_PID).alias("__tf_slice"), F.col("__tf_g.v").alias("__tf_v"),
            (F.when(F.col("a") == 0, F.col("__tf_carry")).otherwise(0) - F.col("a")).alias("__tf_shift"))
        out = ranged.join(offsets, (ranged[_PID] == offsets["__tf_slice"]) & ranged[f"`{group}`"].eqNullSafe(offsets["__tf_v"]))
    idx = (F.col(_POS) + F.col("__tf_shift")).alias(index_col)
    return out.select(*[ranged[f"`{c}`"] for c in df.columns], idx)


def dealt_join(left: DataFrame, right: DataFrame, on: list[str], by: str, how: str = "left", copies: int = 32) -> DataFrame:
    """Equi-join on ``on`` where many rows of ``left`` may share a key: a hash of column ``by`` deals
    them over ``copies`` of the few rows of ``right``, so no task gets a whole key."""
    left = left.withColumn("__deal", F.pmod(F.xxhash64(by), F.lit(copies)).cast("int"))
    right = right.withColumn("__deal", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return left.join(right, [*on, "__deal"], how).drop("__deal")


def _lookup(mapping: dict, key_col: Column, dtype: str = "double") -> Column:
    if not mapping:
        return F.lit(None).cast(dtype)
    args = []
    for k, v in mapping.items():
        args += [F.lit(k), F.lit(v).cast(dtype)]
    return F.element_at(F.create_map(*args), key_col)


def keep_smallest(df: DataFrame, group: str, score: str, key: str, quota: dict,
                  bins: int = 1024, exact_limit: int = 1_000_000, max_levels: int = 6) -> DataFrame:
    """Rows of ``df`` such that each group g keeps its ``quota[g]`` rows with the
    smallest ``(score, key)``; groups absent from ``quota`` are dropped.
    ``score`` must be non-NULL. Exact for any data: refinement stops at ties,
    which are then numbered by key."""
    g = F.col(group)
    s = F.col(score)
    stats = {r[0]: (r[1], r[2], r[3]) for r in
             df.where(g.isin(list(quota))).groupBy(group)
               .agg(F.min(score), F.max(score), F.count(F.lit(1))).collect()}
    keep_parts: list[Column] = []
    state = {}
    for gv, need in quota.items():
        if gv not in stats or need <= 0:
            continue
        lo, hi, n = stats[gv]
        if need >= n:
            keep_parts.append(g == F.lit(gv))
            continue
        state[gv] = {"lo": float(lo), "hi": float(hi), "need": int(need), "n": int(n),
                     "undecided": g == F.lit(gv)}
    for _level in range(max_levels):
        active = {k: v for k, v in state.items() if v["n"] > exact_limit and v["hi"] > v["lo"]}
        if not active:
            break
        lo_m = _lookup({k: v["lo"] for k, v in active.items()}, g)
        wid_m = _lookup({k: (v["hi"] - v["lo"]) for k, v in active.items()}, g)
        bucket = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((s - lo_m) / wid_m * bins))).cast("int")
        undecided_any = None
        for v in active.values():
            undecided_any = v["undecided"] if undecided_any is None else (undecided_any | v["undecided"])
        counts = (df.where(undecided_any).groupBy(group, bucket.alias("b"))
                    .agg(F.count(F.lit(1)).alias("n")).collect())
        per: dict = {}
        for r in counts:
            per.setdefault(r[0], []).append((r["b"], r["n"]))
        for gv, v in active.items():
            cum = 0
            cut = None
            for b, cnt in sorted(per.get(gv, [])):
                if cum + cnt >= v["need"]:
                    cut = (b, cnt)
                    break
                cum += cnt
            if cut is None:  # the counts cannot fall short for non-NULL scores
                raise ValueError(f"keep_smallest: group {gv!r} has fewer rows than counted; is {score} NULL?")
            b_star, cnt = cut
            width = (v["hi"] - v["lo"]) / bins
            keep_parts.append(v["undecided"] & (bucket < b_star))
            v["undecided"] = v["undecided"] & (bucket == b_star)
            v["need"] -= cum
            v["n"] = cnt
            v["lo"], v["hi"] = v["lo"] + b_star * width, v["lo"] + (b_star + 1) * width
    if state:
        undecided_rows = None
        for v in state.values():
            undecided_rows = v["undecided"] if undecided_rows is None else (undecided_rows | v["undecided"])
        need_m = _lookup({k: v["need"] for k, v in state.items()}, g, "bigint")
        boundary = df.where(undecided_rows)
        if max(v["n"] for v in state.values()) > exact_limit:
            ranked = global_index(boundary, [score, key], "__tf_rank", group=group)
            chosen = ranked.where(F.col("__tf_rank") < need_m).drop("__tf_rank")
        else:
            w = Window.partitionBy(group).orderBy(s, F.col(key))  # boundary bucket only: <= exact_limit rows
            chosen = (boundary.withColumn("__tf_rank", F.row_number().over(w))
                      .where(F.col("__tf_rank") <= need_m).drop("__tf_rank"))
    else:
        chosen = None
    decided = None
    if keep_parts:
        cond = keep_parts[0]
        for c in keep_parts[1:]:
            cond = cond | c
        decided = df.where(cond)
    if decided is None and chosen is None:
        return df.limit(0)
    if decided is None:
        return chosen
    if chosen is None:
        return decided
    return decided.unionByName(chosen)
