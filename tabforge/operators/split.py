"""Fold assignment and random under-sampling (B-00, B-01).

Draws come from ``u(key, salt)``: a row's fold depends on its key only, so the
split is one narrow projection, reproducible and independent of partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.hashing import u
from tabforge.operators.indexing import global_index, keep_smallest

TEST_SIZE = 0.33
VALID_SIZE = 0.15


def fold_bounds(test_size: float = TEST_SIZE, valid_size: float = VALID_SIZE) -> tuple[float, float]:
    return round(test_size, 12), round(test_size + (1 - test_size) * valid_size, 12)


def assign_folds(df: DataFrame, key: str = "ID", seed=42, test_size: float = TEST_SIZE,
                 valid_size: float = VALID_SIZE, exact: bool = False, fold_col: str = "fold") -> DataFrame:
    """Add ``fold`` in {train, valid, test}: test share ``test_size``, then
    ``valid_size`` of the rest. ``exact`` gives exactly ceil(.33 n) test rows and
    ceil(.15 rest) valid rows, the smallest (u, key) ones."""
    draw = u(key, seed)
    if not exact:
        t, v = fold_bounds(test_size, valid_size)
        fold = F.when(draw < t, "test").when(draw < v, "valid").otherwise("train")
        return df.withColumn(fold_col, fold)
    n = df.count()
    n_test = math.ceil(test_size * n)
    n_valid = math.ceil(valid_size * (n - n_test))
    ranked = global_index(df.withColumn("__tf_u", draw), ["__tf_u", key], "__tf_rank")
    fold = (F.when(F.col("__tf_rank") < n_test, "test")
            .when(F.col("__tf_rank") < n_test + n_valid, "valid").otherwise("train"))
    return ranked.withColumn(fold_col, fold).drop("__tf_u", "__tf_rank")


def downsample(df: DataFrame, label: str = "label", key: str = "ID", seed="downsample",
               fold: str | None = None) -> DataFrame:
    """Random under-sampling: every class keeps as many rows as the smallest
    class, the ones with the smallest (u, key). With ``fold`` this runs per fold.
    Labels of any type; a NULL label is no class and raises."""
    parts = ([fold] if fold is not None else []) + [label]
    group = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(parts)]), {"ignoreNullFields": "false"})
    scored = df.withColumn("__tf_g", group).withColumn("__tf_u", u(key, seed))
    fold_of = F.col(f"`{fold}`").cast("string") if fold is not None else F.lit("")
    counts = scored.groupBy("__tf_g", fold_of.alias("f"), F.col(f"`{label}`").isNull().alias("none")).count().collect()
    if any(r["none"] for r in counts):           # folds x classes rows
        raise ValueError(f"downsample: {sum(r['count'] for r in counts if r['none'])} rows without {label!r}")
    smallest: dict = {}
    for r in counts:
        smallest[r["f"]] = min(smallest.get(r["f"], r["count"]), r["count"])
    if not counts:
        return df
    return keep_smallest(scored, "__tf_g", "__tf_u", key, {r["__tf_g"]: smallest[r["f"]] for r in counts}).drop("__tf_g", "__tf_u")
