"""Isolation forest (I-04; Liu, Ting & Zhou 2008) grown and applied on Spark.

* Sampling: one draw v = u(key, salt) per row; tree t takes the ``max_samples``
  rows with the smallest (v - t/T) mod 1 among those in a window just above
  t/T. Only rows inside some window are replicated, so the sample step is one
  narrow pass plus a shuffle of about trees x 4 x max_samples rows.
* Growing: ``groupBy(tree).applyInPandas`` -- one small task per tree.
* Scoring: the trees (a few thousand numbers) are broadcast and every
  partition scores its rows in Arrow batches: s = 2^(-E[h] / c(psi)).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.hashing import u

# Defaults of the reference's outlier estimator.
N_TREES = 100
MAX_SAMPLES = 100
THRESHOLD = 0.5
EULER = 0.5772156649


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Flat arrays: feature, threshold, left, right, and the path length of a row that ends in the
    node, depth + c(rows of the node) (leaf: feature -1)."""
    feat, thr, left, right, path = [], [], [], [], []

    def node(rows, depth):
        i = len(feat)
        feat.append(-1)
        thr.append(0.0)
        left.append(-1)
        right.append(-1)
        path.append(depth + c_factor(len(rows)))
        if depth >= max_depth or len(rows) <= 1:
            return i
        sub = x[rows]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.nonzero(hi > lo)[0]
        if len(cand) == 0:
            return i
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        feat[i], thr[i] = f, t
        mask = sub[:, f] < t
        left[i] = node(rows[mask], depth + 1)
        right[i] = node(rows[~mask], depth + 1)
        return i

    node(np.arange(len(x)), 0)
    return feat, thr, left, right, path


def _path_lengths(x: np.ndarray, tree) -> np.ndarray:
    """All rows go down one level per step; a leaf's path length is then one gather."""
    feat, thr, left, right, path = tree
    idx = np.zeros(len(x), dtype=np.int64)
    live = np.arange(len(x)) if feat[0] >= 0 else np.zeros(0, dtype=np.int64)
    while len(live):
        at = idx[live]
        idx[live] = np.where(x[live, feat[at]] < thr[at], left[at], right[at])
        live = live[feat[idx[live]] >= 0]
    return path[idx]


def _present(c: str, key: str):
    """Column ``c`` as a double; a missing value has no side of a split, so it fails the query."""
    x = F.col(f"`{c}`").cast("double")
    return F.when(x.isNull() | F.isnan(x), F.raise_error(F.concat(
        F.lit(f"isolation forest: feature {c!r} is missing in row "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")),
        F.lit("; impute it first")))).otherwise(x)


class IsolationForestModel:
    def __init__(self, features, trees, psi):
        self.features, self.trees, self.psi = features, trees, psi

    def score(self, df: DataFrame, key: str = "ID") -> DataFrame:
        """Adds ``outlier_score`` in (0, 1] and ``outlier`` (-1 above 0.5, else 1)."""
        bc = df.sparkSession.sparkContext.broadcast(self.trees)  # trees x nodes numbers
        feats, cn = list(self.features), c_factor(self.psi)

        def run(batches):
            trees = [tuple(np.asarray(a) for a in t) for t in bc.value]
            for pdf in batches:
                x = pdf[[f"__if{i}" for i in range(len(feats))]].to_numpy(dtype="float64")
                h = np.mean([_path_lengths(x, t) for t in trees], axis=0) if len(x) else np.zeros(0)
                s = np.power(2.0, -h / cn) if cn > 0 else np.ones(len(x))
                out = pdf.drop(columns=[f"__if{i}" for i in range(len(feats))])
                out["outlier_score"] = s
                out["outlier"] = np.where(s > THRESHOLD, -1, 1).astype("int32")
                yield out
        from pyspark.sql import types as T
        base = df.select(F.col(key), *[_present(c, key).alias(f"__if{i}") for i, c in enumerate(feats)])
        schema = T.StructType([df.schema[key], T.StructField("outlier_score", T.DoubleType()),
                               T.StructField("outlier", T.IntegerType())])
        return base.mapInPandas(run, schema)


def fit_isolation_forest(df: DataFrame, features: list[str], key: str = "ID", n_trees: int = N_TREES,
                         max_samples: int = MAX_SAMPLES, seed: str = "iforest", oversample: float = 4.0,
                         rng_seed: int = 0) -> IsolationForestModel:
    n = df.count()
    psi = min(max_samples, n)
    depth = math.ceil(math.log2(max(psi, 2)))
    w = min(1.0, oversample * psi / max(n, 1))
    v = u(key, seed)
    # trees whose window [t/T, t/T + w) (mod 1) contains v
    lo = F.ceil((v - F.lit(w)) * n_trees).cast("int")
    hi = F.floor(v * n_trees).cast("int")
    rows = df.select(F.col(key), *[_present(c, key).alias(f"x{i}") for i, c in enumerate(features)],
                     v.alias("__v"), F.sequence(lo, hi).alias("__ts"))
    rows = rows.withColumn("tree", F.explode("__ts")).drop("__ts")
    rows = rows.withColumn("tree", F.pmod(F.col("tree"), F.lit(n_trees)))
    rows = rows.withColumn("__d", F.col("__v") - F.col("tree") / F.lit(float(n_trees)))
    rows = rows.withColumn("__d", F.col("__d") - F.floor("__d")).where(F.col("__d") < w)
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("__d", key))  # ~oversample x psi rows per tree
    sample = rows.withColumn("__r", rank).where(F.col("__r") <= psi).drop("__r", "__v", "__d")
    xcols = [f"x{i}" for i in range(len(features))]

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        x = pdf[xcols].to_numpy(dtype="float64")
        feat, thr, left, right, path = _grow(x, np.random.default_rng(rng_seed * 1000 + t), depth)
        return pd.DataFrame({"tree": [t], "feat": [feat], "thr": [thr], "left": [left], "right": [right],
                             "path": [path]})

    schema = "tree int, feat array<int>, thr array<double>, left array<int>, right array<int>, path array<double>"
    grown = sample.groupBy("tree").applyInPandas(grow, schema).orderBy("tree").collect()  # n_trees small rows
    trees = [(r["feat"], r["thr"], r["left"], r["right"], r["path"]) for r in grown]
    return IsolationForestModel(features, trees, psi)
