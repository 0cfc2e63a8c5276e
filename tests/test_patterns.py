"""Imputation donors by presence pattern against all block pairs."""

import numpy as np
import pandas as pd
import pytest

from tabforge.operators import knn
from tabforge.operators.patterns import PatternIndex, lower_bounds


def _holes(spark, n, dim, kind, seed=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim)) * 3
    x = centre[np.arange(n) % 6] + 0.2 * rng.normal(size=(n, dim))
    if kind == "few patterns":
        masks = rng.random((4, dim)) < 0.3
        masks[0] = False
        x[masks[rng.integers(0, 4, n)]] = np.nan
    else:
        x[rng.random((n, dim)) < 0.15] = np.nan
    x[3] = np.nan                                           # shares nothing
    x[: n // 4, 0] = x[0, 0]
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(dim)])
    pdf.insert(0, "ID", rng.permutation(n))
    return spark.createDataFrame(pdf).repartition(3).persist(), [f"x{i}" for i in range(dim)]


def _rows(res):
    return sorted((r["query_id"], r["col"], r["rank"], r["donor_id"], round(r["distance"], 9), r["value"]) for r in res.collect())


@pytest.mark.parametrize("kind", ["few patterns", "any"])
def test_patterns_equal_all_pairs(spark, kind):
    df, cols = _holes(spark, 260, 10, kind)
    got = knn.impute_candidates(df, df, cols, k=3, block_rows=60, strategy="patterns")
    assert _rows(got) == _rows(knn.impute_candidates(df, df, cols, k=3, block_rows=60, strategy="blocked"))


def test_bounds_hold_for_every_donor():
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(40, 5)), rng.normal(size=(30, 5))
    x[rng.random(x.shape) < 0.4] = np.nan
    q[rng.random(q.shape) < 0.3] = np.nan
    have = ~np.isnan(x)
    bound = lower_bounds(q, have.all(axis=0)[None], have.any(axis=0)[None], np.nanmin(x, axis=0)[None], np.nanmax(x, axis=0)[None])
    d = knn.pair_distances(q, x, "nan_euclidean")
    assert (np.where(np.isnan(d), np.inf, d) >= bound).all() and np.isfinite(bound).any()


def test_cells_that_cannot_matter_are_not_met(spark):
    df, cols = _holes(spark, 1500, 24, "few patterns")
    p = knn._prepare(df, "ID", cols, [], None, missing_ok=True)
    index = PatternIndex(p, 24, 200)
    q = p.where("__id % 10 = 0")
    first = index.search(index.visits(q.selectExpr("*", "CAST(NULL AS map<int,double>) AS __t"), 5, False), 5)
    t = first.selectExpr("query_id AS __id", "col", "distance").groupBy("__id", "col").agg({"distance": "max"}).withColumnRenamed("max(distance)", "d")
    t = t.groupBy("__id").agg({"d": "max"}).selectExpr("__id", "transform_values(map_from_arrays(sequence(0, 23), sequence(0, 23)), (k, v) -> `max(d)`) AS __t")
    rest = index.visits(q.join(t, "__id"), 5, True)
    assert len(index.cell) >= 15 and rest.count() <= 0.4 * q.count() * len(index.cell)


def test_rows_of_one_pattern_meet_as_plain_vectors(monkeypatch):
    """Only rows of rare patterns need products over presence; results are those of every pair."""
    from tabforge.operators.best import NearestPresent
    rng = np.random.default_rng(9)
    n, dim, k = 900, 24, 3
    x = rng.normal(size=(n, dim)).round(1)
    x[(np.arange(n)[:, None] + np.arange(dim)) % 5 == 0] = np.nan
    x[::97, 0] = np.nan                                     # patterns of few rows
    x[5:200:5] = x[5]                                       # ties
    ids, met, real = rng.permutation(n), [], NearestPresent._any
    monkeypatch.setattr(NearestPresent, "_any", lambda self, rows, dids, d: met.append(len(rows) * len(dids)) or real(self, rows, dids, d))
    best = NearestPresent(ids[:300], x[:300], k)
    for a in range(0, n, 450):
        best.meet(np.arange(300), ids[a:a + 450], x[a:a + 450])
    got = sorted(zip(*[v.tolist() for v in best.rows()]))
    dist, want = knn.pair_distances(x[:300], x, "nan_euclidean"), []
    for i in range(300):
        for c in np.flatnonzero(np.isnan(x[i])):
            can = np.flatnonzero(~np.isnan(x[:, c]) & ~np.isnan(dist[i]))
            for j in can[np.lexsort((ids[can], dist[i, can]))][:k]:
                want.append((ids[i], c, ids[j], dist[i, j], x[j, c]))
    assert got == sorted(want) and sum(met) < 300 * n * 0.2
