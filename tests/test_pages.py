"""Pages of queries against pages of donors: same neighbours as comparing every pair, no copies of rows."""

import numpy as np
import pandas as pd
import pytest

from tabforge.operators import knn, pages


@pytest.fixture
def small_pages(monkeypatch):
    for name, value in (("PAGE_BYTES", 4000), ("SIDE_BYTES", 20000), ("FEWEST", 32)):
        monkeypatch.setattr(pages, name, value)


def _table(spark, n, dim, missing=0.0):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, dim)) * 4)              # ties
    x[n // 2: n // 2 + 20] = x[0]
    x[rng.random((n, dim)) < missing] = np.nan
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(dim)])
    pdf.insert(0, "ID", rng.permutation(n))
    pdf["label"] = np.arange(n) % 3
    return pdf, spark.createDataFrame(pdf).repartition(3).persist(), [f"x{i}" for i in range(dim)]


@pytest.mark.parametrize("strategy,farthest", [("blocked", False), ("blocked", True), ("partitioned", False), ("pivots", False), ("pivots", True)])
def test_pages_equal_brute_force_within_groups(spark, small_pages, strategy, farthest):
    pdf, df, cols = _table(spark, 240, 3)
    got = knn.knn_join(df, df, cols, k=4, exclude_self=True, group="label", strategy=strategy, block_rows=30, farthest=farthest)
    got = sorted((r["query_id"], r["rank"], r["donor_id"], r["distance"]) for r in got.collect())
    want = []
    for _, part in pdf.groupby("label"):
        d = knn.pair_distances(part[cols].to_numpy(), part[cols].to_numpy())
        ids = part["ID"].to_numpy()
        for i, q in enumerate(ids):
            order = [j for j in np.lexsort((ids, -d[i] if farthest else d[i])) if ids[j] != q][:4]
            want += [(q, r + 1, ids[j], d[i, j]) for r, j in enumerate(order)]
    assert got == sorted(want)


@pytest.mark.parametrize("strategy", ["blocked", "partitioned", "patterns"])
def test_pages_impute_as_brute_force(spark, small_pages, strategy):
    pdf, df, cols = _table(spark, 200, 6, missing=0.05)
    got = knn.impute_candidates(df, df, cols, k=3, block_rows=40, strategy=strategy)
    got = sorted((r["query_id"], r["col"], r["rank"], r["donor_id"], r["distance"]) for r in got.collect())
    x, ids, want = pdf[cols].to_numpy(), pdf["ID"].to_numpy(), []
    d = knn.pair_distances(x, x, "nan_euclidean")
    for i, c in zip(*np.nonzero(np.isnan(x))):
        order = [j for j in np.lexsort((ids, d[i])) if not np.isnan(x[j, c]) and np.isfinite(d[i, j])][:3]
        want += [(ids[i], c, r + 1, ids[j], d[i, j]) for r, j in enumerate(order)]
    assert got == sorted(want)


def test_a_side_is_stored_once_whatever_the_number_of_blocks(spark, small_pages, monkeypatch):
    _, df, cols = _table(spark, 600, 3)
    stored, real = [], pages.cut_lineage

    def count(pdf):
        out = real(pdf)
        stored.append(out.agg({"data": "max"}).first() and sum(len(r["data"]) for r in out.select("data").collect()))
        return out
    monkeypatch.setattr(pages, "cut_lineage", count)
    p = knn._prepare(df, "ID", cols, [], None)
    cands = knn._blocked_topk(p, p, cols, [], 4, "euclidean", True, 0.0, 10)
    plan = cands._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "FlatMapCoGroups" not in plan and "explode" not in plan
    assert len(stored) == 2 and max(stored) < 600 * 8 * 20   # 600 rows of 5 numbers and the frames of pages
    assert cands.count() <= 600 * 4 * 2                      # one list per query and part of the donors
