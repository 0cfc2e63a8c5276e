"""Pivot search against the all-pairs strategy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators import knn
from tabforge.operators.pivots import PivotIndex, _distances, choose_pivots


def _rows(res):
    return sorted((r["query_id"], r["rank"], r["donor_id"], round(r["distance"], 9)) for r in res.collect())


def _vectors(spark, n, dim, clusters, seed, spread=0.15):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, dim)) * 2
    x = centre[np.arange(n) % clusters] + spread * rng.normal(size=(n, dim))
    x[n // 2:n // 2 + n // 3] = x[0]                        # a third of all rows equal
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(dim)])
    pdf.insert(0, "ID", np.arange(n))
    pdf["kind"] = [f"k{v}" for v in rng.integers(0, 3, n)]
    pdf["label"] = rng.integers(0, 2, n)
    return spark.createDataFrame(pdf).repartition(4).persist(), [f"x{i}" for i in range(dim)]


@pytest.mark.parametrize("farthest", [False, True])
@pytest.mark.parametrize("case", ["plain", "grouped", "mixed"])
def test_pivots_equal_all_pairs(spark, farthest, case):
    df, cols = _vectors(spark, 420, 64 if case == "plain" else 9, 7, 3)
    kw = {"k": 4, "exclude_self": True, "farthest": farthest, "block_rows": 100}
    if case == "grouped":
        kw["group"] = "label"
    if case == "mixed":
        kw |= {"metric": "mixed", "cat_features": ["kind"], "cat_penalty": 0.7}
    queries = df.where("ID % 3 = 0")
    assert _rows(knn.knn_join(queries, df, cols, strategy="pivots", **kw)) == _rows(knn.knn_join(queries, df, cols, strategy="blocked", **kw))


def test_few_donors_and_other_metrics(spark):
    df, cols = _vectors(spark, 40, 3, 2, 1)
    some = df.where("ID < 3")
    got = _rows(knn.knn_join(df, some, cols, k=5, exclude_self=True, strategy="pivots"))
    assert got == _rows(knn.knn_join(df, some, cols, k=5, exclude_self=True, strategy="blocked")) and len(got) == 37 * 3 + 3 * 2
    with pytest.raises(ValueError):
        knn.knn_join(df, df, cols, strategy="pivots", metric="vdm", cat_penalty=1)


@pytest.mark.parametrize("farthest", [False, True])
def test_cells_are_skipped_in_64_dimensions(spark, farthest):
    df, cols = _vectors(spark, 3000, 64, 30, 8)
    q = knn._prepare(df.where("ID % 10 = 0"), "ID", cols, [], None)
    index = PivotIndex(knn._prepare(df, "ID", cols, [], None), 64, 0, "euclidean", 0.0, 400, farthest)
    none = float("-inf") if farthest else float("inf")
    first = index.search(index.visits(q.withColumn("__t", F.lit(none)), 5, True, False), 5, True)
    t = first.groupBy("query_id").agg((F.min if farthest else F.max)("distance").alias("__t")).withColumnRenamed("query_id", "__id")
    rest = index.visits(q.join(t, "__id"), 5, True, True).count()
    cells = sum(len(c[0]) for c in index.cells.values())
    assert cells >= 15 and rest <= (0.7 if farthest else 0.3) * 300 * cells      # measured: 0.64 for farthest


def test_auto_takes_pivots_beyond_the_broadcast_budget(spark, monkeypatch):
    df, cols = _vectors(spark, 200, 12, 3, 4)
    used = []
    real = PivotIndex.topk
    monkeypatch.setattr(PivotIndex, "topk", lambda self, *a: used.append(self.farthest) or real(self, *a))
    for farthest in (False, True):
        knn.knn_join(df, df, cols, k=2, broadcast_budget=1, farthest=farthest, block_rows=50).count()
    assert used == [False, True]


def test_tuples_of_categories_give_the_neighbours_of_rows(spark):
    from tabforge.operators.balance import vdm_neighbours, vdm_space
    rng = np.random.default_rng(6)
    n = 240
    pdf = pd.DataFrame({"ID": rng.permutation(n) * 3, "a b": rng.choice(["x", "y", "z", None], n), "c": rng.choice(["u", "v"], n),
                        "label": rng.choice(["p", "q"], n, p=[0.3, 0.7])})
    pdf.loc[: n // 3, ["a b", "c"]] = ["x", "u"]
    df = spark.createDataFrame(pdf)
    for rows in (df, df.where("label = 'p'")):
        space, names, classes = vdm_space(df, "ID", "label", ["a b", "c"], rows=rows)
        want = knn.knn_join(space, space, names, k=5, key="ID", metric="vdm", exclude_self=True, group="label", cat_penalty=float(classes))
        assert _rows(vdm_neighbours(df, rows, "ID", "label", ["a b", "c"], 5)) == _rows(want)


def test_pivots_are_chosen_in_bounded_memory():
    """The distances of the sample to all pivots are not held at once."""
    import tracemalloc

    from tabforge.operators.pivots import nearest_pivot
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(16384, 8))
    tracemalloc.start()
    pivots = choose_pivots(sample, 1024, turns=1)           # 128 MB for all of them
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pivots) == 1024 and peak < 48 << 20
    assert (nearest_pivot(sample, pivots)[-3000:] == _distances(sample[-3000:], pivots).argmin(axis=1)).all()
