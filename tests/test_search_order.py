"""Neighbour search looks at few donors: queries in order, equal donors once, bounds within a chunk."""

import numpy as np
import pandas as pd
import pytest

from tabforge.operators import balance as bal
from tabforge.operators import knn
from tabforge.operators.best import Nearest


@pytest.mark.parametrize("dim,farthest,exclude", [(3, False, True), (3, True, False), (32, False, True), (32, True, True)])
def test_a_chunk_ranks_few_donors(dim, farthest, exclude):
    rng = np.random.default_rng(dim)
    x = np.round(rng.lognormal(3, 2, (6000, 1)) * rng.uniform(0.9, 1.1, (6000, dim)), 1)    # a long tail
    ids, ask = rng.permutation(6000), np.arange(0, 6000, 10)
    ranked = []

    class Counted(Nearest):
        def _merge(self, r, donor, key):
            ranked.append(len(r))
            super()._merge(r, donor, key)
    best = Counted(ids[ask], x[ask], 3, exclude, farthest)
    best.sweep(ids, x)
    d = knn.pair_distances(x[ask], x)
    want = []
    for i, q in enumerate(ids[ask]):
        order = np.lexsort((ids, -d[i] if farthest else d[i]))
        want += [(q, ids[j], d[i, j]) for j in order[ids[order] != q if exclude else slice(None)][:3]]
    assert sorted(zip(*best.rows())) == sorted(want)
    assert sum(ranked) < 60 * len(ask)


@pytest.mark.parametrize("strategy", ["broadcast", "blocked", "partitioned", "pivots"])
def test_equal_donors_are_met_once_and_keys_may_repeat(spark, strategy):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"ID": [*range(200), *[3] * 4, 150], "a": [*[1.0] * 150, *rng.integers(0, 9, 50), *[1.0] * 4, 2.0], "b": 0.5})
    df = spark.createDataFrame(pdf)
    got = knn.knn_join(df, df, ["a", "b"], k=3, exclude_self=True, strategy=strategy, block_rows=40)
    got = sorted((r["query_id"], r["donor_id"], r["distance"]) for r in got.collect())
    want, ids = [], pdf["ID"].to_numpy()
    d = knn.pair_distances(pdf[["a", "b"]].to_numpy(), pdf[["a", "b"]].to_numpy())
    for q in np.unique(ids):
        near = [(v, ids[j]) for i in np.flatnonzero(ids == q) for j, v in enumerate(d[i]) if ids[j] != q]
        want += [(q, j, v) for v, j in sorted(near)[:3]]
    once = [r for r in got if r[0] not in (3, 150)]          # queries of one key share one list of ranks
    assert once == sorted(r for r in want if r[0] not in (3, 150))
    assert all(sum(r[0] == q for r in got) == 3 for q in (3, 150))
    kept = knn._first_copies(knn._prepare(df, "ID", ["a", "b"], [], None), 4)
    assert kept.where("__x0 = 1.0 and __id < 150").count() == 4 + 4     # keys 0 to 3, the last of them five times


@pytest.mark.parametrize("clean", [bal.neighbourhood_cleaning, bal.one_sided_selection])
def test_rows_are_read_once(spark, clean):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"ID": np.arange(120), "a": rng.normal(size=120), "label": np.arange(120) % 5 // 4})
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(len(b))
            yield b
    df = spark.createDataFrame(pdf).mapInPandas(count, "ID long, a double, label long")
    assert 0 < clean(df, features=["a"]).count() <= 120
    assert read.value == 120
