"""Operator 11 against brute force on plain Python values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import hard_negatives as hn
from tabforge.llm.queries import op11_hard_negatives
from tabforge.session import table

from ..conftest import SF_ORACLE, SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int"
COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=100):
    """rows: (vec_id, vector, label), distinct ids."""
    ok = [(i, v, lab) for i, v, lab in rows if i is not None and v and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    lab = np.array([(b + 1) % 10 if i % 7 == 0 else b for i, _, b in ok])
    ids, x = np.array([i for i, _, _ in ok]), np.array([[math.floor(256 * float(c)) for c in v] for _, v, _ in ok], np.int64)
    out = []
    for a in np.flatnonzero(ids % every == 0):
        s = x @ x[a]
        order = np.lexsort((ids, -s))
        for p in [k for k in order if lab[k] == lab[a] and k != a][:5]:
            neg = [k for k in order if lab[k] != lab[a] and 80 * s[p] <= 100 * s[k] <= 100 * s[p]][:5]
            out += [(int(ids[a]), int(ids[p]), r + 1, int(ids[k]), int(s[p]), int(s[k])) for r, k in enumerate(neg)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_whole_table_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "embeddings").select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    assert want and found(op11_hard_negatives(spark, sf)) == want


@pytest.mark.parametrize("dim,scale", [(3, 1.0), (8, 300.0), (2, 40_000.0)])
def test_many_shards_ties_and_hot_vectors(spark, dim, scale):
    """Clusters, a third of all rows equal, few and many labels; floats and 64-bit products."""
    rng = np.random.default_rng(dim)
    centre = rng.normal(size=(12, dim))
    rows = []
    for i in range(3000):
        v = np.ones(dim) if i % 3 == 0 else np.round(centre[i % 12] + 0.3 * rng.normal(size=dim), 1)
        rows.append((i, (v * scale).tolist(), int(rng.integers(0, 4)) if i % 2 else i % 700))
    got = found(hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, shard_rows=150, leaf_rows=16, lane_rows=20))
    assert got == brute(rows, 50)


def test_slices_of_boxes(spark, monkeypatch):
    monkeypatch.setattr(hn, "BOX_BYTES", 400)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], i % 5) for i in range(600)]
    assert found(hn.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, shard_rows=40, leaf_rows=8)) == brute(rows, 20)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(100 * k, [1.0, k / 10], 1) for k in range(5)] + [(100 * k + 1, [0.9, k / 10], 2) for k in range(5)]
    bad = [(900, None, 1), (901, [], 1), (902, [1.0, None], 1), (903, [nan, 1.0], 2), (904, [inf, 1.0], 2), (905, [1.0, 1.0], None),
           (None, [1.0, 1.0], 2), (906, [1.0], 2), (907, [1e30, 0.0], 2)]
    df = spark.createDataFrame([(*r, 7, "x") for r in good + bad], SCHEMA + ", score long, rank string")
    run = lambda d: found(hn.hard_negatives(d, F.col("vec_id") % 100 == 0, leaf_rows=2, shard_rows=4))
    assert run(df) == brute(good)
    twice = spark.createDataFrame(good + good + [(100, [5.0, 5.0], 3), (1, [7.0, 7.0], 2)], SCHEMA)
    assert run(twice) == brute(good)
    assert run(df.limit(0)) == [] and run(df.where("vec_id between 900 and 905")) == []
    assert run(spark.createDataFrame([(100, [-1.0, 0.0], 1), (200, [1.0, 0.0], 1), (300, [0.0, 0.0], 2)], SCHEMA)) == []


def test_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-50, 50, (200, 5)), rng.integers(-50, 50, (20, 5))
    least, most = hn.bounds(q, x.min(axis=0)[None], x.max(axis=0)[None])
    assert (q @ x.T >= least).all() and (q @ x.T <= most).all()
    for top in (1 << 10, 1 << 20, 1 << 28):
        a, b = rng.integers(-top, top, (7, 9)), rng.integers(-top, top, (5, 9))
        assert (hn.dot(a, b) == a @ b.T).all()
    some = hn.leaves(np.arange(1000) % 3, rng.integers(0, 9, (1000, 4)), 32)
    assert sorted(np.concatenate(some).tolist()) == list(range(1000)) and max(map(len, some)) <= 32
