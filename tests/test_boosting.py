"""Leaf-wise boosting against a plain-Python best-first tree."""

import math

import numpy as np
import pandas as pd
import pytest

from tabforge.operators import boosting as bo
from tabforge.operators import model as mdl


def slow_tree(x, g, h, num_leaves, max_depth, min_rows, rate):
    """Best-first growth over all cuts at distinct values: {leaf rows: value} as a list."""
    def best(rows, depth):
        out = (1e-10, None)
        if depth >= max_depth:
            return out
        for f in range(x.shape[1]):
            for t in np.unique(x[rows, f]):
                a, b = rows[x[rows, f] <= t], rows[~(x[rows, f] <= t)]
                if min(len(a), len(b)) < min_rows or min(h[a].sum(), h[b].sum()) < bo.MIN_HESSIAN:
                    continue
                s = lambda r: g[r].sum() ** 2 / h[r].sum()
                gain = s(a) + s(b) - s(rows)
                if gain > out[0] + 1e-9:
                    out = (gain, (a, b))
        return out
    leaves = [(np.arange(len(x)), 0, *best(np.arange(len(x)), 0))]
    while len(leaves) < num_leaves:
        k = max(range(len(leaves)), key=lambda i: leaves[i][2] if leaves[i][3] else -1)
        rows, depth, _, cut = leaves[k]
        if cut is None:
            break
        leaves[k:k + 1] = [(r, depth + 1, *best(r, depth + 1)) for r in cut]
    out = np.zeros(len(x))
    for rows, *_ in leaves:
        out[rows] = -rate * g[rows].sum() / h[rows].sum()
    return out, len(leaves)


@pytest.mark.parametrize("num_leaves,max_depth", [(2, 9), (5, 9), (12, 9), (31, 3), (40, 20)])
def test_tree_is_the_best_first_one(num_leaves, max_depth):
    rng = np.random.default_rng(num_leaves)
    x = rng.integers(0, 12, (300, 3)).astype(float)
    y = (x[:, 0] * x[:, 1] > 30) + 0.3 * x[:, 2] + rng.normal(0, 0.2, 300)
    bounds = [np.unique(x[:, j]) for j in range(3)]
    spec = bo.Spec("Regression", 3, 13, num_leaves, max_depth, 0.5, 1.0, 1.0, 1, 0.0, 8, 1, 10, False)
    trees, _ = bo.boost(bo.InTask(spec, [(bo._bin(x[a:a + 77], bounds), y[a:a + 77], np.zeros(len(y[a:a + 77]), bool), np.arange(77)[:len(y[a:a + 77])],
                                          np.zeros(len(y[a:a + 77]))) for a in range(0, 300, 77)]), spec)
    want, leaves = slow_tree(x, -y, np.ones(300), num_leaves, max_depth, 8, 0.5)
    margin = np.zeros(300)
    trees[0].add(margin, bo._bin(x, bounds))
    assert np.allclose(margin, want) and len(trees[0].splits) + 1 == leaves <= num_leaves


def _frame(spark, n=1500, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[rng.random((n, 4)) < 0.1] = np.nan
    y = ((np.nan_to_num(x[:, 0]) * np.nan_to_num(x[:, 1]) > 0) | np.isnan(x[:, 2])).astype(int)
    pdf = pd.DataFrame({"ID": np.arange(n), **{f"f {j}": x[:, j] for j in range(4)}, "label": y, "target": np.nan_to_num(x[:, 0]) * 3 + y})
    return spark.createDataFrame(pdf).repartition(6).persist(), [f"f {j}" for j in range(4)]


@pytest.mark.parametrize("task,label", [("Classification", "label"), ("Regression", "target")])
def test_spread_passes_give_the_trees_of_one_task(spark, monkeypatch, task, label):
    df, feats = _frame(spark)
    train, valid = df.where("ID % 3 > 0"), df.where("ID % 3 = 0")
    args = (train, valid, feats, label, task, 12, 5, 0.2, 0.8, 0.7, 3, 0.0, 10, 6, 10)
    monkeypatch.setattr(bo, "REFRESH", 2)
    one = bo.fit_trees(*args)
    many = bo.fit_trees(*args, part_bytes=2000)
    monkeypatch.setattr(bo, "DRIVER_BYTES", 0)              # sums by chunk on the executors
    summed = bo.fit_trees(*(args[:-2]), 2, 10, part_bytes=2000)
    assert len(one.trees) == 6 and np.allclose(one.losses, many.losses, atol=1e-9) and np.allclose(one.losses[:2], summed.losses, atol=1e-9)
    assert [t.splits.keys() for t in one.trees] == [t.splits.keys() for t in many.trees]
    assert max(len(t.splits) for t in one.trees) == 11


@pytest.mark.parametrize("task,label", [("Classification", "label"), ("Regression", "target")])
def test_spark_model_predicts_the_margins(spark, task, label):
    df, feats = _frame(spark)
    p = mdl.TrialParams(max_depth=5, num_leaves=9, max_iter=6)
    m = mdl.fit_gbt(df, feats, label, p, task)
    fit = bo.fit_trees(df, None, feats, label, task, 9, 5, 0.1, 1.0, 1.0, mdl.SEED, 0.0, 20, 6, 10)
    got = m.predict(df).toPandas().sort_values("ID")
    margin = np.full(len(got), fit.init)
    for t in fit.trees:
        t.add(margin, bo._bin(got[feats].to_numpy(), fit.bounds))
    assert np.allclose(got["p"], 1 / (1 + np.exp(-margin))) if task == "Classification" else np.allclose(got["yhat"], margin)
    top = [r["feature"] for r in m.importances(spark).orderBy("importance", ascending=False).collect()]
    assert top[0] in feats[:3]


def test_no_round_is_fitted_twice(monkeypatch):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(600, 2)), None
    y = (x[:, 0] > 0).astype(float) * (rng.random(600) < 0.9)
    bounds = [np.unique(x[:, j]) for j in range(2)]
    spec = bo.Spec("Classification", 2, 601, 4, 3, 0.3, 1.0, 1.0, 1, 0.0, 20, 1000, 10, True)
    grown = []
    real = bo.grow
    monkeypatch.setattr(bo, "grow", lambda *a, **k: grown.append(1) or real(*a, **k))
    trees, losses = bo.boost(bo.InTask(spec, [(bo._bin(x, bounds), y, np.arange(600) % 3 == 0, np.arange(600), np.zeros(600))]), spec)
    assert len(grown) == len(trees) == len(losses) < 1000 and bo.stopped(losses)
    assert all(math.isfinite(v) for v in losses)


def test_defined_cases(spark):
    df, feats = _frame(spark, 60)
    with pytest.raises(ValueError):
        mdl.fit_gbt(df.limit(0), feats)
    flat = mdl.fit_gbt(df.selectExpr("ID", "1.0 AS a", "label"), ["a"])
    assert flat.n_trees == 1 and flat.predict(df.selectExpr("ID", "1.0 AS a", "label")).select("p").distinct().count() == 1
    none = mdl.fit_gbt(df, feats, params=mdl.TrialParams(max_iter=3, min_rows=5), valid=df.limit(0))
    assert none.n_trees == 3 and none.losses == []
    nulls = df.selectExpr("ID", "IF(ID < 30, NULL, label) AS label", *[f"`{f}`" for f in feats])
    assert mdl.fit_gbt(nulls, feats, params=mdl.TrialParams(max_iter=2, min_rows=5)).predict(nulls).count() == 60
