import itertools
import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.operators import explain as ex
from tabforge.operators import model as mdl

from .conftest import SF_SMALL


def _frame(spark, n=500, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.normal(size=n), rng.integers(0, 4, size=n).astype(float)
    y = ((a + 0.5 * b * c) > 0.3).astype("int32")
    pdf = pd.DataFrame({"ID": np.arange(n), "a": a, "b": b, "c": c, "label": y})
    holes = pdf.copy()  # rows to explain: missing values go right, as in Spark's splits
    holes.loc[rng.random(n) < 0.1, "a"] = np.nan
    return spark.createDataFrame(pdf), holes


def _brute_force(nodes, weights, x, p):
    """Shapley values from the definition: f_S = cover-weighted expectation of
    the trees with the features outside S unknown, over every subset S."""
    trees = {}
    for r in nodes:
        trees.setdefault(r[0], {})[r[1]] = r

    def f(S):
        tot = 0.0
        for t, nd in trees.items():
            children = {c for r in nd.values() for c in (r[4], r[5]) if c >= 0}
            root = next(i for i in nd if i not in children)

            def g(i):
                r = nd[i]
                if r[4] < 0:
                    return r[2]
                if r[6] in S:
                    v = x[r[6]]
                    left = (v in set(r[7])) if r[8] > 0 else (not np.isnan(v) and v <= r[7][0])
                    return g(r[4] if left else r[5])
                return (nd[r[4]][3] * g(r[4]) + nd[r[5]][3] * g(r[5])) / r[3]
            tot += weights[t] * g(root)
        return tot

    phi = np.zeros(p)
    for i in range(p):
        others = [j for j in range(p) if j != i]
        for k in range(p):
            for S in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p)
                phi[i] += w * (f(set(S) | {i}) - f(set(S)))
    return phi, f(set())


def test_tree_shap_matches_definition(spark):
    df, pdf = _frame(spark)
    m = mdl.fit_gbt(df, ["a", "b", "c"], "label", mdl.TrialParams(max_depth=3, num_leaves=8, max_iter=4))
    nodes, weights = ex.read_trees(m)
    tt = ex.tables_from_nodes(nodes, weights, 3)
    x = pdf[["a", "b", "c"]].to_numpy()[:25]
    phi = ex.shap_matrix(tt, x)
    np.testing.assert_allclose(ex.shap_matrix(tt, x, use_table=False), phi, atol=1e-12)
    for r in range(len(x)):
        want, base = _brute_force(nodes, weights, x[r], 3)
        np.testing.assert_allclose(phi[r], want, atol=1e-10)
        assert abs(base - tt.expected_value) < 1e-10


def test_tree_shap_adds_up_to_spark_margin(spark):
    from tabforge.plans.catalog import _toxic_model
    for task in ("Classification", "Regression"):
        m, parts = _toxic_model(spark, SF_SMALL, task)
        test = parts["test"]
        tt = ex.tree_tables(m)
        raw = m.model.transform(m._vec(test))
        col = vector_to_array("rawPrediction")[1] if task == "Classification" else F.col("prediction")
        got = raw.select(*[F.col(f"`{c}`").cast("double") for c in m.features], col.alias("margin")).toPandas()
        x = got[m.features].to_numpy(dtype=float, na_value=np.nan)
        phi = ex.shap_matrix(tt, x)
        np.testing.assert_allclose(phi.sum(axis=1) + tt.expected_value, got["margin"].to_numpy(), atol=1e-8)


def test_shap_importance_distributed_equals_local(spark):
    train, pdf = _frame(spark, 800, 7)
    m = mdl.fit_gbt(train, ["a", "b", "c"], "label", mdl.TrialParams(max_depth=4, num_leaves=16, max_iter=6))
    df = spark.createDataFrame(pdf)
    tt = ex.tree_tables(m)
    want = np.abs(ex.shap_matrix(tt, pdf[["a", "b", "c"]].to_numpy())).mean(axis=0)
    for parts in (1, 7):
        got = {r["feature"]: r["importance"] for r in ex.shap_importance(m, df.repartition(parts)).collect()}
        np.testing.assert_allclose([got[c] for c in ("a", "b", "c")], want, rtol=1e-9)
    rk = mdl.rank_features(m, spark, 2, method="shap", data=df).orderBy("metric").collect()
    assert [r["metric"] for r in rk] == ["feature_rank_0", "feature_rank_1"]
    assert rk[0]["value"] == ["a", "b", "c"][int(np.argmax(want))]
