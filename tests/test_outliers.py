import numpy as np
import pytest

from tabforge.operators import outliers as o


def test_path_lengths_follow_the_tree():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(100, 4))
    tree = tuple(np.asarray(a) for a in o._grow(x, np.random.default_rng(1), 7))
    feat, thr, left, right, path = tree

    def walk(row):
        i = depth = 0
        while feat[i] >= 0:
            i = left[i] if row[feat[i]] < thr[i] else right[i]
            depth += 1
        return i, depth
    rows = rng.normal(size=(500, 4))
    got = o._path_lengths(rows, tree)
    ends = [walk(r) for r in rows]
    assert got.tolist() == [path[i] for i, _ in ends]
    held = {}
    for r in x:
        i, depth = walk(r)
        held.setdefault((i, depth), []).append(r)
    assert all(path[i] == depth + o.c_factor(len(rs)) for (i, depth), rs in held.items())
    assert o._path_lengths(rows, tuple(np.asarray(a) for a in o._grow(x[:1], rng, 7))).tolist() == [0.0] * 500


def test_missing_features_raise_and_far_rows_score_high(spark):
    df = spark.createDataFrame([(i, float(i % 10), float(i % 7)) for i in range(200)] + [(999, 500.0, -300.0)], "ID long, a double, b double")
    model = o.fit_isolation_forest(df, ["a", "b"])
    s = {r["ID"]: (r["outlier_score"], r["outlier"]) for r in model.score(df).collect()}
    assert max(s, key=lambda i: s[i][0]) == 999 and s[999][1] == -1 and all(0 < v <= 1 for v, _ in s.values())
    hole = df.union(spark.createDataFrame([(7777, None, 1.0)], df.schema))
    with pytest.raises(Exception, match="feature 'a' is missing in row 7777"):
        model.score(hole).count()
        model.score(hole).toPandas()
