import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabforge.operators import features as feat
from tabforge.operators import windows as win


def test_correlated_drop_rule():
    defs = [{"name": n} for n in ["a", "b", "c"]]
    corr = {("b", "a"): 0.99, ("c", "a"): 0.1, ("c", "b"): -0.96}
    # c correlates with b (which is itself dropped) -> c still goes
    assert feat.correlated_drops(defs, corr) == {"b", "c"}
    assert feat.correlated_drops(defs, {("b", "a"): float("nan")}) == set()


def test_fit_plan_and_replay(spark):
    rows = [(i, float(i), float(i) * 2 + 1, "x" if i % 3 else "y", None if i % 4 == 0 else 1.0, 1.0, i % 2)
            for i in range(40)]
    df = spark.createDataFrame(rows, "ID long, a double, twin double, c string, holes double, const double, label int")
    plan = feat.fit_features(df, "ID", exclude=["label"])
    names = plan.names
    assert "twin" not in names and "const" not in names  # correlated, low information
    assert "c = x" in names and "a" in names
    again = feat.FeaturePlan.from_json(plan.to_json())
    assert again.transform(df).columns == plan.transform(df).columns


def test_pair_correlations_match_pandas(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=300)
    pdf = pd.DataFrame({"ID": range(300), "x": x, "y": x * 3 + rng.normal(size=300), "z": rng.normal(size=300)})
    pdf.loc[::7, "y"] = np.nan
    df = spark.createDataFrame(pdf)
    defs = [{"name": c, "kind": "identity", "input": c, "type": "numeric"} for c in ["x", "y", "z"]]
    got = feat.pair_correlations(df, defs)
    exp = pdf[["x", "y", "z"]].corr()
    assert abs(got[("y", "x")] - exp.loc["y", "x"]) < 1e-9
    assert abs(got[("z", "y")] - exp.loc["z", "y"]) < 1e-9


def test_cumulative_sum_and_percent_change_across_slices(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": range(500), "g": rng.integers(0, 3, 500), "t": rng.permutation(500),
                        "v": rng.normal(size=500)})
    pdf.loc[::9, "v"] = np.nan
    df = spark.createDataFrame(pdf)
    out = win.cumulative_sum(df, "v", ["t"], "cs", group="g", key="k", num_partitions=7).toPandas()
    s = pdf.sort_values(["g", "t"]).copy()
    s["exp"] = s.groupby("g")["v"].cumsum()
    s.loc[s["v"].isna(), "exp"] = np.nan
    m = s.merge(out[["k", "cs"]], on="k")
    assert np.allclose(m["exp"].fillna(-1e9), m["cs"].fillna(-1e9))
    pc = win.percent_change(df, "v", ["t"], "pc", group="g", key="k", num_partitions=7).toPandas()
    s["prev"] = s.groupby("g")["v"].shift()
    s["pexp"] = np.where((s["prev"] == 0) | s["prev"].isna(), np.nan, (s["v"] - s["prev"]) / s["prev"])
    m = s.merge(pc[["k", "pc"]], on="k")
    assert np.allclose(m["pexp"].fillna(-1e9), m["pc"].fillna(-1e9))


def test_groups_that_cross_slices(spark):
    """One group with most rows and many small ones over more slices than groups of the large one."""
    import pandas as pd
    from tabforge.operators.indexing import global_index
    from tabforge.operators.windows import cumulative_sum, percent_change
    rows = [(i, "big" if i % 3 else (None if i % 30 == 0 else f"g{i % 60:02d}"), float(i % 7) or None) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, g string, x double")
    pdf = pd.DataFrame(rows, columns=["k", "g", "x"])
    pdf["x"] = pdf["x"].astype(float)
    by = pdf.sort_values("k").groupby("g", dropna=False)["x"]
    want = by.cumsum()
    got = {r["k"]: r["s"] for r in cumulative_sum(df, "x", "k", "s", "g", num_partitions=13).collect()}
    assert all((got[k] is None) == pd.isna(v) and (got[k] is None or abs(got[k] - v) < 1e-9) for k, v in want.items())
    prev = by.shift()
    got = {r["k"]: r["s"] for r in percent_change(df, "x", "k", "s", "g", num_partitions=13).collect()}
    for k in range(600):
        p, x = prev[k], pdf["x"][k]
        w = None if pd.isna(p) or p == 0 or pd.isna(x) else (x - p) / p
        assert (got[k] is None) == (w is None) and (w is None or abs(got[k] - w) < 1e-9), k
    want = pdf.sort_values("k").groupby("g", dropna=False).cumcount()
    got = {r["k"]: r["i"] for r in global_index(df, "k", "i", group="g", num_partitions=13).collect()}
    assert got == want.to_dict()
    assert sorted(r["i"] for r in global_index(df, "k", "i", num_partitions=13).collect()) == list(range(600))


def _jump(x):
    """A user's vectorized primitive: the part above 2."""
    return (x - 2).clip(lower=0)


def _seen_before(df, value, out, order, group, key):
    """A user's sequence primitive: rows with a value that stand before, by running counts."""
    from pyspark.sql import functions as F
    from tabforge.operators.windows import cumulative_sum
    ones = df.withColumn("__one", F.when(F.col(value).isNotNull(), 1.0).otherwise(0.0))
    return cumulative_sum(ones, "__one", order, out, group=group, key=key).drop("__one")


def test_custom_primitives_go_through_a_saved_plan(spark):
    import pytest
    from tabforge.operators import features as feat
    feat.register_vectorized_primitive("JUMP", "numeric", "numeric", _jump, "double", "the part of {} above 2")
    feat.register_sequence_primitive("SEEN", "numeric", "numeric", _seen_before, "rows of {} so far")
    rows = [(i, i % 3, float(i % 7) if i % 5 else None, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "ID long, user long, x double, fold int")
    train, other = df.where("fold = 0"), df.where("fold = 1")
    plan = feat.fit_features(train, "ID", exclude=["fold", "user"], primitives=["JUMP", "SEEN"], max_depth=2, order="ID", group="user",
                             remove_high_corr=False)
    assert {"x", "JUMP(x)", "SEEN(x)", "SEEN(JUMP(x))", "JUMP(SEEN(x))"} <= set(plan.names)
    text = plan.to_json()
    for n, reg in (("JUMP", feat.ROW_PRIMITIVES), ("SEEN", feat.SEQUENCE_PRIMITIVES)):
        del reg[n]                                          # another session: the plan brings them back
    again = feat.FeaturePlan.from_json(text)
    got = {r["ID"]: r for r in again.transform(other).collect()}
    count: dict = {}
    for i, user, x, fold in rows:
        if fold == 1:
            count[user] = count.get(user, 0) + (x is not None)
            jump = None if x is None else max(0.0, x - 2)
            assert got[i]["JUMP(x)"] == jump and got[i]["SEEN(x)"] == count[user] and got[i]["JUMP(SEEN(x))"] == max(0, count[user] - 2)
    with pytest.raises(ValueError, match="order"):
        feat.synthesize(df, "ID", primitives=["SEEN"])
    with pytest.raises(ValueError, match="register it first"):
        feat.FeaturePlan.from_json(text.replace("_seen_before", "nowhere").replace('"SEEN"', '"GONE"'))


def test_correlated_features_equal_the_rule_over_all_pairs(spark, monkeypatch):
    import numpy as np
    import pandas as pd
    from tabforge.operators import features as feat
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 40))
    for j in range(5, 40, 3):
        x[:, j] = x[:, j - 4] * (2 if j % 2 else -1) + 0.05 * rng.normal(size=300)
    x[rng.random(x.shape) < 0.05] = np.nan
    x[:, 7] = 3.0
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{j}" for j in range(40)]))
    defs = [{"name": f"c{j}", "kind": "identity", "input": f"c{j}", "type": "numeric", "depth": 0} for j in range(40)]
    want = feat.correlated_drops(defs, feat.pair_correlations(df, defs))
    monkeypatch.setattr(feat, "_GRAM", 16)                  # several blocks of pairs
    assert want and feat.correlated_features(df, defs) == want == feat.correlated_drops(defs, feat.pair_correlations(df, defs))
