import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabforge.operators import balance as bal
from tabforge.operators import knn


def _points(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"ID": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n),
                        "label": (rng.random(n) < 0.2).astype("int32")})
    return pdf, spark.createDataFrame(pdf)


def test_broadcast_blocked_and_brute_force_agree(spark):
    pdf, df = _points(spark)
    x = pdf[["a", "b"]].to_numpy()
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    exp = {i: list(np.lexsort((pdf["ID"].to_numpy(), d[i]))[:4]) for i in range(len(pdf))}
    for strategy in ("broadcast", "blocked"):
        out = knn.knn_join(df, df, ["a", "b"], k=4, exclude_self=True, strategy=strategy, block_rows=37)
        got = out.toPandas().sort_values(["query_id", "rank"]).groupby("query_id")["donor_id"].apply(list)
        assert {int(k): [int(v) for v in vals] for k, vals in got.items()} == exp


def test_smote_points_on_segments_and_balanced(spark):
    pdf, df = _points(spark)
    out = bal.smote(df, features=["a", "b"], block_rows=50).toPandas()
    counts = out.groupby("label").size()
    assert counts[0] == counts[1]
    syn = out[out.is_synthetic]
    minority = pdf[pdf.label == 1][["a", "b"]].to_numpy()
    # every synthetic point lies on a segment between two minority points
    for _, r in syn.head(40).iterrows():
        p = np.array([r["a"], r["b"]])
        ok = False
        for i in range(len(minority)):
            for j in range(len(minority)):
                if i == j:
                    continue
                d = minority[j] - minority[i]
                t = np.dot(p - minority[i], d) / max(np.dot(d, d), 1e-300)
                if -1e-9 <= t <= 1 + 1e-9 and np.linalg.norm(minority[i] + t * d - p) < 1e-7:
                    ok = True
                    break
            if ok:
                break
        assert ok


def test_undersamplers_keep_minority_size(spark):
    pdf, df = _points(spark)
    n_min = int((pdf.label == 1).sum())
    for version in (1, 2, 3):
        out = bal.near_miss(df, features=["a", "b"], version=version, block_rows=80).toPandas()
        assert (out.label == 1).sum() == n_min
        assert (out.label == 0).sum() <= n_min
    ros = bal.random_oversample(df).toPandas()
    assert ros.groupby("label").size().nunique() == 1


def test_applicable_balancers_rule():
    assert bal.applicable_balancers(3, 3) == ["ros", "smote"]
    assert bal.applicable_balancers(3, 1) == ["ros", "smote"]
    assert "nearmiss3" in bal.applicable_balancers(3, 0)
    assert "onesidedselection" in bal.applicable_balancers(3, 0, enable_slow=True)


def test_partitioned_strategy_matches_blocked_within_groups(spark):
    pdf, df = _points(spark, n=600, seed=5)
    a = knn.knn_join(df, df, ["a", "b"], k=3, exclude_self=True, group="label", strategy="partitioned",
                     block_rows=60).toPandas()
    b = knn.knn_join(df, df, ["a", "b"], k=3, exclude_self=True, group="label", strategy="blocked",
                     block_rows=60).toPandas()
    key = ["query_id", "rank"]
    assert a.sort_values(key)[["query_id", "donor_id", "rank"]].values.tolist() == \
        b.sort_values(key)[["query_id", "donor_id", "rank"]].values.tolist()


def test_kmeans_smote_balances(spark):
    pdf, df = _points(spark, n=400, seed=11)
    out = bal.kmeans_smote(df, features=["a", "b"], n_clusters=4, block_rows=100).toPandas()
    counts = out.groupby("label").size()
    assert counts[0] == counts[1]


def test_knn_impute_partitioned_matches_blocked_with_missing_pivot(spark):
    from tabforge.operators import impute
    rng = np.random.default_rng(9)
    n = 500
    pdf = pd.DataFrame({"ID": np.arange(n), "a": rng.normal(size=n) * 10, "b": rng.normal(size=n),
                        "c": rng.normal(size=n)})
    for col, step in (("a", 13), ("b", 7), ("c", 5)):
        pdf.loc[pdf.index[::step], col] = np.nan
    df = spark.createDataFrame(pdf)
    res = {}
    for strategy in ("partitioned", "blocked"):
        m = impute.fit_knn_imputer(df, "ID", columns=["a", "b", "c"], k=3, block_rows=60, strategy=strategy)
        res[strategy] = sorted((r["ID"], r["feature"], round(r["value"], 9)) for r in m.imputed_cells(df).collect())
    assert res["partitioned"] == res["blocked"] and len(res["blocked"]) > 100


def test_balancers_do_not_depend_on_partitioning(spark):
    pdf, df = _points(spark, n=250, seed=21)
    other = df.repartition(7, "a")

    def rows(out):
        return sorted(((r["ID"] if r["ID"] is not None else -1), r["label"], round(r["a"], 9), round(r["b"], 9),
                       r["draw_id"] or "") for r in out.collect())
    assert rows(bal.smote(df, features=["a", "b"], block_rows=40)) == \
        rows(bal.smote(other, features=["a", "b"], block_rows=40, strategy="blocked"))
    assert rows(bal.random_oversample(df)) == rows(bal.random_oversample(other))
    assert sorted(r["ID"] for r in bal.near_miss(df, features=["a", "b"], version=1).collect()) == \
        sorted(r["ID"] for r in bal.near_miss(other, features=["a", "b"], version=1).collect())


def test_partitioned_splits_crowded_query_cells(spark):
    """Queries packed into one donor cell: that cell is cut into sub-blocks
    (donors copied to each), and the answer stays the blocked one."""
    rng = np.random.default_rng(21)
    # pruning coordinate a (highest variance); 8 donor cells, every query in the first
    donors = pd.DataFrame({"ID": np.arange(400), "a": rng.uniform(0, 10, 400), "b": rng.uniform(0, 1, 400)})
    queries = pd.DataFrame({"ID": np.arange(1000, 1300), "a": rng.uniform(0, 0.3, 300),
                            "b": rng.uniform(0, 1, 300)})
    q, d = spark.createDataFrame(queries), spark.createDataFrame(donors)
    res = {}
    for strategy in ("partitioned", "blocked"):
        out = knn.knn_join(q, d, ["a", "b"], k=4, strategy=strategy, block_rows=50)
        res[strategy] = sorted((r["query_id"], r["rank"], r["donor_id"]) for r in out.collect())
    assert res["partitioned"] == res["blocked"] and len(res["blocked"]) == 300 * 4


def test_missing_features_and_labels_raise(spark):
    import pytest
    from tabforge.operators import balance as bal
    rows = [(i, float(i % 9), float(i % 4), int(i % 4 == 0)) for i in range(80)]
    df = spark.createDataFrame(rows, "ID long, a double, b double, label int")
    hole = df.union(spark.createDataFrame([(99, None, 1.0, 1)], df.schema))
    for f in (bal.smote, bal.near_miss, bal.neighbourhood_cleaning, bal.adasyn):
        with pytest.raises(Exception, match="feature 'a' is missing in row 99"):
            f(hole).count()
    no_label = df.union(spark.createDataFrame([(99, 1.0, 1.0, None)], df.schema))
    for f in (bal.smote, bal.random_oversample, bal.near_miss, bal.one_sided_selection):
        with pytest.raises(ValueError, match="1 rows without 'label'"):
            f(no_label)


def test_any_key_and_label_type(spark):
    from pyspark.sql import functions as F
    from tabforge.operators import balance as bal
    from tabforge.operators.knn import knn_join
    rows = [(i, float((i * 7) % 23), float((i * 5) % 11), int(i % 4 == 0)) for i in range(80)]
    df = spark.createDataFrame(rows, "ID long, a double, b double, label int")
    text = df.withColumn("ID", F.format_string("k%03d", "ID")).withColumn("label", F.when(F.col("label") == 1, "p#1").otherwise("n"))
    want = {(r["query_id"], r["rank"]): (r["donor_id"], r["distance"]) for r in knn_join(df, df, ["a", "b"], 3, exclude_self=True).collect()}
    got = {(int(r["query_id"][1:]), r["rank"]): (int(r["donor_id"][1:]), r["distance"])
           for r in knn_join(text, text, ["a", "b"], 3, exclude_self=True).collect()}
    assert got == want
    flag = df.withColumn("label", F.col("label") == 1)
    for frame, yes in ((text, "p#1"), (flag, True), (df, 1)):
        for f in (bal.smote, bal.kmeans_smote, bal.random_oversample):
            n = {r["label"]: r["count"] for r in f(frame).groupBy("label").count().collect()}
            assert n == {yes: 60, (False if yes is True else 0 if yes == 1 else "n"): 60}, (f, n)
    kept = {int(r["ID"][1:]) for r in bal.near_miss(text).collect()}
    assert kept == {r["ID"] for r in bal.near_miss(df).collect()}


def test_hot_donor_cells_are_cut(spark):
    """A pivot that is 95 % zeros: no task gets much more than block_rows donors, same answers."""
    from pyspark.sql import functions as F
    from tabforge.operators.knn import _prepare, _sub_blocks, knn_join
    rows = [(i, 0.0 if i % 20 else float(i * 13 % 997) * 10, float(i * 7 % 101), float(i * 3 % 89)) for i in range(1500)]
    df = spark.createDataFrame(rows, "ID long, a double, b double, c double")
    d = _prepare(df, "ID", ["a", "b", "c"], [], None).withColumn("__cell", (F.col("__x0") > 0).cast("int"))
    q, d = _sub_blocks(d, d, ["__g", "__cell"], 100)
    for side in (q, d):
        assert side.groupBy("__g", "__cell", "__sub").count().agg(F.max("count")).first()[0] <= 160
    pairs = q.select("__cell", "__sub", F.col("__id").alias("x")).join(d.select("__cell", "__sub", F.col("__id").alias("y")), ["__cell", "__sub"])
    n = {r["__cell"]: r["count"] for r in pairs.groupBy("__cell").count().collect()}
    assert n == {0: 1426 ** 2, 1: 74 ** 2} and pairs.select("x", "y").distinct().count() == sum(n.values())
    ask = df.where("ID < 120")
    args = dict(features=["a", "b", "c"], k=4, exclude_self=True, block_rows=100)
    got, want = (sorted(map(tuple, knn_join(ask, df, strategy=s, **args).collect())) for s in ("partitioned", "blocked"))
    assert got == want and len(got) == 480
