import duckdb
from pyspark.sql import functions as F

from tabforge.functions.hashing import u, u_sql_duckdb
from tabforge.operators import split


def test_u_matches_duckdb_and_is_uniform(spark):
    df = spark.range(2000).select(F.col("id").alias("ID"), u("ID", 42).alias("u"))
    got = {r["ID"]: r["u"] for r in df.collect()}
    con = duckdb.connect()
    ref = dict(con.execute(f"SELECT i, {u_sql_duckdb('i', 42)} FROM range(2000) t(i)").fetchall())
    assert got == ref
    vals = list(got.values())
    assert all(0.0 <= v < 1.0 for v in vals)
    assert 0.45 < sum(vals) / len(vals) < 0.55


def test_folds_are_disjoint_cover_and_partition_independent(spark):
    df = spark.range(5000).select(F.col("id").alias("ID"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    a = {r["ID"]: r["fold"] for r in split.assign_folds(df, "ID", 7).collect()}
    b = {r["ID"]: r["fold"] for r in split.assign_folds(df.repartition(13), "ID", 7).collect()}
    assert a == b and len(a) == 5000
    share = {f: sum(1 for v in a.values() if v == f) / 5000 for f in ("train", "valid", "test")}
    assert abs(share["test"] - 0.33) < 0.03 and abs(share["valid"] - 0.1005) < 0.03


def test_exact_folds_counts(spark):
    df = spark.range(1001).select(F.col("id").alias("ID"))
    out = split.assign_folds(df, "ID", 1, exact=True)
    counts = {r["fold"]: r["count"] for r in out.groupBy("fold").count().collect()}
    assert counts["test"] == 331  # ceil(.33 * 1001)
    assert counts["valid"] == 101  # ceil(.15 * 670)
    assert counts["train"] == 1001 - 331 - 101


def test_downsample_balances_every_class(spark):
    df = spark.range(3000).select(F.col("id").alias("ID"),
                                  F.when(F.col("id") % 10 == 0, 1).when(F.col("id") % 10 < 4, 2)
                                  .otherwise(0).alias("label"))
    out = split.downsample(df, "label", "ID")
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 300, 1: 300, 2: 300}


def test_exact_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(777).select(F.col("id").alias("ID"))
    a = {r["ID"]: r["fold"] for r in split.assign_folds(df, "ID", 5, exact=True).collect()}
    b = {r["ID"]: r["fold"] for r in split.assign_folds(df.repartition(5), "ID", 5, exact=True).collect()}
    assert a == b


def test_downsample_takes_labels_of_any_type(spark):
    import pytest
    from tabforge.operators.split import downsample
    rows = [(i, i % 5 == 0, "a" if i % 2 else "b#1") for i in range(200)]
    df = spark.createDataFrame(rows, "ID long, label boolean, fold string")
    got = {(r["fold"], r["label"]): r["count"] for r in downsample(df, fold="fold").groupBy("fold", "label").count().collect()}
    assert got == {(f, v): 20 for f in ("a", "b#1") for v in (True, False)}
    assert downsample(df).groupBy("label").count().where("count = 40").count() == 2
    with pytest.raises(ValueError, match="1 rows without"):
        downsample(df.union(spark.createDataFrame([(900, None, "a")], df.schema)))


def test_checkpoint_dir_must_be_shared_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from tabforge.session import ensure_checkpoint_dir
    unset = SimpleNamespace(get=lambda key, default=None: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: unset)
        with pytest.raises(RuntimeError, match="shared folder"):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=unset))
