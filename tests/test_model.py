import numpy as np
import pandas as pd

from tabforge.operators import model as mdl
from tabforge.operators import sweep


def test_early_stop_rounds():
    assert mdl.early_stop_rounds([5, 4, 3, 3.5, 3.6], patience=2) == 3
    assert mdl.early_stop_rounds([1.0] * 30, patience=10) == 1


def test_trial_table_ranges(spark):
    t = sweep.trial_table(spark, 50, ["mean", "knn"], ["none", "ros"]).toPandas()
    assert t["max_depth"].between(5, 20).all() and t["num_leaves"].between(10, 50).all()
    assert t["colsample"].between(0.5, 1.0).all() and t["learning_rate"].between(0.05, 0.2).all()
    assert set(t["imputer"]) <= {"mean", "knn"}


def test_gbt_and_permutation_importance(spark):
    rng = np.random.default_rng(0)
    n = 600
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"ID": np.arange(n), "signal": x, "noise": rng.normal(size=n),
                        "label": (x > 0).astype("int32")})
    df = spark.createDataFrame(pdf)
    m = mdl.fit_gbt(df, ["signal", "noise"], "label", mdl.TrialParams(max_depth=3, num_leaves=8, max_iter=8))
    pred = m.predict(df).toPandas()
    assert (pred["yhat"] == pred["label"]).mean() > 0.9
    imp = {r["feature"]: r["importance"] for r in mdl.permutation_importance(m, df, "ID", 256).collect()}
    assert imp["signal"] > 0.2 and abs(imp["noise"]) < 0.05


def test_ranking_methods_share_one_contract(spark):
    rng = np.random.default_rng(5)
    n = 400
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"ID": np.arange(n), "signal": x, "noise": rng.normal(size=n),
                        "label": (x > 0).astype("int32")})
    df = spark.createDataFrame(pdf)
    m = mdl.fit_gbt(df, ["signal", "noise"], "label", mdl.TrialParams(max_depth=3, num_leaves=8, max_iter=5))
    for method in ("gain", "shap", "permutation"):
        top = mdl.rank_features(m, spark, 1, method=method, data=df).collect()
        assert [(r["metric"], r["value"]) for r in top] == [("feature_rank_0", "signal")], method
    import pytest
    with pytest.raises(ValueError):
        mdl.feature_importances(m, spark, "shap")  # needs the rows to explain
    with pytest.raises(ValueError):
        mdl.feature_importances(m, spark, "lime", df)


def test_patience_decides_and_the_prefix_is_the_shorter_fit(spark):
    from pyspark.sql import functions as F
    from tabforge.operators import model as mdl
    df = spark.range(400).select(F.col("id").alias("ID"), (F.col("id") % 10).cast("double").alias("a"),
                                 (F.xxhash64("id") % 100).cast("double").alias("b"))
    df = df.withColumn("label", ((F.col("a") > 4) != (F.col("b") > 40)).cast("int"))
    train, valid = df.where("ID % 3 != 0"), df.where("ID % 3 = 0")
    p = mdl.TrialParams(max_depth=2, num_leaves=4, learning_rate=0.3)
    assert p.max_iter == 1000
    m = mdl.fit_gbt(train, ["a", "b"], "label", p, valid=valid)
    assert m.n_trees < 1000 and m.model.getNumTrees == m.n_trees and mdl.stopped(m.losses)
    short = mdl.fit_gbt(train, ["a", "b"], "label", mdl.TrialParams(max_depth=2, num_leaves=4, learning_rate=0.3, max_iter=m.n_trees))
    a = {r["ID"]: r["p"] for r in m.predict(valid).collect()}
    assert all(abs(a[r["ID"]] - r["p"]) < 1e-12 for r in short.predict(valid).collect())


def test_a_failing_variant_leaves_the_other_trials(spark, monkeypatch):
    from pyspark.sql import functions as F
    from tabforge.operators import sweep
    df = spark.range(300).select(F.col("id").alias("ID"), (F.col("id") % 7).cast("double").alias("a"),
                                 F.when(F.col("id") % 7 > 3, 1).otherwise(0).alias("label"),
                                 F.element_at(F.array(F.lit("train"), F.lit("valid"), F.lit("test")), (F.col("id") % 3 + 1).cast("int")).alias("fold"))
    trials = spark.createDataFrame([(0, "mean", "none", 3, 8, 1.0, 1.0, 0.2), (1, "mean", "nosuch", 3, 8, 1.0, 1.0, 0.2),
                                    (2, "nosuch", "none", 3, 8, 1.0, 1.0, 0.2)],
                                   "trial_id long, imputer string, balancer string, max_depth int, num_leaves int, colsample double, "
                                   "subsample double, learning_rate double")
    table, models = sweep.run_sweep(df, trials, max_iter=5)
    rows = {r["trial_id"]: r for r in table.collect()}
    assert rows[0]["score"] is not None and rows[0]["error"] is None and set(models) == {0}
    assert rows[1]["score"] is None and "nosuch" in rows[1]["error"] and "nosuch" in rows[2]["error"]
    assert sweep.best_trial(table).first()["trial_id"] == 0
    late, _ = sweep.run_sweep(df, trials.where("trial_id = 0"), max_iter=5, time_limit=-1.0)
    assert "TimeoutError" in late.first()["error"]


def test_calibrated_model_survives_saving(spark, tmp_path):
    from pyspark.sql import functions as F
    from tabforge.operators import model as mdl
    from tabforge.sources import stage
    df = spark.range(300).select(F.col("id").alias("ID"), (F.col("id") % 11).cast("double").alias("a"),
                                 F.when((F.col("id") % 11 > 5) | (F.col("id") % 13 == 0), 1).otherwise(0).alias("label"))
    base = mdl.fit_gbt(df, ["a"], "label", mdl.TrialParams(max_depth=2, num_leaves=4, max_iter=3))
    iso = mdl.calibrate(base, df, df)
    for m in (iso, mdl.Calibrated(base, None, 0.0, 0.0), base):
        path = stage.save_model(m, str(tmp_path / f"m{id(m)}"), {"runId": "r"})
        back, desc = stage.load_model(spark, path)
        assert desc["calibrated"] == (isinstance(m, mdl.Calibrated) and m.used)
        want = {r["ID"]: r["p"] for r in m.predict(df).collect()}
        assert all(abs(want[r["ID"]] - r["p"]) < 1e-12 for r in back.predict(df).collect())


def test_running_trials_are_cancelled_at_the_limit(spark, monkeypatch):
    """One trial never ends: its jobs are cancelled, it is recorded so, and the others finish."""
    import time

    import pytest
    from pyspark.sql import functions as F
    df = spark.range(300).select(F.col("id").alias("ID"), (F.col("id") % 7).cast("double").alias("a"),
                                 F.when(F.col("id") % 7 > 3, 1).otherwise(0).alias("label"),
                                 F.element_at(F.array(F.lit("train"), F.lit("valid"), F.lit("test")), (F.col("id") % 3 + 1).cast("int")).alias("fold"))
    trials = spark.createDataFrame([(0, "mean", "none", 3, 8, 1.0, 1.0, 0.2), (1, "mean", "none", 4, 8, 1.0, 1.0, 0.2)],
                                   "trial_id long, imputer string, balancer string, max_depth int, num_leaves int, colsample double, "
                                   "subsample double, learning_rate double")
    real = sweep.fit_gbt

    def fit(train, features, label, params, *a, **k):
        while params.max_depth == 4:                        # many jobs, each of some length
            spark.range(4).rdd.map(lambda i: __import__("time").sleep(1) or i).count()
        return real(train, features, label, params, *a, **k)
    monkeypatch.setattr(sweep, "fit_gbt", fit)
    began = time.time()
    table, models = sweep.run_sweep(df, trials, max_iter=3, trial_limit=40.0)
    rows = {r["trial_id"]: r for r in table.collect()}
    assert rows[0]["error"] is None and rows[0]["score"] is not None and set(models) == {0}
    assert rows[1]["score"] is None and "cancelled" in rows[1]["error"] and time.time() - began < 120
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None and spark.range(5).count() == 5
    with pytest.raises(Exception, match="(?i)cancel"):
        with sweep.JobGroup(spark, "mine", 0.0):
            spark.range(4).rdd.map(lambda i: __import__("time").sleep(20) or i).count()
