"""Registered queries: one per inventory item, each reading the given tables
(or fixtures Spark derives from them) at ``sf_dir``. ``ORACLES`` in
``oracles.py`` holds the DuckDB SQL with identical column names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators import clean, profile, scale, split
from tabforge.session import table
from tabforge.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

ROUND = 6


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r(c, n: int = ROUND):
    return F.round(F.col(f"`{c}`") if isinstance(c, str) else c, n)


def clean_orders(spark, sf_dir) -> DataFrame:
    """fx_orders after the format step: non-finite -> NULL."""
    return clean.nonfinite_to_null(fx.fx_orders(spark, sf_dir))


def folded_orders(spark, sf_dir) -> DataFrame:
    return split.assign_folds(clean_orders(spark, sf_dir), "ID", 42)


ORDER_NUMERIC = ["o_totalprice", "acctbal", "custkey", "const_col", "mostly_null", "price_twin"]


# ---------------------------------------------------------------- flagship
@register("i03_standardize")
def q_standardize(spark, sf_dir):
    """Clean, split by u(ID,'42'), fit mean/std on train, scale every fold."""
    df, _model = scale.standardize(folded_orders(spark, sf_dir), exclude=["ID", "label"])
    return df.select("ID", "fold", "label", *[r(c).alias(c) for c in ORDER_NUMERIC])


# ---------------------------------------------------------------- P-*
MESSY = {"o_orderkey": "o order-key", "o_custkey": "o.cust key", "o_orderstatus": "o_order status!",
         "o_totalprice": "o_total(price)", "o_orderpriority": "o/order%priority"}


@register("p01_sanitize_columns")
def q_sanitize(spark, sf_dir):
    o = table(spark, sf_dir, "orders").drop("o_orderdate")
    messy = o.toDF(*[MESSY.get(c, c) for c in o.columns])
    return clean.sanitize_columns(messy)


@register("p02_cast_columns")
def q_cast(spark, sf_dir):
    df = clean.cast_columns(fx.fx_orders(spark, sf_dir),
                            "%7B%22custkey%22%3A%20%22int64%22%2C%20%22label%22%3A%20%22float64%22%2C"
                            "%20%22o_orderstatus%22%3A%20%22category%22%7D")
    return df.select("ID", "custkey", "label", "o_orderstatus")


@register("p03_nonfinite_to_null")
def q_nonfinite(spark, sf_dir):
    return clean_orders(spark, sf_dir).select("ID", "o_totalprice", "acctbal", "mostly_null")


@register("p04_duplicate_keys")
def q_dupkeys(spark, sf_dir):
    return clean.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("p05_label_encode")
def q_label_encode(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ID"),
                                              F.col("o_orderpriority").alias("label"))
    enc, _mapping = clean.label_encode(o, "label")
    return enc


@register("p07_replace_values")
def q_replace(spark, sf_dir):
    df = clean.replace_values(fx.fx_orders(spark, sf_dir),
                              {"mktsegment": {"BUILDING": "BLDG", "MACHINERY": "MACH"},
                               "o_orderstatus": {"F": "FINISHED"}})
    return df.select("ID", "mktsegment", "o_orderstatus")


@register("p08_keep_numeric")
def q_keep_numeric(spark, sf_dir):
    return clean.keep_numeric(clean_orders(spark, sf_dir), keep=["ID", "label"])


@register("p09_strip_commas")
def q_strip_commas(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return clean.strip_commas(d)


@register("p10_select_columns")
def q_select(spark, sf_dir):
    return clean.select_columns(fx.fx_orders(spark, sf_dir), "ID,mktsegment,%20label")


@register("p11_select_complement")
def q_complement(spark, sf_dir):
    return clean.select_complement(fx.fx_orders(spark, sf_dir), "o_orderdate,mktsegment,o_orderstatus")


@register("p12_split_roles")
def q_roles(spark, sf_dir):
    from tabforge.bundle import split_roles
    X, y, xtra = split_roles(clean_orders(spark, sf_dir), "label", "o_orderdate,const_col")
    return X.drop("o_orderdate")


# ---------------------------------------------------------------- A-*
@register("a01_profile")
def q_profile(spark, sf_dir):
    return profile.profile(fx.fx_orders(spark, sf_dir))


@register("a04_preview")
def q_preview(spark, sf_dir):
    return profile.preview(clean_orders(spark, sf_dir), "ID", 5).select("ID", "o_totalprice", "mktsegment", "label")


@register("a05_column_means")
def q_means(spark, sf_dir):
    m = profile.column_means(clean_orders(spark, sf_dir), ORDER_NUMERIC + ["label"])
    return m.select("metric", r("value").alias("value"))


@register("a06_column_modes")
def q_modes(spark, sf_dir):
    return profile.column_modes(clean_orders(spark, sf_dir), ["mktsegment", "o_orderstatus"])


@register("a08_class_counts")
def q_class_counts(spark, sf_dir):
    return profile.class_counts(folded_orders(spark, sf_dir), "fold", "label")


# ---------------------------------------------------------------- B-00, B-01
@register("b00_assign_folds")
def q_folds(spark, sf_dir):
    return folded_orders(spark, sf_dir).select("ID", "fold", "label")


@register("b00_exact_folds")
def q_exact_folds(spark, sf_dir):
    return split.assign_folds(fx.fx_orders(spark, sf_dir).select("ID", "label"), "ID", 42, exact=True)


@register("b01_downsample")
def q_downsample(spark, sf_dir):
    return split.downsample(fx.fx_orders(spark, sf_dir).select("ID", "label"), "label", "ID", "downsample")


# ---------------------------------------------------------------- D-*
from tabforge.operators import features as feat  # noqa: E402
from tabforge.operators import windows as win  # noqa: E402


def orders_plan(spark, sf_dir, prune: bool):
    df = folded_orders(spark, sf_dir)
    plan = feat.fit_features(df.where(F.col("fold") == "train"), key="ID", exclude=["label", "fold"],
                             remove_low_info=prune, remove_high_corr=prune,
                             remove_high_nan=prune, remove_single_val=prune)
    return df, plan


def _no_datetime(plan):
    return [d for d in plan.defs if d["type"] != "datetime"]


@register("d01_dfs_features")
def q_dfs(spark, sf_dir):
    """Identity, IS_NULL, WEEKDAY, depth-2 stacking and one-hot encoding, fitted
    on train and replayed on every fold (datetime identity left out of the output)."""
    df, plan = orders_plan(spark, sf_dir, prune=False)
    plan.defs = _no_datetime(plan)
    return plan.transform(df, keep=["fold"])


@register("d05_one_hot")
def q_one_hot(spark, sf_dir):
    """Top-10 one-hot + unknown for p_brand and p_size (as category), long form."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ID"), "p_brand",
                                           F.col("p_size").cast("string").alias("p_size"))
    p = split.assign_folds(p, "ID", 42)
    plan = feat.fit_features(p.where(F.col("fold") == "train"), key="ID", exclude=["fold"],
                             primitives=(), remove_low_info=False, remove_high_corr=False,
                             remove_high_nan=False, remove_single_val=False)
    wide = plan.transform(p)
    names = plan.names
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr("ID", f"stack({len(names)}, {stack}) AS (feature, flag)")


@register("d07_prune_features")
def q_prune(spark, sf_dir):
    """Low-information, correlated, highly-null and single-value removal on train."""
    _df, plan = orders_plan(spark, sf_dir, prune=True)
    rep = feat.plan_report(plan, spark)
    return rep.select("feature", "kept", F.coalesce("reason", F.lit("kept")).alias("reason"))


@register("d06_replay_plan")
def q_replay(spark, sf_dir):
    """Pruned plan fitted on train, replayed on the test fold."""
    df, plan = orders_plan(spark, sf_dir, prune=True)
    plan.defs = _no_datetime(plan)
    return plan.transform(df.where(F.col("fold") == "test"))


# ---------------------------------------------------------------- W-*
def events_with_gaps(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "ts",
                    F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
                    .otherwise(F.col("value")).alias("value"))


@register("w01_cumulative_sum")
def q_cumsum(spark, sf_dir):
    out = win.cumulative_sum(events_with_gaps(spark, sf_dir), "value", ["ts"], "cum_value",
                             group="user_id", key="event_id")
    return out.select("event_id", "user_id", r("cum_value").alias("cum_value"))


@register("w01_cumulative_sum_global")
def q_cumsum_global(spark, sf_dir):
    out = win.cumulative_sum(events_with_gaps(spark, sf_dir), "value", ["event_id"], "cum_value")
    return out.select("event_id", r("cum_value", 4).alias("cum_value"))


@register("w02_percent_change")
def q_pct(spark, sf_dir):
    out = win.percent_change(events_with_gaps(spark, sf_dir), "value", ["ts"], "pct_change",
                             group="user_id", key="event_id")
    return out.select("event_id", "user_id", r("pct_change").alias("pct_change"))


@register("w03_top_values")
def q_top_values(spark, sf_dir):
    return win.top_values(table(spark, sf_dir, "part"), "p_brand", 10)


@register("w04_top_ranked")
def q_top_ranked(spark, sf_dir):
    scores = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("name")).agg(
        F.round(F.avg("p_retailprice"), 2).alias("importance"))
    return win.top_ranked(scores, "importance", "name", 20)


@register("w05_best_trial")
def q_best_trial(spark, sf_dir):
    return win.best_row(fx.fx_trials(spark, sf_dir), "score", "trial_id")


# ---------------------------------------------------------------- J-02, I-01, I-02
from tabforge.operators import impute as imp  # noqa: E402
from tabforge.operators import knn  # noqa: E402


def _knn_vectors(spark, sf_dir, strategy):
    v = fx.fx_vectors(spark, sf_dir)
    res = knn.knn_join(v, v, fx.vector_columns(), k=5, key="ID", exclude_self=True, strategy=strategy,
                       block_rows=200)
    return res.select("query_id", "donor_id", F.col("rank").cast("int").alias("rank"),
                      r("distance").alias("distance"))


@register("j02_knn_join")
def q_knn(spark, sf_dir):
    """Exact 5-NN of every embedding among the others (broadcast strategy)."""
    return _knn_vectors(spark, sf_dir, "broadcast")


@register("j02_knn_join_blocked")
def q_knn_blocked(spark, sf_dir):
    """Same result through the blocked (query block x donor block) strategy."""
    return _knn_vectors(spark, sf_dir, "blocked")


@register("j02_knn_within_class")
def q_knn_class(spark, sf_dir):
    """3-NN restricted to the same class (SMOTE's neighbour search)."""
    v = fx.fx_vectors(spark, sf_dir)
    res = knn.knn_join(v, v, fx.vector_columns(), k=3, key="ID", exclude_self=True, group="label",
                       strategy="blocked", block_rows=150)
    return res.select("query_id", "donor_id", F.col("rank").cast("int").alias("rank"),
                      r("distance").alias("distance"))


@register("i01_mean_impute")
def q_mean_impute(spark, sf_dir):
    df = folded_orders(spark, sf_dir)
    model = imp.fit_mean_imputer(df.where(F.col("fold") == "train"), exclude=["ID", "label"])
    out = model.transform(df)
    return out.select("ID", "fold", *[r(c).alias(c) for c in ORDER_NUMERIC])


@register("i02_knn_impute")
def q_knn_impute(spark, sf_dir):
    """5-NN nan-euclidean imputation of every NULL cell of fx_vectors(missing)."""
    v = fx.fx_vectors(spark, sf_dir, missing=True)
    model = imp.fit_knn_imputer(v, "ID", columns=fx.vector_columns(), k=5, block_rows=200)
    cells = model.imputed_cells(v)
    return cells.select("ID", "feature", r("value").alias("value"))


# ---------------------------------------------------------------- B-02 ... B-13
from tabforge.operators import balance as bal  # noqa: E402

TOXIC_NUM = ["n_chars", "n_spaces", "n_dots"]


def toxic_numeric(spark, sf_dir):
    return fx.fx_toxic(spark, sf_dir).select("ID", *TOXIC_NUM, "label")


def _over_out(df, cols):
    return df.select("ID", "label", *[r(c).alias(c) for c in cols], "is_synthetic", "draw_id")


@register("b02_random_oversample")
def q_ros(spark, sf_dir):
    return _over_out(bal.random_oversample(toxic_numeric(spark, sf_dir)), TOXIC_NUM)


@register("b03_smote")
def q_smote(spark, sf_dir):
    return _over_out(bal.smote(toxic_numeric(spark, sf_dir), features=TOXIC_NUM, block_rows=100), TOXIC_NUM)


@register("b04_smotenc")
def q_smotenc(spark, sf_dir):
    df = fx.fx_toxic(spark, sf_dir)
    out = bal.smote(df, features=TOXIC_NUM, cat_features=["lang", "source"], block_rows=100)
    return out.select("ID", "label", *[r(c).alias(c) for c in TOXIC_NUM], "lang", "source",
                      "is_synthetic", "draw_id")


@register("b05_smoten")
def q_smoten(spark, sf_dir):
    df = fx.fx_toxic(spark, sf_dir).select("ID", "lang", "source", "label")
    out = bal.smote(df, features=[], cat_features=["lang", "source"], block_rows=100)
    return out.select("ID", "label", "lang", "source", "is_synthetic", "draw_id")


@register("b06_adasyn")
def q_adasyn(spark, sf_dir):
    return _over_out(bal.adasyn(toxic_numeric(spark, sf_dir), features=TOXIC_NUM, block_rows=150), TOXIC_NUM)


@register("b07_borderline_smote")
def q_borderline(spark, sf_dir):
    return _over_out(bal.borderline_smote(toxic_numeric(spark, sf_dir), features=TOXIC_NUM, block_rows=150),
                     TOXIC_NUM)


@register("b08_kmeans_smote")
def q_kmeans_smote(spark, sf_dir):
    return _over_out(bal.kmeans_smote(toxic_numeric(spark, sf_dir), features=TOXIC_NUM, block_rows=150),
                     TOXIC_NUM)


def _under(spark, sf_dir, fn, **kw):
    return fn(toxic_numeric(spark, sf_dir), features=TOXIC_NUM, block_rows=150, **kw).select("ID", "label")


@register("b09_near_miss_1")
def q_nm1(spark, sf_dir):
    return _under(spark, sf_dir, bal.near_miss, version=1)


@register("b10_near_miss_2")
def q_nm2(spark, sf_dir):
    return _under(spark, sf_dir, bal.near_miss, version=2)


@register("b11_near_miss_3")
def q_nm3(spark, sf_dir):
    return _under(spark, sf_dir, bal.near_miss, version=3)


@register("b12_neighbourhood_cleaning")
def q_ncr(spark, sf_dir):
    return _under(spark, sf_dir, bal.neighbourhood_cleaning)


@register("b13_one_sided_selection")
def q_oss(spark, sf_dir):
    return _under(spark, sf_dir, bal.one_sided_selection)


# ---------------------------------------------------------------- A-10 ... A-12, P-16
from tabforge.operators import report as rep  # noqa: E402


@register("a10_classification_report")
def q_report(spark, sf_dir):
    out = rep.classification_report(fx.fx_scores(spark, sf_dir), "label", "yhat")
    return out.select("metric", r("value").alias("value"))


@register("a11_neg_rmse")
def q_rmse(spark, sf_dir):
    return rep.neg_rmse(fx.fx_scores(spark, sf_dir), "label", "p").select(r("neg_rmse").alias("neg_rmse"))


@register("a12_brier_score")
def q_brier(spark, sf_dir):
    return rep.brier_score(fx.fx_scores(spark, sf_dir), "label", "p").select(r("brier").alias("brier"))


@register("p16_classify")
def q_classify(spark, sf_dir):
    s = fx.fx_scores(spark, sf_dir)
    return s.select("ID", clean.classify("p", 0.5).alias("yhat"))


# ---------------------------------------------------------------- M-*
from tabforge.operators import model as mdl  # noqa: E402
from tabforge.operators import sweep as swp  # noqa: E402
from tabforge.operators.variant import fold_variants  # noqa: E402


def toxic_folds(spark, sf_dir):
    return split.assign_folds(toxic_numeric(spark, sf_dir), "ID", 42)


def _toxic_model(spark, sf_dir, task="Classification"):
    df = toxic_folds(spark, sf_dir)
    if task == "Regression":
        df = df.drop("label").withColumnRenamed("n_chars", "label")
    feats = [c for c in TOXIC_NUM if c in df.columns]
    parts, _base = fold_variants(df, "mean", "none", features=feats)
    model = mdl.fit_gbt(parts["train"], feats, "label", mdl.TrialParams(max_depth=5, num_leaves=31),
                        task, valid=parts["valid"])
    return model, parts


@register("m01_gbt_classifier")
def q_gbt(spark, sf_dir):
    model, parts = _toxic_model(spark, sf_dir)
    return model.predict(parts["test"]).select("ID", "label", "yhat", r("p").alias("p"))


@register("m02_gbt_regressor")
def q_gbt_reg(spark, sf_dir):
    model, parts = _toxic_model(spark, sf_dir, "Regression")
    return model.predict(parts["test"]).select("ID", "label", r("yhat").alias("yhat"))


@register("m04_predict_report")
def q_predict_report(spark, sf_dir):
    model, parts = _toxic_model(spark, sf_dir)
    out = rep.classification_report(model.predict(parts["test"]), "label", "yhat")
    return out.select("metric", r("value").alias("value"))


@register("m05_sweep")
def q_sweep(spark, sf_dir):
    df = toxic_folds(spark, sf_dir)
    trials = swp.trial_table(spark, 3, ["mean", "knn"], ["none", "ros", "smote"])
    table, _models = swp.run_sweep(df, trials, features=TOXIC_NUM, parallelism=3)
    return table.select("trial_id", "imputer", "balancer", r("score").alias("score"))


@register("m05_trial_table")
def q_trial_table(spark, sf_dir):
    """Sweep parameters drawn for every part key as a trial id."""
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("trial_id"))
    t = swp.draw_trials(ids, ["mean", "knn"], ["none", "ros", "smote"])
    return t.select("trial_id", "imputer", "balancer", "max_depth", "num_leaves",
                    *[r(c).alias(c) for c in ("colsample", "subsample", "learning_rate")])


@register("m07_sweep_summary")
def q_sweep_summary(spark, sf_dir):
    t = fx.fx_trials(spark, sf_dir)
    s = swp.sweep_summary(t.select("trial_id", "score"), t.select("trial_id", "imputer", "balancer"))
    return s.select("best_trial_id", "num_balancer", "num_imputer",
                    F.size("sweep_run_ids").alias("n_trials"),
                    F.array_join(F.transform("sweep_run_ids", lambda x: x.cast("string")), ",").alias("run_ids"),
                    F.array_join("sweep_balancer", ",").alias("balancers"))


@register("m08_feature_ranking")
def q_rank(spark, sf_dir):
    model, _parts = _toxic_model(spark, sf_dir)
    return mdl.rank_features(model, spark, 20)


@register("m08_shap_ranking")
def q_shap_rank(spark, sf_dir):
    """Top-20 features by mean |Shapley value| of the fx_toxic model over the whole test fold."""
    model, parts = _toxic_model(spark, sf_dir)
    return mdl.rank_features(model, spark, 20, method="shap", data=parts["test"])


@register("m08_shap_importance")
def q_shap_importance(spark, sf_dir):
    """Mean |Shapley value| per feature (every feature, not only the top 20)."""
    model, parts = _toxic_model(spark, sf_dir)
    imp_df = mdl.feature_importances(model, spark, "shap", parts["test"])
    return imp_df.select("feature", r("importance").alias("importance"))


@register("m09_calibrate")
def q_calibrate(spark, sf_dir):
    model, parts = _toxic_model(spark, sf_dir)
    cal = mdl.calibrate(model, parts["valid"], parts["test"])
    return spark.createDataFrame([(round(cal.brier_before, 6), round(cal.brier_after, 6), cal.used)],
                                 "brier_before double, brier_after double, calibrated boolean")


# ---------------------------------------------------------------- R-*, U-*, P-17
import uuid  # noqa: E402

from tabforge.operators import runlog  # noqa: E402
from tabforge.session import ensure_checkpoint_dir  # noqa: E402


def scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabforge-scratch/{name}-{uuid.uuid4().hex[:12]}"


def runs_long(spark, sf_dir):
    runs = runlog.with_end_time(fx.fx_runs(spark, sf_dir))
    return runlog.job_rows(runs, metrics=["metric"])


@register("r01_run_log")
def q_run_log(spark, sf_dir):
    merged = runlog.merge_last_writer(runs_long(spark, sf_dir))
    return merged.select("run_id", "key", r("num_value").alias("num_value"), "str_value")


@register("r01_run_row_wide")
def q_run_row(spark, sf_dir):
    merged = runlog.merge_last_writer(runs_long(spark, sf_dir))
    keys = sorted(r_[0] for r_ in merged.select("key").distinct().collect())
    wide = runlog.run_rows(merged, keys, {k for k in keys if k.endswith(".duration") or k == "metric"},
                           header={"experiment": "fx_runs", "downsample": "False", "drop_bools": "False"})
    return wide.select(*[r(c).alias(c) if (c.endswith(".duration") or c == "metric") else F.col(f"`{c}`")
                         for c in wide.columns])


@register("r02_duration_minutes")
def q_duration(spark, sf_dir):
    runs = runlog.with_end_time(fx.fx_runs(spark, sf_dir))
    return runs.select("seq", runlog.duration_minutes(F.col("start_ts"), F.col("end_ts")).alias("duration"))


@register("p17_completed")
def q_completed(spark, sf_dir):
    return clean.completed(fx.fx_runs(spark, sf_dir)).select("run_id", "job", "seq")


def _day_parity():
    return F.datediff(F.to_date("start_ts"), F.lit("2024-01-01").cast("date")) % 2


@register("u01_union_outer")
def q_union(spark, sf_dir):
    runs = fx.fx_runs(spark, sf_dir).withColumn("__even", _day_parity() == 0)
    even = runs.where("__even").select("run_id", "job", "seq", "status")
    odd = runs.where("NOT __even").select("seq", "run_id", "metric", F.col("job").alias("job"))
    return runlog.union_outer([even, odd]).select("run_id", "job", "seq", "status", "metric")


@register("u03_merge_last_writer")
def q_merge(spark, sf_dir):
    runs = runlog.with_end_time(fx.fx_runs(spark, sf_dir))
    long = runs.select("run_id", F.col("job").alias("key"), F.col("metric").alias("num_value"),
                       F.lit(None).cast("string").alias("str_value"), "end_ts", "seq")
    return runlog.merge_last_writer(long).select("run_id", "key", r("num_value").alias("num_value"))


# ---------------------------------------------------------------- S-*
from tabforge.sources import catalog as gold  # noqa: E402
from tabforge.sources import delimited, history, stage  # noqa: E402


@register("s01_read_delimited")
def q_read_delimited(spark, sf_dir):
    """orders written as ';' CSV with messy headers, read back, sanitised and typed."""
    path = scratch(spark, "delimited")
    o = table(spark, sf_dir, "orders").drop("o_orderdate")
    delimited.write_delimited(o.toDF(*[MESSY.get(c, c) for c in o.columns]), path, "semicolon")
    df = clean.sanitize_columns(delimited.read_delimited(spark, path, "semicolon"))
    return clean.cast_columns(df, {"oorderkey": "int64", "ocustkey": "int64", "o_totalprice": "float64",
                                   "o_orderstatus": "category", "oorderpriority": "category"})


@register("s03_stage_roundtrip")
def q_stage(spark, sf_dir):
    """Folds staged as Parquet partitioned by fold; the read prunes to test."""
    path = scratch(spark, "stage")
    stage.write_stage(folded_orders(spark, sf_dir).select("ID", "label", "fold"), path, partition_by="fold")
    return stage.read_stage(spark, path).where(F.col("fold") == "test").select("ID", "label")


@register("s06_gold_roundtrip")
def q_gold(spark, sf_dir):
    root = scratch(spark, "gold")
    df = toxic_folds(spark, sf_dir)
    gold.publish_gold(df, root, "toxic", downsample=False, drop_bools=True, imputers="mean", balancers="smote")
    gold.publish_gold(df.where(F.col("fold") == "test"), root, "toxic", downsample=False, drop_bools=True)
    latest = gold.read_gold(spark, root, "toxic", downsample=False, drop_bools=True)
    return latest.select("ID", "label", "fold")


@register("s08_registry_tags")
def q_registry_tags(spark, sf_dir):
    t = fx.fx_trials(spark, sf_dir)
    keys = t.select(F.concat(F.lit("imputer____"), F.col("imputer")).alias("key")).unionByName(
        t.select(F.concat(F.lit("balancer____"), F.col("imputer"), F.lit("_"), F.lower("balancer")).alias("key")))
    return gold.registry_tags(keys)


def _write_deltas(spark, sf_dir) -> str:
    folder = scratch(spark, "history")
    runs = fx.fx_runs(spark, sf_dir).withColumn("day", F.datediff(F.to_date("start_ts"),
                                                                  F.lit("2024-01-01").cast("date")))
    even = runs.where(F.col("day") % 2 == 0).select("day", "run_id", "job", "seq", "status")
    odd = runs.where(F.col("day") % 2 == 1).select("day", "seq", "metric", "run_id", "job", "status")
    even.write.partitionBy("day").option("header", True).csv(f"{folder}/even")
    odd.write.partitionBy("day").option("header", True).csv(f"{folder}/odd")
    return folder


def _history_out(df):
    return df.select(F.col("run_id").cast("string").alias("run_id"), F.col("job").cast("string").alias("job"),
                     F.col("seq").cast("long").alias("seq"), F.col("metric").cast("double").alias("metric"))


@register("s11_compact_history")
def q_compact(spark, sf_dir):
    folder = _write_deltas(spark, sf_dir)
    for sub in ("even", "odd"):  # two compactions: the second appends to the first
        hist = history.compact_history(spark, folder, pattern=f"{sub}/*/*.csv")
    return _history_out(hist)


@register("s12_compact_stream")
def q_compact_stream(spark, sf_dir):
    from tabforge.streaming.compact_stream import compact_history_stream
    folder = _write_deltas(spark, sf_dir)
    import os
    hist = None
    for sub in ("even", "odd"):
        hist = compact_history_stream(spark, f"{folder}/{sub}", f"{folder}/_ckpt_{sub}",
                                      history=f"{folder}/_stream_history", max_files_per_trigger=50)
    del os
    return _history_out(hist)


# ---------------------------------------------------------------- I-04, X-01
from tabforge.operators import outliers as iso  # noqa: E402


@register("i04_isolation_forest")
def q_iforest(spark, sf_dir):
    df = clean_orders(spark, sf_dir)
    feats = ["o_totalprice", "acctbal", "custkey", "price_twin"]
    filled = imp.fit_mean_imputer(df, feats).transform(df)
    model = iso.fit_isolation_forest(filled, feats, "ID")
    return model.score(filled, "ID").select("ID", r("outlier_score").alias("outlier_score"), "outlier")


@register("x01_custom_primitive")
def q_primitive(spark, sf_dir):
    """The running-sum primitive, registered and applied through the registry."""
    out = feat.apply_sequence_primitive(events_with_gaps(spark, sf_dir), "CUM_SUM", "value", ["ts"],
                                        group="user_id", key="event_id")
    return out.select("event_id", "user_id", r("CUM_SUM(value)").alias("cum_value"))


def _halved(x):
    """A user's vectorized primitive."""
    return x / 2


@register("x01_primitives_in_a_plan")
def q_primitives_in_a_plan(spark, sf_dir):
    """Sequence, row and vectorized primitives synthesized together; the saved plan is read again and
    replayed: running sums per user, and halves of them."""
    if "HALF" not in feat.ROW_PRIMITIVES:
        feat.register_vectorized_primitive("HALF", "numeric", "numeric", _halved, "double", "half of {}")
    df = events_with_gaps(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    plan = feat.fit_features(df, "event_id", exclude=["ts", "user_id"], primitives=["CUM_SUM", "HALF"], max_depth=2, order=["ts"], group="user_id",
                             remove_low_info=False, remove_high_corr=False, remove_high_nan=False, remove_single_val=False)
    plan = feat.FeaturePlan.from_json(plan.to_json())
    out = plan.transform(df, keep=["user_id"])
    return out.select("event_id", "user_id", r("CUM_SUM(value)").alias("cum_value"), r("HALF(CUM_SUM(value))").alias("half_cum"),
                      r("CUM_SUM(HALF(value))").alias("cum_half"))


# ---------------------------------------------------------------- X-02 ... X-04
from tabforge.config import CompactConfig, FeaturizeConfig, TrainConfig  # noqa: E402


@register("x02_featurize")
def q_featurize(spark, sf_dir):
    """The whole featurize plan on fx_orders (label 1-URGENT vs rest)."""
    cfg = FeaturizeConfig(project="orders", label="label", root=scratch(spark, "featurize"),
                          unwanted="o_orderstatus", imputers=["mean", "knn"])
    res = featurize_plan(spark, cfg, fx.fx_orders(spark, sf_dir))
    from pyspark.sql import types as T
    out = res.data.where(F.col("fold") == "train")
    return out.select("ID", "label", *[
        F.col(f"`{f.name}`") if isinstance(f.dataType, T.BooleanType) else r(f.name).alias(f.name)
        for f in out.schema.fields if f.name not in ("ID", "label", "fold")])


@register("x03_train")
def q_train(spark, sf_dir):
    """Featurize fx_toxic, then a 3-trial sweep, best trial, calibration and registry."""
    root = scratch(spark, "train")
    cfg = FeaturizeConfig(project="toxic", label="label", root=root, imputers=["mean"])
    featurize_plan(spark, cfg, fx.fx_toxic(spark, sf_dir))
    res = train_plan(spark, TrainConfig(project="toxic", label="label", root=root, imputers=["mean"],
                                        balancers=["none", "ros"], num_trials=3, parallelism=3))
    return res.trials.select("trial_id", "imputer", "balancer", r("score").alias("score"))


@register("x04_compact")
def q_compact_plan(spark, sf_dir):
    """runinfo deltas (differing headers) compacted by the compact plan."""
    root = scratch(spark, "compact")
    runs = fx.fx_runs(spark, sf_dir).withColumn("day", F.datediff(F.to_date("start_ts"),
                                                                  F.lit("2024-01-01").cast("date")))
    even = runs.where(F.col("day") % 2 == 0).select("run_id", "job", "seq", "status")
    odd = runs.where(F.col("day") % 2 == 1).select("seq", "metric", "run_id", "job", "status")
    even.write.option("header", True).csv(f"{root}/fx/runinfo/even")
    odd.write.option("header", True).csv(f"{root}/fx/runinfo/odd")
    for sub in ("even", "odd"):  # move parts to the folder root as delta files
        history_move(spark, f"{root}/fx/runinfo/{sub}", f"{root}/fx/runinfo", sub)
    out = compact_plan(spark, CompactConfig(root=root, project="fx", export_csv=False))
    return _history_out(out["runinfo"])


def history_move(spark, src: str, dst: str, prefix: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(src)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.endswith(".csv"):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(f"{dst}/{prefix}-{name}"))


from tabforge.plans.compact import compact as compact_plan  # noqa: E402
from tabforge.plans.featurize import featurize as featurize_plan  # noqa: E402
from tabforge.plans.train import train as train_plan  # noqa: E402


@register("b03_smote_orders")
def q_smote_orders(spark, sf_dir):
    """SMOTE on the cleaned, mean-imputed numeric fx_orders columns (about 20 % positive)."""
    feats = ["o_totalprice", "acctbal", "custkey"]
    df = clean_orders(spark, sf_dir).select("ID", *feats, "label")
    df = imp.fit_mean_imputer(df, feats).transform(df)
    out = bal.smote(df, features=feats, strategy="blocked", block_rows=5000)
    return out.select("ID", "label", *[r(c).alias(c) for c in feats], "is_synthetic", "draw_id")


@register("j02_knn_join_partitioned")
def q_knn_partitioned(spark, sf_dir):
    """Same result through the range-pruned partitioned strategy."""
    return _knn_vectors(spark, sf_dir, "partitioned")


@register("j02_knn_join_pivots")
def q_knn_pivots(spark, sf_dir):
    """Same result through pivots and triangle-inequality bounds."""
    return _knn_vectors(spark, sf_dir, "pivots")


@register("j02_knn_farthest_pivots")
def q_knn_farthest(spark, sf_dir):
    """The 3 farthest neighbours of every row, cells visited in the order of their upper bounds."""
    v = fx.fx_vectors(spark, sf_dir)
    res = knn.knn_join(v, v, fx.vector_columns(), k=3, key="ID", exclude_self=True, strategy="pivots", block_rows=400, farthest=True)
    return res.select("query_id", "donor_id", F.col("rank").cast("int").alias("rank"), r("distance").alias("distance"))


# ---------------------------------------------------------------- P-13, P-14, S-05, S-09, S-10
@register("p13_align_columns")
def q_align(spark, sf_dir):
    """Test rows projected into the train frame's column order."""
    df = folded_orders(spark, sf_dir)
    train = df.where(F.col("fold") == "train").select("label", "ID", "price_twin", "acctbal")
    return clean.align_columns(df.where(F.col("fold") == "test"), train)


@register("p14_normalize_booleans")
def q_booleans(spark, sf_dir):
    df = clean_orders(spark, sf_dir).select("ID", (F.col("o_totalprice") > 100000).alias("big"),
                                            (F.col("mktsegment") == "BUILDING").alias("building"))
    return clean.normalize_booleans(df, fill_null=False)


@register("s05_bundle_roundtrip")
def q_bundle(spark, sf_dir):
    """Bundle (rows by fold + roles + fitted scaler) saved and loaded back."""
    from tabforge.bundle import TableBundle
    df, model = scale.standardize(folded_orders(spark, sf_dir).select("ID", "label", "fold", "o_totalprice",
                                                                      "acctbal"), exclude=["ID", "label"])
    path = scratch(spark, "bundle")
    stage.save_bundle(TableBundle(df, "ID", "label", ["o_totalprice", "acctbal"], [], "fold"), path,
                      {"scaler": model.to_json()})
    b, fitted = stage.load_bundle(spark, path)
    assert set(fitted["scaler"]["means"]) == {"o_totalprice", "acctbal"}
    return b.df.select("ID", "label", "fold", r("o_totalprice").alias("o_totalprice"), r("acctbal").alias("acctbal"))


@register("s09_write_metrics")
def q_metrics(spark, sf_dir):
    """Profile metrics written as JSON lines and read back."""
    path = scratch(spark, "metrics")
    stage.write_metrics(profile.profile(fx.fx_orders(spark, sf_dir)), path)
    return spark.read.schema("metric string, value bigint").json(path)


@register("s10_write_run_row")
def q_run_row_sink(spark, sf_dir):
    """Each run's wide row written as its own delta CSV, compacted back."""
    root = scratch(spark, "runrows")
    merged = runlog.merge_last_writer(runs_long(spark, sf_dir))
    wide = runlog.run_rows(merged, ["metric"], {"metric"}).withColumnRenamed("run_id", "runId")
    # one delta per run, as the run-log step writes them; rows are few bytes and files are many, so the
    # number of writing tasks is given (by their bytes alone, Spark would make one task of them)
    tasks = 4 * spark.sparkContext.defaultParallelism
    wide.repartition(tasks, "runId").write.partitionBy("runId").option("header", True).csv(f"{root}/p/runinfo")
    files = history.list_deltas(spark, f"{root}/p/runinfo", "*/*.csv")
    back = history.read_deltas(spark, files)
    return back.select(F.col("metric").cast("double").alias("metric")).select(r("metric").alias("metric"))


@register("b01_downsample_folds")
def q_downsample_folds(spark, sf_dir):
    """Down-sampling inside every fold, on a boolean label."""
    df = split.assign_folds(fx.fx_orders(spark, sf_dir).select("ID", "label"), "ID", 42)
    out = split.downsample(df.withColumn("label", F.col("label") == 1), "label", "ID", "downsample", fold="fold")
    return out.select("ID", "fold", F.col("label").cast("int").alias("label"))


@register("j01_attach_label")
def q_attach_label(spark, sf_dir):
    """A label table delivered apart from its features, joined back one to one."""
    from tabforge.bundle import attach_label
    df = fx.fx_orders(spark, sf_dir).select("ID", "o_orderstatus", "label")
    return attach_label(df.drop("label"), df.select("ID", "label"))


@register("s13_model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """The calibrated model saved, registered, loaded back by its registry row, and applied to the
    test fold: every row must carry the in-memory model's probability."""
    from tabforge.sources import catalog
    model, parts = _toxic_model(spark, sf_dir)
    cal = mdl.calibrate(model, parts["valid"], parts["test"])
    root = scratch(spark, "models")
    path = stage.save_model(cal, f"{root}/toxic/m1", {"runId": "m1"})
    catalog.register_model(spark, root, "toxic", path, {"calibrated": cal.used})
    entry = catalog.list_versions(spark, root, "models", "toxic").orderBy(F.desc("version")).first()
    loaded, _desc = stage.load_model(spark, entry["path"])
    a = cal.predict(parts["test"]).select("ID", F.col("p").alias("p_memory"))
    b = loaded.predict(parts["test"]).select("ID", F.col("p").alias("p_loaded"))
    return a.join(b, "ID").select("ID", r("p_loaded").alias("p"), (F.abs(F.col("p_memory") - F.col("p_loaded")) < 1e-12).alias("same"))


@register("b15_variant")
def q_variant(spark, sf_dir):
    """The valid fold of the (mean, ros) variant: imputed by the train fit, never balanced."""
    from tabforge.operators.variant import variant
    df = toxic_folds(spark, sf_dir)
    out = variant(df, "valid", "mean", "ros", features=TOXIC_NUM)
    return out.select("ID", "label", *[r(c).alias(c) for c in TOXIC_NUM])


@register("m08_permutation_importance")
def q_perm(spark, sf_dir):
    """Permutation importance of the fx_toxic model on the test fold."""
    model, parts = _toxic_model(spark, sf_dir)
    imp_df = mdl.permutation_importance(model, parts["test"], "ID")
    return imp_df.select("feature", r("importance").alias("importance"))


@register("i02_knn_impute_partitioned")
def q_knn_impute_partitioned(spark, sf_dir):
    """I-02 through the range-pruned strategy (auto uses it in few dimensions)."""
    v = fx.fx_vectors(spark, sf_dir, missing=True)
    model = imp.fit_knn_imputer(v, "ID", columns=fx.vector_columns(), k=5, block_rows=200,
                                strategy="partitioned")
    return model.imputed_cells(v).select("ID", "feature", r("value").alias("value"))


@register("i02_knn_impute_patterns")
def q_knn_impute_patterns(spark, sf_dir):
    """I-02 through cells of presence pattern and region."""
    v = fx.fx_vectors(spark, sf_dir, missing=True)
    model = imp.fit_knn_imputer(v, "ID", columns=fx.vector_columns(), k=5, block_rows=400, strategy="patterns")
    return model.imputed_cells(v).select("ID", "feature", r("value").alias("value"))
