"""X-02 featurize: input -> format -> roles -> split -> downsample -> features
-> stats -> standardise -> imputers -> balancers -> gold + run log.

One lazy plan through the split; actions only at fits (label mapping,
feature plan, scaler, imputers, balancers), profile metrics and writes."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.bundle import package
from tabforge.config import FeaturizeConfig
from tabforge.operators import balance, clean, features, impute, profile, scale, split
from tabforge.operators.runlog import LONG_SCHEMA, StepTimer, merge_last_writer, run_rows
from tabforge.sources import catalog
from tabforge.sources.delimited import read_delimited
from tabforge.sources.history import write_run_row
from tabforge.sources.stage import _read_text, _write_text


@dataclass
class FeaturizeResult:
    data: DataFrame            # key, label, fold, features (scaled)
    plan: features.FeaturePlan
    scaler: scale.StandardScalerModel
    imputers: dict
    balancers: list[str]
    metrics: DataFrame         # long run-log rows
    gold: dict
    run_id: str
    state_path: str            # plan, scaler and imputers, beside the gold data
    run_row: str               # the delta in the runinfo folder


def featurize(spark: SparkSession, cfg: FeaturizeConfig, df: DataFrame | None = None) -> FeaturizeResult:
    run_id = uuid.uuid4().hex
    timer = StepTimer(run_id)
    metric_frames = []

    def metrics_of(frame: DataFrame, value_type: str = "double"):
        metric_frames.append(frame.select(F.lit(run_id).alias("run_id"), F.col("metric").alias("key"),
                                          F.col("value").cast("double").alias("num_value"),
                                          F.lit(None).cast("string").alias("str_value"),
                                          F.lit(None).cast("timestamp").alias("end_ts"),
                                          F.lit(len(metric_frames)).cast("long").alias("seq")))

    with timer.step("input"):
        if df is None:
            df = read_delimited(spark, cfg.input, cfg.separator)
        metrics_of(profile.profile(df))
    with timer.step("format"):
        df = clean.sanitize_columns(df)
        if cfg.datatypes:
            df = clean.cast_columns(df, cfg.datatypes)
        if cfg.convert_inf:
            df = clean.nonfinite_to_null(df)
        df, _mapping = clean.label_encode(df, cfg.label, cfg.task, cfg.encode_regression)
        if cfg.replacements:
            df = clean.replace_values(df, cfg.replacements)
        if cfg.drop_bools:
            df = clean.keep_numeric(df, keep=[cfg.key, cfg.label])
        if cfg.remove_commas:
            df = clean.strip_commas(df)
    bundle = package(df, cfg.key, cfg.label, cfg.unwanted)
    data = bundle.df.select(cfg.key, cfg.label, *[F.col(f"`{c}`") for c in bundle.features])
    with timer.step("split"):
        data = split.assign_folds(data, cfg.key, cfg.seed, cfg.test_size, cfg.valid_size).persist()
        stages = [data]  # persisted stage outputs, released once the gold copy is written
        metrics_of(profile.class_counts(data, "fold", cfg.label))
    if cfg.downsample:
        with timer.step("downsample"):
            data = split.downsample(data, cfg.label, cfg.key, fold="fold").persist()
            stages.append(data)
    with timer.step("dfs"):
        train = data.where(F.col("fold") == "train")
        metrics_of(profile.dtype_histogram(train.drop("fold", cfg.label, cfg.key), "predfs"))
        plan = features.fit_features(train, cfg.key, exclude=[cfg.label, "fold"],
                                     remove_low_info=cfg.remove_low_info, remove_high_corr=cfg.remove_high_corr,
                                     remove_high_nan=cfg.remove_high_nan, remove_single_val=cfg.remove_single_val)
        plan.defs = [d for d in plan.defs if d["type"] != "datetime"]  # models take numbers and flags
        data = plan.transform(data, keep=[cfg.label, "fold"]).persist()
        stages.append(data)
        metrics_of(profile.dtype_histogram(data.drop("fold", cfg.label, cfg.key), "postdfs"))
    train = data.where(F.col("fold") == "train")
    with timer.step("stats"):
        metrics_of(profile.column_means(train.drop(cfg.key, cfg.label, "fold")))
    with timer.step("standardize"):
        data, scaler = scale.standardize(data, exclude=[cfg.key, cfg.label])
    train = data.where(F.col("fold") == "train")
    feats = [c for c in data.columns if c not in (cfg.key, cfg.label, "fold")]
    fitted = {}
    with timer.step("impute"):
        for name in cfg.imputers:
            fitted[name] = impute.fit_imputer(name, train.select(cfg.key, *[F.col(f"`{c}`").cast("double").alias(c)
                                                                            for c in feats]), cfg.key)
    from pyspark.sql import types as T
    flags = [c for c in feats if isinstance(data.schema[c].dataType, T.BooleanType)]
    names = balance.applicable_balancers(len(feats), len(flags), cfg.enable_slow)
    if cfg.materialize_balancers and cfg.task != "Regression":
        for imp_name, model in fitted.items():
            base = model.transform(train.select(cfg.key, cfg.label, *[F.col(f"`{c}`").cast("double").alias(c)
                                                                     for c in feats]))
            cont = [c for c in feats if c not in flags]
            for b in names:
                with timer.step(f"balancer.{imp_name}_{b}"):
                    try:
                        if b == "smote" and flags:  # SMOTENC / SMOTEN over the flags
                            balance.balance(b, base, cfg.key, cfg.label, cont, cat_features=flags).count()
                        else:
                            balance.balance(b, base, cfg.key, cfg.label, feats).count()
                    except Exception as e:  # recorded, the others go on
                        timer.rows.append((run_id, f"balancer.{imp_name}_{b}.error", None, str(e), None,
                                           len(timer.rows)))
    with timer.step("register"):
        gold = catalog.publish_gold(data, cfg.root, cfg.project, cfg.downsample, cfg.drop_bools,
                                    ",".join(sorted(fitted)), ",".join(sorted(names)))
    # continue from the written gold copy; the in-memory stages are released
    data = spark.read.parquet(gold["path"])
    for st in stages:
        st.unpersist()
    metrics = metric_frames[0]
    for m in metric_frames[1:]:
        metrics = metrics.unionByName(m)
    metrics = metrics.unionByName(timer.frame(spark)).unionByName(spark.createDataFrame(
        [(run_id, "runDate", None, dt.datetime.now(dt.timezone.utc).isoformat(), None, 0)], LONG_SCHEMA))
    state_path = save_state(spark, gold["path"], plan, scaler, fitted)
    metrics = metrics.persist()
    wide = run_rows(merge_last_writer(metrics), header={
        "experiment": cfg.project, "downsample": cfg.downsample, "drop_bools": cfg.drop_bools})
    delta = write_run_row(wide.withColumnRenamed("run_id", "runId"), cfg.root, cfg.project, "runinfo", run_id)
    return FeaturizeResult(data, plan, scaler, fitted, names, metrics, gold, run_id, state_path, delta)


def save_state(spark: SparkSession, gold_path: str, plan, scaler, imputers: dict) -> str:
    """Everything that scoring new rows needs, as JSON beside the gold data. The kNN imputer's
    donors are the gold train rows themselves, so only its parameters are stored."""
    path = f"{gold_path.rstrip('/')}-state/state.json"
    state = {"gold": gold_path, "plan": plan.to_json(), "scaler": scaler.to_json(), "imputers": {}}
    for name, m in imputers.items():
        means = m.means if name == "mean" else m.fallback.means
        state["imputers"][name] = {"means": means, **({"k": m.k, "features": m.features, "key": m.key} if name == "knn" else {})}
    _write_text(spark, path, json.dumps(state))
    return path


def load_state(spark: SparkSession, path: str) -> tuple:
    """(feature plan, scaler, imputers by name) as ``save_state`` wrote them."""
    state = json.loads(_read_text(spark, path))
    plan = features.FeaturePlan.from_json(state["plan"])
    scaler = scale.StandardScalerModel(**state["scaler"])
    out = {}
    for name, m in state["imputers"].items():
        means = impute.MeanImputerModel(m["means"])
        if name == "mean":
            out[name] = means
            continue
        gold = spark.read.parquet(state["gold"]).where(F.col("fold") == "train")
        donors = gold.select(m["key"], *[F.col(f"`{c}`").cast("double").alias(c) for c in m["features"]])
        out[name] = impute.KnnImputerModel(donors, m["features"], m["key"], m["k"], means)
    return plan, scaler, out
