"""X-03 train: gold variant -> random sweep -> best trial -> calibration ->
saved model and
variant -> model registry + run log."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.config import TrainConfig
from tabforge.operators import model as mdl
from tabforge.operators import sweep
from tabforge.operators.variant import fold_variants, model_features
from tabforge.sources import catalog, history
from tabforge.sources.stage import save_model, write_stage


@dataclass
class TrainResult:
    trials: DataFrame
    best: dict
    summary: DataFrame         # M-07 lists, best run's metrics and ranked features
    ranking: DataFrame
    calibrated: mdl.Calibrated
    model_path: str
    registry: dict
    variant_path: str          # the chosen variant, all folds
    run_row: str               # the delta in the trainlog folder


def train(spark: SparkSession, cfg: TrainConfig, data: DataFrame | None = None) -> TrainResult:
    run_id = uuid.uuid4().hex
    if data is None:
        data = catalog.read_gold(spark, cfg.root, cfg.project, cfg.downsample, cfg.drop_bools)
    feats = model_features(data, cfg.key, cfg.label)
    trials = sweep.trial_table(spark, cfg.num_trials, cfg.imputers, cfg.balancers)
    table, models = sweep.run_sweep(data, trials, cfg.key, cfg.label, cfg.task, cfg.primary_metric,
                                    cfg.max_iter, cfg.parallelism, feats, time_limit=cfg.time_limit)
    table = table.persist()
    found = sweep.best_trial(table).first()
    if found is None:
        raise RuntimeError("no trial succeeded: " + "; ".join(r["error"] for r in table.select("error").collect()))
    best = found.asDict()
    model, metrics = models[best["trial_id"]]
    parts, base = fold_variants(data, best["imputer"], best["balancer"], cfg.key, cfg.label, feats)
    # M-06: the chosen variant, every fold, beside the model
    path = f"{cfg.root}/{cfg.project}/models/run={run_id}"
    variant_path = f"{path}/variant"
    for fold, rows in parts.items():
        write_stage(rows, f"{variant_path}/fold={fold}")
    base.unpersist()
    valid, test = (spark.read.parquet(f"{variant_path}/fold={f}") for f in ("valid", "test"))
    cal = mdl.calibrate(model, valid, test)
    ranking = mdl.rank_features(model, spark, 20, cfg.ranking, test, cfg.key).persist()
    save_model(cal, path, {"runId": run_id, "trial_id": best["trial_id"], "best_score": best["score"], "label": cfg.label,
                           "imputer": best["imputer"], "balancer": best["balancer"], "variant": variant_path})
    reg = catalog.register_model(spark, cfg.root, cfg.project, path, {
        "label": cfg.label, "primary_metric": cfg.primary_metric, "type": cfg.task, "source": "sweep",
        "downsample": cfg.downsample, "drop_bools": cfg.drop_bools, "best_score": best["score"],
        "calibrated": cal.used})
    ranked = {r["metric"]: r["value"] for r in ranking.collect()}  # at most 20
    lists = sweep.sweep_summary(table.select("trial_id", "score", "imputer", "balancer"))
    summary = lists.select("*", *[F.lit(float(v)).alias(f"best_{k}") for k, v in sorted(metrics.items())],
                           *[F.lit(v).alias(k) for k, v in sorted(ranked.items())])
    row = spark.createDataFrame([(run_id, cfg.project, dt.datetime.now(dt.timezone.utc).isoformat(), cfg.label, best["imputer"],
                                  best["balancer"], float(best["score"]), bool(cal.used))],
                                "runId string, experiment string, runDate string, label string, imputer string, "
                                "balancer string, best_score double, calibrated boolean")
    row = row.select("*", *[F.lit(float(v)).alias(k) for k, v in sorted(metrics.items())],
                     *[F.lit(v).alias(k) for k, v in sorted(ranked.items())])
    delta = history.write_run_row(row, cfg.root, cfg.project, "trainlog", run_id)
    return TrainResult(table, best, summary, ranking, cal, path, reg, variant_path, delta)
