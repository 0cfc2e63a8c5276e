"""Staged tables, bundles, metrics and models on shared storage (S-02, S-03,
S-05, S-09, S-13). Parquet replaces the reference's pickles; fitted
statistics are JSON next to the data."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tabforge.bundle import TableBundle


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_stage(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small JSON side files through the Hadoop file system (works on any shared store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def save_bundle(bundle: TableBundle, path: str, fitted: dict | None = None) -> str:
    """Rows as Parquet partitioned by fold (if any) + roles and fitted
    statistics as JSON."""
    write_stage(bundle.df, f"{path}/data", partition_by=bundle.fold)
    meta = {"roles": bundle.roles(), "fitted": fitted or {}}
    _write_text(bundle.df.sparkSession, f"{path}/bundle.json", json.dumps(meta, default=str))
    return path


def load_bundle(spark: SparkSession, path: str) -> tuple[TableBundle, dict]:
    meta = json.loads(_read_text(spark, f"{path}/bundle.json"))
    r = meta["roles"]
    df = spark.read.parquet(f"{path}/data")
    return TableBundle(df, r["key"], r["label"], r["features"], r["extra"], r["fold"]), meta["fitted"]


def write_metrics(metrics: DataFrame, path: str) -> str:
    """Metrics table (metric, value) as JSON lines."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


def save_model(model, path: str, descriptor: dict) -> str:
    """Spark ML model + best-run descriptor (runId, best_score, label, imputer, balancer). A
    ``Calibrated`` model is saved with its isotonic stage, if it has one."""
    from tabforge.operators.model import Calibrated
    base = model.base if isinstance(model, Calibrated) else model
    base.model.write().overwrite().save(f"{path}/model")
    desc = dict(descriptor)
    desc.update({"features": base.features, "label": base.label, "task": base.task, "n_trees": base.n_trees,
                 "calibrated": False})
    if isinstance(model, Calibrated) and model.iso is not None:
        model.iso.write().overwrite().save(f"{path}/isotonic")
        desc.update({"calibrated": True, "brier_before": model.brier_before, "brier_after": model.brier_after})
    _write_text(SparkSession.getActiveSession(), f"{path}/best_run.json", json.dumps(desc, default=str))
    return path


def load_model(spark: SparkSession, path: str):
    """(model, descriptor) as saved: a ``GbtModel``, or ``Calibrated`` with its isotonic stage."""
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import GBTRegressionModel, IsotonicRegressionModel
    from tabforge.operators.model import Calibrated, GbtModel
    desc = json.loads(_read_text(spark, f"{path}/best_run.json"))
    cls = GBTRegressionModel if desc["task"] == "Regression" else GBTClassificationModel
    m = GbtModel(cls.load(f"{path}/model"), desc["features"], desc["label"], desc["task"], desc["n_trees"])
    if not desc.get("calibrated"):
        return m, desc
    return Calibrated(m, IsotonicRegressionModel.load(f"{path}/isotonic"), desc["brier_before"], desc["brier_after"]), desc
