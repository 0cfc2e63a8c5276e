"""Versioned "gold" datasets and a model registry (S-06, S-07, S-08, S-14).

A dataset (project and variant) or a model name has a folder of numbered version files, each put
there once and only if its number is free (``versions``), so any number of writers may publish at
the same time: every publication gets its own version and its own data folder, and none is lost.
Data is written before its version file."""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.sources.stage import write_stage
from tabforge.sources.versions import commit, read_version, version_file, versions

GOLD_SCHEMA = ("project string, variant string, version int, path string, imputers string, "
               "balancers string, downsample boolean, drop_bools boolean, published_at timestamp")
MODEL_SCHEMA = ("name string, version int, path string, tags map<string,string>, registered_at timestamp")


def gold_variant(downsample: bool, drop_bools: bool) -> str:
    return ("-downsample" if downsample else "") + ("-dropbools" if drop_bools else "")


def _folder(root: str, kind: str, name: str) -> str:
    return f"{root.rstrip('/')}/_catalog/{kind}/{quote(name, safe='')}"


def list_versions(spark: SparkSession, root: str, kind: str, name: str) -> DataFrame:
    """Every version of a dataset (``gold``: project + variant) or model (``models``), as a table."""
    schema = GOLD_SCHEMA if kind == "gold" else MODEL_SCHEMA
    folder = _folder(root, kind, name)
    files = [version_file(folder, n) for n in versions(spark, folder)]
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def registry_tags(keys: DataFrame, col: str = "key") -> DataFrame:
    """S-08: split registry keys on '_' into (type, fold, col1, col2, imputer,
    balancer); distinct, non-empty, sorted, comma-joined imputers and balancers."""
    parts = F.split(F.col(col), "_")
    p = keys.select(F.get(parts, 4).alias("imputer"), F.get(parts, 5).alias("balancer"))

    def joined(c):
        vals = F.array_sort(F.collect_set(F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.col(c))))
        return F.array_join(vals, ",").alias(f"{c}s")
    return p.agg(joined("imputer"), joined("balancer"))


def publish_gold(df: DataFrame, root: str, project: str, downsample: bool = False, drop_bools: bool = False,
                 imputers: str = "", balancers: str = "", partition_by="fold") -> dict:
    """Write ``df`` as a new version of ``{project}/gold{variant}``: first the data, in a folder of its
    own, then the version file, for the next free number."""
    variant = gold_variant(downsample, drop_bools)
    path = f"{root}/{project}/gold{variant}/data-{uuid.uuid4().hex}"
    write_stage(df, path, partition_by=partition_by if partition_by in df.columns else None)
    n, _ = commit(df.sparkSession, _folder(root, "gold", f"{project}{variant}"), lambda n, _last: {
        "project": project, "variant": variant, "version": n, "path": path, "imputers": imputers, "balancers": balancers,
        "downsample": downsample, "drop_bools": drop_bools, "published_at": _now()})
    return {"project": project, "variant": variant, "version": n, "path": path}


def read_gold(spark: SparkSession, root: str, project: str, downsample: bool = False, drop_bools: bool = False,
              version="latest") -> DataFrame:
    variant = gold_variant(downsample, drop_bools)
    found = read_version(spark, _folder(root, "gold", f"{project}{variant}"), None if version == "latest" else int(version))
    if found is None:
        raise FileNotFoundError(f"no gold dataset for {project}{variant} version {version}")
    return spark.read.parquet(found[1]["path"])


def register_model(spark: SparkSession, root: str, name: str, model_path: str, tags: dict) -> dict:
    """S-14: a new version (name, version, path, tags) of the model."""
    n, _ = commit(spark, _folder(root, "models", name), lambda n, _last: {
        "name": name, "version": n, "path": model_path, "tags": {k: str(v) for k, v in tags.items()}, "registered_at": _now()})
    return {"name": name, "version": n, "path": model_path}
