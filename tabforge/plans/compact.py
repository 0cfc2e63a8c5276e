"""X-04 compact: history compaction for the runinfo and trainlog folders."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tabforge.config import CompactConfig
from tabforge.sources.history import compact_history, current_history, list_deltas


def compact(spark: SparkSession, cfg: CompactConfig) -> dict:
    out = {}
    for folder in cfg.folders:
        path = f"{cfg.root}/{cfg.project}/{folder}"
        empty = current_history(spark, path) is None and not list_deltas(spark, path)
        out[folder] = None if empty else compact_history(spark, path, export_csv=cfg.export_csv)
    return out
