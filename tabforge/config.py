"""Typed configuration (X-05): the inputs of the featurize, train and compact
plans with the reference's defaults. Flags are booleans, never eval'd strings."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class FeaturizeConfig:
    project: str
    label: str
    root: str                                 # shared output folder (gold, catalogs, run logs)
    input: str | None = None                  # delimited file(s); or pass a DataFrame
    task: str = "Classification"              # or "Regression"
    separator: str = "comma"
    key: str = "ID"
    unwanted: str | list | None = None
    replacements: dict | str | None = None
    datatypes: dict | str | None = None
    convert_inf: bool = True
    remove_commas: bool = True
    drop_bools: bool = False
    downsample: bool = False
    remove_low_info: bool = True
    remove_high_corr: bool = True
    remove_high_nan: bool = True
    remove_single_val: bool = True
    seed: int = 42
    test_size: float = 0.33
    valid_size: float = 0.15
    imputers: list[str] = field(default_factory=lambda: ["mean", "knn"])
    enable_slow: bool = False
    materialize_balancers: bool = False       # fit every balancer now and time it (R-03)
    encode_regression: bool = False           # reproduce the reference's label encoding of targets


@dataclass
class TrainConfig:
    project: str
    label: str
    root: str
    task: str = "Classification"
    primary_metric: str = "weighted-avg_f1-score"
    imputers: list[str] = field(default_factory=lambda: ["mean"])
    balancers: list[str] = field(default_factory=lambda: ["none"])
    num_trials: int = 5
    parallelism: int = 5
    max_iter: int = 1000                      # boosting rounds; patience on the valid fold decides
    downsample: bool = False
    drop_bools: bool = False
    key: str = "ID"
    ranking: str = "permutation"              # M-08: "permutation" (every test row), "gain" or "shap"
    time_limit: float = 7200.0                # seconds after which no further trial starts


@dataclass
class CompactConfig:
    root: str
    project: str
    folders: tuple = ("runinfo", "trainlog")
    export_csv: bool = False                  # also one CSV file, written by one task
