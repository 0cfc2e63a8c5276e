"""Standardisation (I-03): fit one aggregate on train, apply as a projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.clean import numeric_columns


@dataclass
class StandardScalerModel:
    """Population mean and std per numeric column; std 0 or NULL divides by 1."""
    means: dict[str, float | None] = field(default_factory=dict)
    stds: dict[str, float | None] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, m in self.means.items():
            s = self.stds.get(c)
            div = 1.0 if (s is None or s == 0.0) else s
            x = F.col(f"`{c}`").cast("double")
            out[c] = (x - F.lit(m).cast("double")) / F.lit(div) if m is not None else x
        return df.withColumns(out) if out else df

    def to_json(self) -> dict:
        return {"means": self.means, "stds": self.stds}


def fit_standard_scaler(train: DataFrame, columns=None, exclude=()) -> StandardScalerModel:
    cols = list(columns) if columns is not None else numeric_columns(train, exclude)
    if not cols:
        return StandardScalerModel()
    exprs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        exprs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = train.agg(*exprs).first()
    return StandardScalerModel({c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] for c in cols})


def standardize(df: DataFrame, fold: str = "fold", fit_on: str = "train", exclude=()) -> tuple[DataFrame, StandardScalerModel]:
    """Fit on rows of ``fit_on`` fold, apply to all folds."""
    model = fit_standard_scaler(df.where(F.col(fold) == fit_on), exclude=list(exclude) + [fold])
    return model.transform(df), model
