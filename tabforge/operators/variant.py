"""Lazy (fold, imputer, balancer) variants (B-15) and the balancer choice (B-14).

A variant is an un-executed DataFrame plan: nothing is materialised until a
trial fits on it. By default the imputer is fitted on train and only train is
balanced; ``refit_per_fold`` / ``balance_all_folds`` reproduce the reference's
behaviour (Q12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.balance import balance
from tabforge.operators.impute import fit_imputer


def model_features(df: DataFrame, key: str, label: str, fold: str = "fold") -> list[str]:
    """Numeric and boolean columns other than key, label and fold."""
    from tabforge.operators.clean import NUMERIC_TYPES
    return [f.name for f in df.schema.fields if f.name not in (key, label, fold)
            and isinstance(f.dataType, NUMERIC_TYPES + (T.BooleanType,))]


def boolean_features(df: DataFrame, features: list[str]) -> list[str]:
    """Flags count as categorical for the balancer choice (B-14)."""
    return [c for c in features if isinstance(df.schema[c].dataType, T.BooleanType)]


def variant(df: DataFrame, fold: str, imputer: str, balancer: str, key: str = "ID", label: str = "label",
            features: list[str] | None = None, fold_col: str = "fold", fit_on: str = "train",
            refit_per_fold: bool = False, balance_all_folds: bool = False, imputer_model=None, **balance_kw):
    """Rows of ``fold`` with every feature as double, imputed, and balanced
    when ``fold`` is the fit fold. Boolean features (0/1 after the cast) are
    the nominal columns of SMOTENC / SMOTEN."""
    features = features or model_features(df, key, label, fold_col)
    flags = boolean_features(df, features)
    rows = df.where(F.col(fold_col) == fold).select(key, label, *[F.col(f"`{c}`").cast("double").alias(c)
                                                                 for c in features])
    if imputer_model is None:
        fit_rows = rows if refit_per_fold else df.where(F.col(fold_col) == fit_on).select(
            key, *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
        imputer_model = fit_imputer(imputer, fit_rows, key)
    out = imputer_model.transform(rows)
    if balancer != "none" and (fold == fit_on or balance_all_folds):
        if balancer == "smote" and flags:
            cont = [c for c in features if c not in flags]
            out = balance(balancer, out, key, label, cont, cat_features=flags, **balance_kw)
        else:
            out = balance(balancer, out, key, label, features, **balance_kw)
        out = out.drop("is_synthetic", "draw_id") if "is_synthetic" in out.columns else out
    return out


def fold_variants(df: DataFrame, imputer: str, balancer: str, key: str = "ID", label: str = "label",
                  features: list[str] | None = None, fold_col: str = "fold", fit_on: str = "train",
                  folds=("train", "valid", "test"), **balance_kw) -> tuple[dict, DataFrame]:
    """All folds of one (imputer, balancer) variant from a single persisted
    projection of ``df`` and a single imputer fit. Returns (folds, base);
    ``base.unpersist()`` when done."""
    from pyspark import StorageLevel
    features = features or model_features(df, key, label, fold_col)
    base = df.select(key, label, fold_col, *[F.col(f"`{c}`") for c in features]).persist(
        StorageLevel.MEMORY_AND_DISK)
    fit_rows = base.where(F.col(fold_col) == fit_on).select(
        key, *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    model = fit_imputer(imputer, fit_rows, key)
    out = {f: variant(base, f, imputer, balancer, key, label, features, fold_col, fit_on,
                      imputer_model=model, **balance_kw) for f in folds}
    return out, base
