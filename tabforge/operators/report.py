"""Hold-out metrics (A-10 ... A-12, P-16). The classification report works on
the confusion counts (classes x classes rows), so its cost is one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, y: str = "label", yhat: str = "yhat") -> DataFrame:
    """Long (metric, value): ``{class}_{precision,recall,f1-score,support}`` and
    the ``macro-avg_*`` / ``weighted-avg_*`` rows; 0/0 counts as 0; the scalar
    accuracy entry is not emitted.

    One scan: the confusion counts (classes x classes rows) are aggregated
    once and the report is derived from them."""
    cells = confusion(df, y, yhat).collect()  # bounded by classes^2
    classes = sorted({r["y"] for r in cells} | {r["yhat"] for r in cells}, key=lambda v: (v is None, str(v)))
    tp = {c: 0 for c in classes}
    sup = {c: 0 for c in classes}
    pred = {c: 0 for c in classes}
    for r in cells:
        sup[r["y"]] += r["n"]
        pred[r["yhat"]] += r["n"]
        if r["y"] == r["yhat"]:
            tp[r["y"]] += r["n"]
    rows, per = [], []
    for c in classes:
        p = tp[c] / pred[c] if pred[c] else 0.0
        rc = tp[c] / sup[c] if sup[c] else 0.0
        f1 = 2 * p * rc / (p + rc) if (p + rc) > 0 else 0.0
        per.append((p, rc, f1, sup[c]))
        rows += [(f"{c}_precision", p), (f"{c}_recall", rc), (f"{c}_f1-score", f1), (f"{c}_support", float(sup[c]))]
    total = sum(s for *_, s in per)
    k = max(1, len(per))
    for name, i in (("precision", 0), ("recall", 1), ("f1-score", 2)):
        rows.append((f"macro-avg_{name}", sum(x[i] for x in per) / k))
    rows.append(("macro-avg_support", float(total)))
    for name, i in (("precision", 0), ("recall", 1), ("f1-score", 2)):
        rows.append((f"weighted-avg_{name}", sum(x[i] * x[3] for x in per) / total if total else 0.0))
    rows.append(("weighted-avg_support", float(total)))
    return df.sparkSession.createDataFrame(rows, "metric string, value double")


def neg_rmse(df: DataFrame, y: str = "label", yhat: str = "prediction") -> DataFrame:
    d = F.col(y).cast("double") - F.col(yhat).cast("double")
    return df.agg((-F.sqrt(F.avg(d * d))).alias("neg_rmse"))


def brier_score(df: DataFrame, y: str = "label", p: str = "p") -> DataFrame:
    d = F.col(p).cast("double") - F.col(y).cast("double")
    return df.agg(F.avg(d * d).alias("brier"))
