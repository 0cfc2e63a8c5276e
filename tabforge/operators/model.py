"""Boosted trees, early stopping, prediction, feature ranking and isotonic
calibration (M-01 ... M-04, M-08, M-09): every fit is a distributed job; only
histograms, the fitted model and a handful of scores reach the driver. Fitted
models are Spark ML tree ensembles."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.boosting import MAX_DEPTH, PATIENCE, early_stop_rounds, fit_trees, stopped, to_spark_model  # noqa: F401

# Seed and boosting rounds of the reference's trainer.
SEED = 314
ROUNDS = 1000

@dataclass
class TrialParams:
    max_depth: int = 6
    num_leaves: int = 31
    colsample: float = 1.0
    subsample: float = 1.0
    learning_rate: float = 0.1
    max_iter: int = ROUNDS
    min_rows: int = 20                        # fewest rows of a leaf
    l2: float = 0.0


@dataclass
class GbtModel:
    model: object
    features: list[str]
    label: str
    task: str
    n_trees: int
    losses: list = field(default_factory=list)

    def _vec(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        cast = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in self.features})
        return VectorAssembler(inputCols=self.features, outputCol="__features", handleInvalid="keep").transform(cast)

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """Adds ``p`` (classification: P(class 1)) and ``yhat``."""
        from pyspark.ml.functions import vector_to_array
        out = self.model.transform(self._vec(df))
        if self.task == "Regression":
            return out.withColumn("yhat", F.col("prediction")).drop("__features", "prediction")
        out = out.withColumn("p", vector_to_array(F.col("probability"))[1])
        out = out.withColumn("yhat", (F.col("p") >= F.lit(threshold)).cast("int"))
        return out.drop("__features", "rawPrediction", "probability", "prediction")

    def importances(self, spark) -> DataFrame:
        imp = self.model.featureImportances.toArray().tolist()
        return spark.createDataFrame(list(zip(self.features, [float(x) for x in imp])),
                                     "feature string, importance double")


def fit_gbt(train: DataFrame, features: list[str], label: str = "label", params: TrialParams | None = None,
            task: str = "Classification", valid: DataFrame | None = None, seed: int = SEED,
            patience: int = PATIENCE) -> GbtModel:
    """Fit up to ``params.max_iter`` trees of at most ``num_leaves`` leaves and ``max_depth`` levels,
    grown leaf by leaf (``boosting``). With rows in ``valid``, patience decides: boosting ends once
    ``patience`` rounds have passed without a better valid loss, and the trees up to the best round
    are kept. It also ends when no split improves the fit. Rows without a label take no part."""
    params, features = params or TrialParams(), list(features)
    depth = int(params.max_depth) if params.max_depth > 0 else MAX_DEPTH
    fit = fit_trees(train, valid, features, label, task, max(2, int(params.num_leaves)), depth, float(params.learning_rate),
                    float(params.colsample), float(params.subsample), seed, params.l2, params.min_rows, params.max_iter, patience)
    trees = fit.trees[:early_stop_rounds(fit.losses, patience)] if fit.losses else fit.trees
    model = to_spark_model(train.sparkSession, trees, fit.bounds, fit.init, task, len(features))
    return GbtModel(model, features, label, task, max(1, len(trees)), fit.losses)


def feature_importances(model: GbtModel, spark, method: str = "gain", data: DataFrame | None = None,
                        key: str = "ID") -> DataFrame:
    """(feature, importance) by ``gain`` (Spark's split gains), ``shap`` (mean
    |Shapley value| over ``data``, what the reference ranks by) or
    ``permutation`` (accuracy / -RMSE drop over ``data``)."""
    if method == "gain":
        return model.importances(spark)
    if data is None:
        raise ValueError(f"method {method!r} needs the rows to explain (data=...)")
    if method == "shap":
        from tabforge.operators.explain import shap_importance
        return shap_importance(model, data)
    if method == "permutation":
        return permutation_importance(model, data, key)
    raise ValueError(f"unknown ranking method {method!r}")


def rank_features(model: GbtModel, spark, n: int = 20, method: str = "gain", data: DataFrame | None = None,
                  key: str = "ID") -> DataFrame:
    from tabforge.operators.windows import top_ranked
    return top_ranked(feature_importances(model, spark, method, data, key), "importance", "feature", n)


@dataclass
class Calibrated:
    base: GbtModel
    iso: object | None
    brier_before: float
    brier_after: float

    @property
    def used(self) -> bool:
        return self.iso is not None

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.base.predict(df)
        if self.iso is None:
            return out
        out = self.iso.setFeaturesCol("__p_raw").setPredictionCol("prediction").transform(
            out.withColumnRenamed("p", "__p_raw")).withColumnRenamed("prediction", "p")
        return out.drop("__p_raw").withColumn("yhat", (F.col("p") >= 0.5).cast("int"))


def calibrate(model: GbtModel, valid: DataFrame, test: DataFrame) -> Calibrated:
    """Isotonic regression of y on p fitted on valid; kept only if the test
    Brier score strictly improves. Regression models pass through."""
    from pyspark.ml.regression import IsotonicRegression
    from tabforge.operators.report import brier_score
    if model.task == "Regression":
        return Calibrated(model, None, float("nan"), float("nan"))
    label = model.label
    pv = model.predict(valid).select(F.col("p").alias("__p_raw"), F.col(label).cast("double").alias(label))
    iso = IsotonicRegression(featuresCol="__p_raw", labelCol=label, predictionCol="prediction").fit(pv)
    pt = model.predict(test)
    before = brier_score(pt, label, "p").first()[0]
    after_df = iso.transform(pt.withColumnRenamed("p", "__p_raw"))
    after = brier_score(after_df, label, "prediction").first()[0]
    return Calibrated(model, iso if after < before else None, before, after)


def permutation_importance(model: GbtModel, df: DataFrame, key: str = "ID", seed: str = "perm") -> DataFrame:
    """Distributed permutation importance over every row: (feature, importance).

    Rows are numbered in the random order of ``u(key, seed)``; feature f of a row is replaced by
    the value in the row that stands a feature-specific offset further on (cyclically), which is a
    permutation of the whole column. All p variants are scored in one ``transform`` (rows x (p + 1));
    the importance is the drop in accuracy (classification) or in -RMSE (regression) against the
    unchanged rows. Only the row count and p + 1 metric rows reach the driver."""
    from tabforge.functions.hashing import u
    from tabforge.operators.indexing import global_index
    spark = df.sparkSession
    feats = list(model.features)
    base = df.select(F.col(key), F.col(model.label), *[F.col(f"`{c}`").cast("double").alias(c) for c in feats])
    at = global_index(base.withColumn("__u", u(key, seed)), ["__u", key], "__at").drop("__u")
    n = at.count()
    offsets = spark.createDataFrame([(c,) for c in feats], "__variant string")
    offsets = {r[0]: r[1] for r in offsets.select("__variant", (F.floor(u("__variant", seed) * max(1, n - 1)) + 1).cast("long")).collect()}
    variants = F.array(F.struct(F.lit("__none__").alias("__variant"), F.lit(0).cast("long").alias("__off")),
                       *[F.struct(F.lit(c).alias("__variant"), F.lit(offsets[c]).cast("long").alias("__off")) for c in feats])
    rows = at.withColumn("__v", F.explode(variants)).withColumn("__variant", F.col("__v.__variant")).withColumn(
        "__from", F.pmod(F.col("__at") + F.col("__v.__off"), F.lit(max(1, n)))).drop("__v")
    donor = at.select(F.col("__at").alias("__from"), F.struct(*[F.col(c) for c in feats]).alias("__d"))
    rows = rows.join(donor, "__from").select(key, model.label, "__variant", *[
        F.when(F.col("__variant") == F.lit(c), F.col(f"__d.{c}")).otherwise(F.col(c)).alias(c) for c in feats])
    pred = model.predict(rows)
    y = F.col(model.label).cast("double")
    if model.task == "Regression":
        score = -F.sqrt(F.avg((y - F.col("yhat")) ** 2))
    else:
        score = F.avg((y == F.col("yhat").cast("double")).cast("double"))
    scores = {r["__variant"]: r["s"] for r in pred.groupBy("__variant").agg(score.alias("s")).collect()}
    ref = scores.get("__none__")
    out = [(c, float(ref - scores[c]) if ref is not None and scores.get(c) is not None else None) for c in feats]
    return spark.createDataFrame(out, "feature string, importance double")
