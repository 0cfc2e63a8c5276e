"""Imputation (I-01 mean, I-02 k-nearest-neighbour).

Both fit on the train rows and transform lazily: the mean imputer is one
aggregate plus a projection; the kNN imputer searches neighbours only for rows
that hold a NULL, blocked as in ``knn.py``, and falls back to the train mean
when a cell has no donor."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.clean import numeric_columns
from tabforge.operators.knn import impute_candidates


@dataclass
class MeanImputerModel:
    means: dict[str, float | None] = field(default_factory=dict)

    @property
    def all_null(self) -> list[str]:
        """Columns with no value in train: they stay NULL (reported)."""
        return [c for c, m in self.means.items() if m is None]

    def transform(self, df: DataFrame) -> DataFrame:
        out = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(m).cast("double"))
               for c, m in self.means.items() if c in df.columns}
        return df.withColumns(out) if out else df


def _feature_cols(df: DataFrame, columns, exclude) -> list[str]:
    if columns is not None:
        return list(columns)
    from pyspark.sql import types as T
    ex = set(exclude)
    return numeric_columns(df, ex) + [f.name for f in df.schema.fields
                                      if isinstance(f.dataType, T.BooleanType) and f.name not in ex]


def fit_mean_imputer(train: DataFrame, columns=None, exclude=()) -> MeanImputerModel:
    cols = _feature_cols(train, columns, exclude)
    if not cols:
        return MeanImputerModel()
    row = train.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return MeanImputerModel({c: row[f"m{i}"] for i, c in enumerate(cols)})


@dataclass
class KnnImputerModel:
    donors: DataFrame
    features: list[str]
    key: str = "ID"
    k: int = 5
    fallback: MeanImputerModel | None = None
    block_rows: int = 20_000
    strategy: str = "auto"

    def imputed_cells(self, df: DataFrame) -> DataFrame:
        """(key, feature, value) for every NULL cell of ``df``."""
        any_null = None
        for c in self.features:
            cond = F.col(f"`{c}`").isNull()
            any_null = cond if any_null is None else (any_null | cond)
        queries = df.where(any_null)
        cands = impute_candidates(queries, self.donors, self.features, self.k, self.key, self.block_rows,
                                  self.strategy)
        found = cands.groupBy("query_id", "col").agg(F.avg("value").alias("value"))
        names = F.element_at(F.array(*[F.lit(c) for c in self.features]), F.col("col") + 1)
        found = found.select(F.col("query_id"), names.alias("feature"), "value")
        # every NULL cell, so that cells without any donor fall back to the mean
        cells = queries.select(F.col(self.key).cast("long").alias("query_id"), F.explode(F.array(*[
            F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in self.features])).alias("feature")) \
            .where(F.col("feature").isNotNull())
        means = self.fallback.means if self.fallback else {}
        mean_of = F.element_at(F.create_map(*[x for c in self.features for x in
                                              (F.lit(c), F.lit(means.get(c)).cast("double"))]), F.col("feature"))
        out = cells.join(found, ["query_id", "feature"], "left")
        return out.select(F.col("query_id").alias(self.key), "feature",
                          F.coalesce(F.col("value"), mean_of).alias("value"))

    def transform(self, df: DataFrame) -> DataFrame:
        cells = self.imputed_cells(df)
        wide = cells.groupBy(self.key).pivot("feature", self.features).agg(F.first("value"))
        wide = wide.select(self.key, *[F.col(f"`{c}`").alias(f"__imp_{i}") for i, c in enumerate(self.features)])
        j = df.join(wide, self.key, "left")
        out = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.col(f"__imp_{i}"))
               for i, c in enumerate(self.features)}
        return j.withColumns(out).drop(*[f"__imp_{i}" for i in range(len(self.features))])


def fit_knn_imputer(train: DataFrame, key: str = "ID", columns=None, exclude=(), k: int = 5,
                    block_rows: int = 20_000, strategy: str = "auto") -> KnnImputerModel:
    cols = _feature_cols(train, columns, list(exclude) + [key])
    return KnnImputerModel(train, cols, key, k, fit_mean_imputer(train, cols), block_rows, strategy)


IMPUTERS = ("mean", "knn")


def fit_imputer(name: str, train: DataFrame, key: str = "ID", exclude=(), **kw):
    if name == "mean":
        return fit_mean_imputer(train, exclude=list(exclude) + [key])
    if name == "knn":
        return fit_knn_imputer(train, key, exclude=exclude, **kw)
    raise ValueError(name)
