"""Role metadata over one DataFrame (S-04, P-12).

The reference ships X, y and unwanted columns as separate frames aligned by
position. Spark rows have no position, so a bundle is one DataFrame plus the
names of its key, label, feature and extra columns; the role views are
projections over the same plan and cost nothing until used."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.clean import parse_column_list


@dataclass
class TableBundle:
    df: DataFrame
    key: str = "ID"
    label: str | None = "label"
    features: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    fold: str | None = None

    @property
    def X(self) -> DataFrame:
        return self.df.select(*[F.col(f"`{c}`") for c in [self.key] + self.features])

    @property
    def y(self) -> DataFrame:
        return self.df.select(self.key, self.label)

    @property
    def xtra(self) -> DataFrame:
        return self.df.select(*[F.col(f"`{c}`") for c in [self.key] + self.extra])

    def with_df(self, df: DataFrame, features: list[str] | None = None) -> "TableBundle":
        return TableBundle(df, self.key, self.label, features if features is not None else
                           [c for c in self.features if c in df.columns], self.extra, self.fold)

    def roles(self) -> dict:
        return {"key": self.key, "label": self.label, "features": self.features,
                "extra": self.extra, "fold": self.fold}


def package(df: DataFrame, key: str = "ID", label: str | None = "label", unwanted=None) -> TableBundle:
    """Split columns into roles: unwanted -> extra, label, the rest features."""
    extra = [c for c in (parse_column_list(unwanted) or []) if c in df.columns and c not in (key, label)]
    features = [c for c in df.columns if c not in set(extra) | {key, label}]
    return TableBundle(df, key, label, features, extra)


def split_roles(df: DataFrame, label: str, unwanted=None, key: str = "ID"):
    """The reference's four chained selects as three projections of one plan:
    (features, label, unwanted), each keeping the key for alignment."""
    b = package(df, key, label, unwanted)
    return b.X, b.y, b.xtra


def attach_label(features: DataFrame, labels: DataFrame, key: str = "ID", validate: bool = True) -> DataFrame:
    """J-01: join a separately delivered label table to its features by key;
    ``validate`` checks the pairing is one to one (counts on both sides)."""
    joined = features.join(labels, key, "inner")
    if validate:
        n_f, n_l, n_j = features.count(), labels.count(), joined.count()
        if not (n_f == n_l == n_j):
            raise ValueError(f"label join is not 1:1 (features {n_f}, labels {n_l}, matched {n_j})")
    return joined
