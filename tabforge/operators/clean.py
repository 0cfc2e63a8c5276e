"""Column and value cleaning (P-01 ... P-17). All of these are projections or
filters: they compile to one narrow stage and keep scan pruning intact."""

from __future__ import annotations

import re
import urllib.parse
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)

# Pandas dtype names accepted in a datatypes map and their Spark type.
PANDAS_DTYPES = {
    "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "int": "bigint",
    "Int8": "tinyint", "Int16": "smallint", "Int32": "int", "Int64": "bigint",
    "float16": "float", "float32": "float", "float64": "double", "float": "double",
    "bool": "boolean", "boolean": "boolean",
    "category": "string", "object": "string", "str": "string", "string": "string",
    "datetime64[ns]": "timestamp", "datetime64": "timestamp",
}

CATEGORICAL_META = {"role": "categorical"}


def _decode(spec) -> object:
    """Configs arrive URL-encoded JSON strings or already-parsed objects."""
    if isinstance(spec, str):
        import json
        return json.loads(urllib.parse.unquote(spec))
    return spec


# P-01
def sanitize_name(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9_]", "", name)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Delete characters outside [a-zA-Z0-9_] from every header; a collision raises."""
    new = [sanitize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both sanitise to {n!r}")
        if not n:
            raise ValueError(f"column {old!r} has no character left after sanitising")
        seen[n] = old
    return df.toDF(*new)


# P-02
def spark_type_name(dtype: str) -> str:
    return PANDAS_DTYPES.get(dtype, dtype)


def cast_columns(df: DataFrame, datatypes) -> DataFrame:
    """Cast per ``{column: dtype}`` (pandas or Spark names). ``category`` becomes a
    string column tagged categorical in its metadata. ANSI casts raise on bad
    values as ``astype`` does."""
    datatypes = _decode(datatypes) or {}
    missing = [c for c in datatypes if c not in df.columns]
    if missing:
        raise KeyError(f"datatypes name unknown columns {missing}")
    out = {}
    for c, t in datatypes.items():
        col = F.col(f"`{c}`").cast(spark_type_name(t))
        if t == "category":
            col = col.alias(c, metadata=CATEGORICAL_META)
        out[c] = col
    return df.withColumns(out)


# P-03
def nonfinite_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN, +Inf and -Inf become NULL on float columns (integers cannot hold them)."""
    targets = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)]
    out = {}
    for c in targets:
        x = F.col(f"`{c}`")
        bad = F.isnan(x) | x.isin(float("inf"), float("-inf"))
        out[c] = F.when(bad, F.lit(None).cast(df.schema[c].dataType)).otherwise(x)
    return df.withColumns(out) if out else df


# P-04
def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur more than once with their counts (map-side combined)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def set_key(df: DataFrame, key: str, validate: bool = True) -> DataFrame:
    """Declare ``key`` the row identity; with ``validate`` a repeated key raises."""
    if key not in df.columns:
        raise KeyError(key)
    if validate:
        dup = duplicate_keys(df, key).limit(1).collect()
        if dup:
            raise ValueError(f"key {key!r} is not unique: {dup[0][key]!r} repeats")
        if df.where(F.col(key).isNull()).limit(1).count():
            raise ValueError(f"key {key!r} holds NULL")
    return df.withColumn(key, F.col(key).alias(key, metadata={"role": "key"}))


# P-05 / P-06
def label_mapping(df: DataFrame, label: str, inline_limit: int = 100_000) -> DataFrame:
    """Distinct label values in ascending order with their code 0..n-1.

    Codes come from a distributed global index over the distinct set, so the
    mapping never has to fit on the driver."""
    from tabforge.operators.indexing import global_index
    distinct = df.select(F.col(label).alias("value")).where(F.col("value").isNotNull()).distinct()
    return global_index(distinct, "value", index_col="code")


def label_encode(df: DataFrame, label: str, task: str = "Classification",
                 encode_regression: bool = False, broadcast_limit: int = 1_000_000):
    """Replace labels by their rank among the sorted distinct labels (pandas'
    LabelEncoder). Classification codes are int. Regression labels stay as they
    are unless ``encode_regression`` (the reference's behaviour, Q4).

    Returns (encoded DataFrame, mapping DataFrame)."""
    if task == "Regression" and not encode_regression:
        return df, None
    mapping = label_mapping(df, label)
    n = mapping.count()
    m = mapping.select(F.col("value").alias("__lbl"), F.col("code").alias("__code"))
    if n <= broadcast_limit:
        m = F.broadcast(m)  # size checked above: one row per distinct label
    joined = df.join(m, df[label].eqNullSafe(m["__lbl"]), "left")
    code = F.col("__code") if task == "Regression" else F.col("__code").cast("int")
    cols = [code.alias(label) if c == label else F.col(f"`{c}`") for c in df.columns]
    return joined.select(*cols), mapping


# P-07
def _lit_like(value, dtype):
    return F.lit(value).cast(dtype)


def _compatible(value, dtype) -> bool:
    if value is None:
        return True
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, NUMERIC_TYPES)
    if isinstance(value, str):
        return isinstance(dtype, T.StringType)
    return False


def replace_values(df: DataFrame, replacements) -> DataFrame:
    """``{old: new}`` applies to every column whose type can hold ``old``;
    ``{col: {old: new}}`` to that column only. Equality is exact, NULL can be
    replaced with key ``None``; the text 'null' is ordinary text (in a numeric
    column, where JSON cannot write the key None otherwise, it means NULL).

    Replacements of another type than the column's decide the output type
    first: numbers widen a numeric column, anything else makes the column text."""
    replacements = _decode(replacements) or {}
    nested = all(isinstance(v, Mapping) for v in replacements.values()) and replacements
    per_col: dict[str, Mapping] = {}
    if nested:
        per_col = {c: m for c, m in replacements.items()}
    else:
        per_col = {f.name: replacements for f in df.schema.fields}
    out = {}
    for c, mapping in per_col.items():
        dtype = df.schema[c].dataType
        pairs = [(_coerce_key(o, dtype), n) for o, n in mapping.items()]
        pairs = [(o, n) for o, n in pairs if _compatible(o, dtype)]
        if not pairs:
            continue
        x = F.col(f"`{c}`")
        to = _output_type([n for _, n in pairs], dtype)
        expr = None
        for old, new in pairs:
            cond = x.isNull() if old is None else (x == _lit_like(old, dtype))
            value = F.lit(_spell(new) if isinstance(to, T.StringType) and not isinstance(new, str) else new).cast(to)
            expr = F.when(cond, value) if expr is None else expr.when(cond, value)
        out[c] = expr.otherwise(x.cast(to))
    return df.withColumns(out) if out else df


def _spell(value):
    return None if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _output_type(values: list, dtype: T.DataType) -> T.DataType:
    """The column's type if it can hold every replacement, else double (numbers) or string."""
    given = [v for v in values if v is not None]
    if all(_compatible(v, dtype) for v in given):
        fractional = any(isinstance(v, float) and not v.is_integer() for v in given)
        return T.DoubleType() if fractional and isinstance(dtype, T.IntegralType) else dtype
    return T.StringType()


def _coerce_key(key, dtype):
    """JSON object keys are strings; read them as numbers for numeric columns."""
    if isinstance(key, str) and isinstance(dtype, NUMERIC_TYPES):
        if key == "null":
            return None
        try:
            return float(key) if any(ch in key for ch in ".eE") else int(key)
        except ValueError:
            return key
    return key


# P-08
def keep_numeric(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Keep int/float columns (the reference's "drop bools" drops every other type)."""
    keep = set(keep)
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) or f.name in keep]
    return df.select(*[F.col(f"`{c}`") for c in cols])


# P-09
def strip_commas(df: DataFrame) -> DataFrame:
    out = {f.name: F.translate(F.col(f"`{f.name}`"), ",", " ")
           for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(out) if out else df


# P-10 / P-11
def parse_column_list(spec) -> list[str] | None:
    if spec is None or spec == "None":
        return None
    if isinstance(spec, str):
        return [c.replace("%20", " ").strip() for c in spec.split(",") if c.strip()]
    return list(spec)


def select_columns(df: DataFrame, spec) -> DataFrame:
    cols = parse_column_list(spec)
    if cols is None:
        return df
    return df.select(*[F.col(f"`{c}`") for c in cols])


def select_complement(df: DataFrame, spec) -> DataFrame:
    cols = parse_column_list(spec) or []
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in set(cols)])


# P-13
def align_columns(df: DataFrame, like) -> DataFrame:
    cols = like.columns if isinstance(like, DataFrame) else list(like)
    return df.select(*[F.col(f"`{c}`") for c in cols])


# P-14
def normalize_booleans(df: DataFrame, fill_null: bool | None = None) -> DataFrame:
    """Nullable booleans to plain booleans. By default a NULL raises (as the
    int cast does in pandas); ``fill_null`` replaces it instead."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.BooleanType):
            x = F.col(f"`{f.name}`")
            if fill_null is None:
                out[f.name] = F.when(x.isNull(), F.raise_error(F.lit(f"NULL in boolean column {f.name}"))
                                     ).otherwise(x).cast("boolean")
            else:
                out[f.name] = F.coalesce(x, F.lit(bool(fill_null)))
    return df.withColumns(out) if out else df


# P-15
def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Category (string) or boolean columns."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in ex]


# P-16
def classify(prob: Column | str, threshold: float = 0.5) -> Column:
    p = F.col(prob) if isinstance(prob, str) else prob
    return (p >= F.lit(threshold)).cast("int")


def positive_probability(col: str = "probability") -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[1]


# P-17
def completed(df: DataFrame, status_col: str = "status") -> DataFrame:
    return df.where(F.col(status_col) == "Completed")
