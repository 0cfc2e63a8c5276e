"""Delimited-file input (S-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Separator names accepted by the input step.
SEPARATORS = {"comma": ",", "semicolon": ";", "tab": "\t"}


def read_delimited(spark: SparkSession, path, separator: str = "comma", schema=None,
                   null_value: str = "") -> DataFrame:
    """Header row, types inferred unless ``schema`` is given (inference costs an
    extra pass; give a schema at scale). ``enforceSchema`` is off so a header
    that does not match the schema raises instead of shifting columns."""
    sep = SEPARATORS.get(separator, separator)
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", null_value) \
        .option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_delimited(df: DataFrame, path: str, separator: str = "comma", single_file: bool = False) -> str:
    sep = SEPARATORS.get(separator, separator)
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path
