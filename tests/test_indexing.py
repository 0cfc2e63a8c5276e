import pandas as pd
from pyspark.sql import functions as F

from tabforge.operators.indexing import global_index, keep_smallest


def test_global_index_matches_row_number_per_group(spark):
    df = spark.range(5000).select(F.col("id").alias("ID"), (F.col("id") % 3).alias("g"),
                                  ((F.col("id") * 7919) % 5000).alias("o"))
    out = global_index(df, ["o", "ID"], "idx", group="g", num_partitions=7).toPandas()
    exp = out.sort_values(["g", "o", "ID"]).groupby("g").cumcount()
    assert (out.sort_values(["g", "o", "ID"])["idx"].to_numpy() == exp.to_numpy()).all()


def test_keep_smallest_refines_hot_group_and_ties(spark):
    # group 0 holds most rows; scores have many ties; exact_limit forces refinement
    df = spark.range(20000).select(F.col("id").alias("ID"),
                                   F.when(F.col("id") % 10 < 8, 0).otherwise(1).alias("g"),
                                   ((F.col("id") * 37) % 500 / 7.0).alias("s"))
    quota = {0: 1234, 1: 50}
    got = keep_smallest(df, "g", "s", "ID", quota, bins=16, exact_limit=300).toPandas()
    pdf = df.toPandas().sort_values(["g", "s", "ID"])
    exp = pd.concat([pdf[pdf.g == g].head(n) for g, n in quota.items()])
    assert sorted(got["ID"]) == sorted(exp["ID"])
