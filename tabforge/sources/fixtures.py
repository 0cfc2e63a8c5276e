"""Derived fixtures (see FIXTURES.md): each is a lazy DataFrame over the given
tables, so its size grows with the scale factor. The SQL text of each fixture is
kept next to it for the DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.hashing import u, u_sql_duckdb
from tabforge.session import table

N_DIMS = 64

FX_ORDERS_SQL = """
SELECT o.o_orderkey AS ID,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_totalprice END AS o_totalprice,
       CASE WHEN o.o_orderkey % 101 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE c.c_acctbal END AS acctbal,
       CAST(o.o_custkey AS DOUBLE) AS custkey,
       o.o_orderdate,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_mktsegment END AS mktsegment,
       o.o_orderstatus,
       CAST(1 AS DOUBLE) AS const_col,
       CASE WHEN o.o_orderkey % 50 = 0 THEN CAST(o.o_orderkey AS DOUBLE) END AS mostly_null,
       o.o_totalprice * 2 + 1 AS price_twin,
       CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

FX_TOXIC_SQL = """
SELECT d.doc_id AS ID,
       CAST(d.n_chars AS DOUBLE) AS n_chars,
       CAST(length(d.text) - length(replace(d.text, ' ', '')) AS DOUBLE) AS n_spaces,
       CAST(length(d.text) - length(replace(d.text, '.', '')) AS DOUBLE) AS n_dots,
       d.lang, d.source, l.toxic AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

FX_RUNS_SQL = """
SELECT CAST(user_id AS VARCHAR(20)) AS run_id, event_type AS job, event_id AS seq,
       CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Completed' END AS status,
       ts AS start_ts, value AS metric
FROM events
"""

FX_TRIALS_SQL = """
SELECT p_partkey AS trial_id,
       CASE WHEN p_size % 2 = 0 THEN 'mean' ELSE 'knn' END AS imputer,
       p_type AS balancer,
       p_retailprice AS score
FROM part
"""


def fx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").alias("o")
    c = table(spark, sf_dir, "customer").alias("c")
    key = F.col("o.o_orderkey")
    null_d = F.lit(None).cast("double")
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).select(
        key.alias("ID"),
        F.when(key % 13 == 0, null_d).otherwise(F.col("o.o_totalprice")).alias("o_totalprice"),
        F.when(key % 101 == 0, F.lit(float("inf"))).otherwise(F.col("c.c_acctbal")).alias("acctbal"),
        F.col("o.o_custkey").cast("double").alias("custkey"),
        F.col("o.o_orderdate"),
        F.when(key % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("c.c_mktsegment")).alias("mktsegment"),
        F.col("o.o_orderstatus"),
        F.lit(1.0).alias("const_col"),
        F.when(key % 50 == 0, key.cast("double")).alias("mostly_null"),
        (F.col("o.o_totalprice") * 2 + 1).alias("price_twin"),
        F.when(F.col("o.o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("label"),
    )


def fx_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").alias("d")
    lab = table(spark, sf_dir, "labels").alias("l")
    text = F.col("d.text")
    return d.join(lab, F.col("d.doc_id") == F.col("l.doc_id")).select(
        F.col("d.doc_id").alias("ID"),
        F.col("d.n_chars").cast("double").alias("n_chars"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("double").alias("n_spaces"),
        (F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))).cast("double").alias("n_dots"),
        F.col("d.lang"), F.col("d.source"), F.col("l.toxic").alias("label"),
    )


def vector_columns(n: int = N_DIMS) -> list[str]:
    return [f"d{j}" for j in range(n)]


def fx_vectors(spark: SparkSession, sf_dir: str, missing: bool = False) -> DataFrame:
    """``embeddings`` as 64 double columns; label 1 = original class 0 (minority).
    With ``missing`` dimension j is NULL where (vec_id + j) % 11 = 0."""
    e = table(spark, sf_dir, "embeddings")
    cols = []
    for j in range(N_DIMS):
        x = F.col("embedding")[j].cast("double")
        if missing:
            x = F.when((F.col("vec_id") + j) % 11 == 0, F.lit(None).cast("double")).otherwise(x)
        cols.append(x.alias(f"d{j}"))
    return e.select(F.col("vec_id").alias("ID"), *cols,
                    F.when(F.col("label") == 0, 1).otherwise(0).alias("label"))


def fx_vectors_sql(missing: bool = False) -> str:
    cols = []
    for j in range(N_DIMS):
        x = f"CAST(embedding[{j + 1}] AS DOUBLE)"
        if missing:
            x = f"CASE WHEN (vec_id + {j}) % 11 = 0 THEN NULL ELSE {x} END"
        cols.append(f"{x} AS d{j}")
    return ("SELECT vec_id AS ID, " + ", ".join(cols)
            + ", CASE WHEN label = 0 THEN 1 ELSE 0 END AS label FROM embeddings")


def fx_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fx_orders(spark, sf_dir).select("ID", "label")
    p = u("ID", "score")
    return base.select("ID", "label", p.alias("p"), (p >= 0.5).cast("int").alias("yhat"))


def fx_scores_sql() -> str:
    p = u_sql_duckdb("ID", "score")
    return (f"SELECT ID, label, {p} AS p, CAST({p} >= 0.5 AS INTEGER) AS yhat "
            f"FROM ({FX_ORDERS_SQL}) fx")


def fx_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("job"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "Failed").otherwise("Completed").alias("status"),
        F.col("ts").alias("start_ts"),
        F.col("value").alias("metric"),
    )


def fx_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("trial_id"),
        F.when(F.col("p_size") % 2 == 0, "mean").otherwise("knn").alias("imputer"),
        F.col("p_type").alias("balancer"),
        F.col("p_retailprice").alias("score"),
    )
