from tabforge.functions.hashing import u, u_sql_duckdb, u_sql_spark  # noqa: F401
