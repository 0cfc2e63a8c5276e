"""Row-keyed uniform draws.

``u(key, salt)`` = first 32 bits of md5(key || ':' || salt) / 2^32. It depends
only on the row key, never on partitioning or task order, so a rerun after an
executor loss draws the same numbers, and DuckDB computes identical values for
the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def u(key, salt) -> Column:
    """Uniform double in [0, 1) from a key column (or expression) and a salt."""
    key_col = F.col(key) if isinstance(key, str) else key
    text = F.concat(key_col.cast("string"), F.lit(f":{salt}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def u_col(key, salt: Column) -> Column:
    """``u`` with a per-row salt column: equals ``u(key, s)`` where the column holds ``s``."""
    key_col = F.col(key) if isinstance(key, str) else key
    text = F.concat(key_col.cast("string"), F.lit(":"), salt.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def u_sql_spark(key_sql: str, salt) -> str:
    return (f"(CAST(conv(substr(md5(concat(CAST({key_sql} AS STRING), ':{salt}')), 1, 8), 16, 10)"
            f" AS DOUBLE) / 4294967296D)")


def u_sql_duckdb(key_sql: str, salt) -> str:
    return (f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{salt}'), 1, 8))::BIGINT"
            f" / 4294967296.0::DOUBLE)")
