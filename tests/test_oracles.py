"""Every registered query against its DuckDB oracle at sf0.001 (sf0.01 is the
driver's gate; run ``python -m tabforge.plans.verify`` for it)."""

import pytest

from tests.conftest import SF_SMALL

from __spark_entry__ import entry, oracle_sql, queries

QS = queries()
OR = oracle_sql()
SLOW = {"m05_sweep", "x02_featurize", "x03_train", "m01_gbt_classifier", "m02_gbt_regressor",
        "m04_predict_report", "m08_feature_ranking", "m09_calibrate", "i04_isolation_forest"}


@pytest.fixture(scope="module")
def con():
    from tabforge.plans.verify import duckdb_connection
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(n for n in QS if n in OR))
def test_query_matches_oracle(spark, con, name):
    from tabforge.plans.verify import compare
    res = compare(spark, name, QS[name], OR[name], SF_SMALL, con)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("name", sorted(n for n in QS if n not in OR and n not in SLOW))
def test_rows_only_queries_run(spark, name):
    assert QS[name](spark, SF_SMALL).count() >= 0


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert {"ID", "fold", "label"} <= set(df.columns)
