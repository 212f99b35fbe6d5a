"""Every catalogued query equals its DuckDB oracle (exact, order-insensitive)."""

import pytest

from tests.conftest import SF_SMALL
from tickerlake.plans.catalog import QUERIES
from tickerlake.plans.compare import compare, duckdb_connection
from tickerlake.plans.oracle_sql import ORACLE


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert r["ok"], r


# Queries that no SQL covers, with the test files that hold them against brute force, round trips or held-out rows.
WITHOUT_SQL = {
    "op1_ngram_join": "test_tables.py", "op2_lm_score": "test_rows.py", "op3_language": "test_rows.py", "op4_html_text": "test_tables.py",
    "op6_packing": "test_tables.py", "op7_url_filter": "test_tables.py", "op8_sharding": "test_tables.py", "op9_warc": "test_tables.py",
    "op10_quality": "test_rows.py", "op11_fingerprint": "test_fingerprint.py", "pipeline": "test_tables.py",
}


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    assert set(e.queries()) - set(e.oracle_sql()) <= set(WITHOUT_SQL)
