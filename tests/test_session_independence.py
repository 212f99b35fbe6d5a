"""Results do not depend on the caller's session time zone or ANSI mode."""

import pytest

from tests.conftest import SF_SMALL
from tickerlake.plans.catalog import QUERIES
from tickerlake.plans.compare import compare, duckdb_connection
from tickerlake.plans.oracle_sql import ORACLE

TIME_SENSITIVE = ("scan_board", "stg_board", "latest_board", "tax_summary", "daily_bars", "incremental_copy",
                  "ingest_bars_normalize", "upsert_insert_only", "technical_indicators")


@pytest.mark.parametrize("conf", [{"spark.sql.session.timeZone": "America/Sao_Paulo"},
                                  {"spark.sql.session.timeZone": "Asia/Kolkata", "spark.sql.ansi.enabled": "false"}])
def test_queries_ignore_session_zone_and_ansi(spark, conf):
    con = duckdb_connection(SF_SMALL)
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        bad = [n for n in TIME_SENSITIVE if not compare(QUERIES[n](spark, SF_SMALL), con, ORACLE[n])["ok"]]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert bad == []


def test_checkpoint_dir_comes_from_the_session(spark):
    from tickerlake.session import ensure_checkpoint_dir

    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() is not None
