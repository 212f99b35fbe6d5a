"""Physical-plan guards for every registered query (planning only, no execution)."""

import pytest

from tests.conftest import SF_SMALL
from tickerlake.plans.catalog import QUERIES

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_or_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in plan]


@pytest.mark.parametrize("name", ["stg_board", "technical_indicators", "top_movers_k", "volume_leaders_k",
                                  "upsert_insert_only"])
def test_row_number_filters_become_group_limits(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    # a map-side (Partial) limit before the shuffle and a Final one after it
    assert any(line.rstrip().endswith("Partial") for line in limits)
    assert any(line.rstrip().endswith("Final") for line in limits)


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(QUERIES["incremental_copy"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id," in plan
    plan = _plan(QUERIES["technical_indicators"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_global_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["top_movers_global_k"](spark, SF_SMALL))
