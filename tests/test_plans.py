"""Plan assertions on the registered queries that do not write tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

LAZY = ["latest_payments", "latest_event_per_user", "interval_lookup_providers",
        "interval_lookup_clients", "payments_enriched", "daily_revenue", "insert_if_absent",
        "topk_update", "semi_join_topk", "dq_max_length", "dq_confirmation_rate_range",
        "scd2_providers", "scd2_clients"]
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_or_pairwise_joins(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_dedup_limits_before_shuffle_and_filters_reach_the_scan(spark):
    plan = _plan(entry.queries()["payments_enriched"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    lineitem_scan = [line for line in plan.splitlines() if "lineitem.parquet" in line][0]
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)" in lineitem_scan
    # column pruning: quantity, discount and tax are never read
    assert "l_quantity" not in lineitem_scan and "l_tax" not in lineitem_scan


def test_report_aggregates_partially_before_shuffle(spark):
    plan = _plan(entry.queries()["daily_revenue"](spark, SF_SMALL))
    assert plan.count("HashAggregate") >= 2  # partial + final


def test_topk_is_take_ordered(spark):
    plan = _plan(entry.queries()["semi_join_topk"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan
