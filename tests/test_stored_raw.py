"""Queries of several runs make the raw log once and read it as a table."""

from __future__ import annotations

import pytest

from revmart import queries
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", ["daily_revenue_after_missed_report", "daily_revenue_incremental",
                                  "fact_incremental_partitioned"])
def test_runs_read_a_stored_raw_log(spark, monkeypatch, name):
    plans = []
    monkeypatch.setattr(queries.fact, "refresh_fact_partitioned", lambda spark, raw, *a, **k: plans.append(
        raw._jdf.queryExecution().optimizedPlan().toString()))
    monkeypatch.setattr(queries.fact, "refresh_report_partitioned", lambda *a, **k: None)
    monkeypatch.setattr(queries.fact, "read_report_partitioned", lambda *a: None)
    monkeypatch.setattr(queries.fact, "read_fact_partitioned", lambda *a: None)
    monkeypatch.setattr(queries.fx, "raw_payments", lambda spark, sf_dir: spark.sql(
        "select * from values ('a', timestamp_ntz '1997-01-01') t(transaction_id, loaded_at) "
        "join values ('a', 1) u(k, v) on transaction_id = k"))
    queries.QUERIES[name](spark, SF_SMALL)
    assert len(plans) >= 2 and not any("Join" in p for p in plans)


def test_orders_take_their_customers_before_their_lines(spark):
    from revmart.sources import fixtures as fx
    plan = fx.source_payments(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    depth = {t: next(len(x) - len(x.lstrip(" :+-")) for x in plan.splitlines() if x.lstrip(" :+-").startswith("Relation")
                     and t in x) for t in ("l_orderkey", "o_orderkey", "c_custkey")}
    assert depth["o_orderkey"] == depth["c_custkey"]
