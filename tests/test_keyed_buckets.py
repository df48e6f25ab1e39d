"""Keyed tables: no bucket grows with the table, and rows dealt by key once stay where they lie."""

from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from revmart.plans import snapshots
from revmart.session import scratch_path
from revmart.sinks.keyed import KeyedTable

SCHEMA = StructType([StructField("k", StringType()), StructField("v", LongType())])


def _table(spark, **options):
    return KeyedTable(spark, scratch_path(spark, "keyed"), SCHEMA, ["k"], **options)


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_buckets_follow_the_rows(spark):
    table = _table(spark)
    assert [table._buckets(n) for n in (0, 1, 1_000_000, 5_000_000, 50_000_000)] == [1, 1, 1, 10, 100]
    assert table._buckets(5_000_000, now=6) == 6 and table._buckets(6_500_000, now=6) == 13
    assert table._buckets(10**15) == 100_000  # Spark's most


def test_changes_larger_than_the_base_have_more_buckets(spark):
    table = _table(spark, rows_per_bucket=10)
    table.create(spark.createDataFrame([("a", 0), ("b", 0)], SCHEMA), "1", at_most=2)
    many = spark.range(100).selectExpr("cast(id as string) k", "1 v").union(spark.createDataFrame([("a", 1)], SCHEMA))
    table.put(many, "2", after="1", at_most=101)
    assert table._folders("base") == {"1": 1} and table._folders("changes") == {"2": 11}
    rows = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(rows) == 102 and rows["a"] == 1 and rows["b"] == 0
    assert table.fold("2") and table._folders("base")["2"] == 11
    assert {r["k"]: r["v"] for r in table.read().collect()} == rows


def test_placed_rows_meet_the_stored_ones_without_an_exchange(spark, no_broadcast):
    table = _table(spark, rows_per_bucket=10)
    table.create(spark.range(50).selectExpr("cast(id as string) k", "0 v"), "1", at_most=50)
    new = table.placed(spark.range(20).selectExpr("cast(id as string) k", "1 v"), "1", 20)
    stored = table.read("1").selectExpr("k sk", "v sv")
    joined = new.join(stored, new["k"] == stored["sk"], "left").repartition(5, "k")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_a_snapshot_is_dealt_once(spark, no_broadcast, monkeypatch):
    """The guard, the join with the open rows and the write: one exchange of the snapshot, none of the open rows."""
    history = snapshots.HistoryTable(spark, scratch_path(spark, "history"), "clients", rows_per_bucket=10)
    rows = spark.range(60).selectExpr("concat('c', id) client_id", "cast(0.1 as decimal(5,4)) revenue_share",
                                      "'revenue_share' commission_type")
    history.step(rows, "2020-01-01 00:00:00")
    plans, put = [], history.open.put
    monkeypatch.setattr(history.open, "put", lambda moved, *a: plans.append(
        moved.repartition(6, "client_id")._jdf.queryExecution().executedPlan().toString()) or put(moved, *a))
    history.step(rows.where("client_id != 'c7'").selectExpr(
        "client_id", "cast(if(client_id = 'c3', 0.2, 0.1) as decimal(5,4)) revenue_share", "commission_type"),
        "2021-01-01 00:00:00")
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1]
    assert history.read().count() == 61


def test_a_fold_has_a_task_and_a_file_a_bucket(spark):
    table = _table(spark, rows_per_bucket=10)
    table.create(spark.range(50).selectExpr("cast(id as string) k", "0 v"), "1", at_most=50)
    table.put(spark.range(30, 60).selectExpr("cast(id as string) k", "1 v"), "2", after="1", at_most=30)
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    assert table.fold("2") and table._folders("base")["2"] == 5 and spark.conf.get(name) == before
    assert len(table._read("base", "2", 5).inputFiles()) == 5
    rows = {r["k"]: r["v"] for r in table.read().collect()}
    assert rows == {str(i): int(i >= 30) for i in range(60)}
