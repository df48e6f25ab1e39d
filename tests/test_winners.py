"""The keyed table (base and changes) and the fact that follows the winner table."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revmart import queries as Q
from revmart.plans import fact
from revmart.plans.winners import WinnerTable, merged_up_to, refresh_fact_from_winners
from revmart.schemas import FACT_SCHEMA, RAW_PAYMENTS
from revmart.session import scratch_path
from revmart.sinks.keyed import KeyedTable
from revmart.sinks.storage import append_batch
from revmart.sources import fixtures as fx
from tests.conftest import SF_SMALL, ts

CUTS = ["1997-01-01 00:00:00", "1999-01-01 00:00:00", "2100-01-01 00:00:00"]


def _files(root):
    return {p: p.stat().st_mtime_ns for p in Path(root.removeprefix("file:")).rglob("*.parquet")}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def pairs(spark):
    schema = StructType.fromDDL("k string, v int")
    table = KeyedTable(spark, scratch_path(spark, "keyed"), schema, ["k"], rows_per_bucket=10)
    return table, lambda rows: spark.createDataFrame(rows, schema)


def test_keyed_table_reads_as_of_any_version(pairs):
    table, df = pairs
    assert _rows(table.read()) == []
    table.create(df([(str(i), 0) for i in range(40)]), "1", at_most=40)
    table.put(df([("3", 1), ("new", 1)]), "2", after="1")
    table.put(df([("3", 2), ("5", 2)]), "3", after="2")
    as_of = {v: dict(_rows(table.read(v))) for v in "123"}
    assert len(as_of["1"]) == 40 and as_of["1"]["3"] == 0
    assert len(as_of["2"]) == 41 and as_of["2"]["3"] == 1 and as_of["2"]["new"] == 1
    assert len(as_of["3"]) == 41 and as_of["3"]["3"] == 2 and as_of["3"]["5"] == 2
    assert _rows(table.changes("3")) == [("3", 2), ("5", 2)]
    # folding changes no state, nor does running a version again
    assert table.fold("3", most_changes=2) and dict(_rows(table.read())) == as_of["3"]
    assert not table.fold("3")
    table.put(df([("3", 2), ("5", 2)]), "3", after="2")
    assert {v: dict(_rows(table.read(v))) for v in "123"} == as_of
    table.fold("3", most_changes=1)
    table.put(df([("x", 4)]), "4", after="3")
    assert table.prune(keep="3") == 3 and len(_rows(table.read())) == 42 and table.versions() == {"3", "4"}


def test_a_one_key_change_writes_only_its_row(pairs):
    table, df = pairs
    table.create(df([(str(i), 0) for i in range(40)]), "1", at_most=40)
    before = _files(table.root)
    table.put(df([("7", 1)]), "2", after="1")
    after = _files(table.root)
    assert {p: after[p] for p in before} == before  # the base's files are as they were
    assert table.changes("2").count() == 1 and not table.fold("2", share=5.0)


def test_merge_moves_the_changes_not_the_base(spark, pairs):
    table, df = pairs
    table.create(df([(str(i), 0) for i in range(40)]), "1", at_most=40)
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    def plan(version):
        stored = table.read(version).select(F.col("k").alias("s"), "v")
        joined = df([("3", 1)]).alias("c").join(stored, F.col("c.k") == F.col("s"), "left")
        return joined._jdf.queryExecution().executedPlan().toString()

    try:
        text = plan("1")
        table.put(df([("3", 1), ("x", 1)]), "2", after="1")
        table.put(df([("4", 2)]), "3", after="2")
        layered = plan("3")
    finally:
        spark.conf.set(name, old)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    # with changes on top: what comes, and the keys of the changes; neither the base nor the union of the layers
    assert layered.count("Exchange hashpartitioning") == 2 and "Bucketed: false" not in layered


def _run(spark, base, winners, raw, runs, append=True):
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    for i in runs:
        if append:
            append_batch(Q._landed(raw, "loaded_at", CUTS[i], CUTS), f"{base}/raw", f"{i + 1}")
        refresh_fact_from_winners(spark, f"{base}/raw", winners, ph, ch, f"{base}/fact", f"{i + 1}")
    return _rows(fact.read_fact_partitioned(spark, f"{base}/fact", FACT_SCHEMA))


def _tables(spark, name, raw):
    base = scratch_path(spark, name)
    return base, WinnerTable(spark, f"{base}/winners", raw.schema, fx.TIEBREAK, rows_per_bucket=500)


@pytest.fixture(scope="module")
def raw(spark):
    return fx.raw_payments(spark, SF_SMALL)


@pytest.fixture(scope="module")
def from_whole_raw(spark, raw):
    """The same three runs by reading the whole raw log each time."""
    base = scratch_path(spark, "whole")
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    for i, cut in enumerate(CUTS):
        fact.refresh_fact_partitioned(spark, raw.where(F.col("loaded_at") <= F.lit(cut).cast("timestamp_ntz")), ph, ch,
                                      f"{base}/fact", str(i), tiebreak=fx.TIEBREAK)
    return _rows(fact.read_fact_partitioned(spark, f"{base}/fact", FACT_SCHEMA))


def test_runs_do_not_read_older_raw_batches(spark, raw, from_whole_raw):
    base, winners = _tables(spark, "winners", raw)
    _run(spark, base, winners, raw, [0])
    for i in (1, 2):
        for path in _files(f"{base}/raw"):  # every batch so far can no longer be read
            path.write_bytes(b"gone")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
        got = _run(spark, base, winners, raw, [i])
    assert got == from_whole_raw
    assert _rows(winners.read().select("transaction_id")) == [(r[0],) for r in got]


def test_an_unfinished_run_is_made_up_for(spark, raw, from_whole_raw):
    base, winners = _tables(spark, "unfinished", raw)
    _run(spark, base, winners, raw, [0])
    append_batch(Q._landed(raw, "loaded_at", CUTS[1], CUTS), f"{base}/raw", "2")
    winners.merge(f"{base}/raw", "2", after="1")  # ... and the fact of run 2 is never written
    assert merged_up_to(spark, winners, f"{base}/fact", before="3") == "1"
    assert _run(spark, base, winners, raw, [2]) == from_whole_raw


def test_running_a_version_again_changes_nothing(spark, raw, from_whole_raw):
    base, winners = _tables(spark, "again", raw)
    _run(spark, base, winners, raw, [0, 1, 2])
    assert _run(spark, base, winners, raw, [2, 1, 2], append=False) == from_whole_raw


def _raw_row(key, updated, loaded, created="2024-01-01 00:00:00", amount="10.00"):
    return (key, ts(created), updated and ts(updated), "confirmed", Decimal(amount), "recarga", "B", "P", "C", "U",
            loaded and ts(loaded))


def test_null_order_dates_and_moved_dates(spark):
    base = scratch_path(spark, "odd")
    winners = WinnerTable(spark, f"{base}/winners")
    append_batch(spark.createDataFrame([
        _raw_row("a", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
        _raw_row("b", None, "2024-01-02 00:00:00"),
        _raw_row("c", "2024-01-01 00:00:00", "2024-01-02 00:00:00")], RAW_PAYMENTS), f"{base}/raw", "1")
    winners.merge(f"{base}/raw", "1", None)
    append_batch(spark.createDataFrame([
        _raw_row("a", None, "2024-02-02 00:00:00", amount="11.00"),  # no update time loses
        _raw_row("b", "2023-01-01 00:00:00", "2024-02-02 00:00:00", "2024-03-01 00:00:00", "12.00"),  # any wins over none
        _raw_row("c", "2024-01-01 00:00:00", None, amount="13.00"),  # equal update: an unknown load wins
        _raw_row("d", "2024-01-01 00:00:00", "2024-02-02 00:00:00")], RAW_PAYMENTS), f"{base}/raw", "2")
    changed = {r["transaction_id"]: r for r in winners.merge(f"{base}/raw", "2", "1").collect()}
    assert set(changed) == {"b", "c", "d"}
    assert changed["b"]["replaces"] and changed["b"]["replaced_created_at"] == dt.datetime(2024, 1, 1)
    assert not changed["d"]["replaces"] and changed["d"]["replaced_created_at"] is None
    assert {r["transaction_id"]: r["amount"] for r in winners.read().collect()} == {
        "a": Decimal("10.00"), "b": Decimal("12.00"), "c": Decimal("13.00"), "d": Decimal("10.00")}
