"""Histories with closed rows written once, against replaying ``scd2_step`` on whole histories."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pytest

from revmart.plans import snapshots
from revmart.session import scratch_path

RUNS = [f"2024-0{i}-01 00:00:00" for i in range(1, 6)]


def _snapshot(spark, shares):
    rows = [(k, v and Decimal(v), "revenue_share") for k, v in shares.items()]
    return spark.createDataFrame(rows, "client_id string, revenue_share decimal(5,4), commission_type string")


#: new keys, changes, values to NULL and back, a missing key that returns, nothing, an empty snapshot
SHARES = [{"a": "0.1", "b": "0.2", "c": None}, {"a": "0.1", "b": "0.3", "c": "0.4", "d": "0.5"},
          {"a": None, "c": "0.4", "d": "0.5"}, {}, {"a": "0.1", "b": "0.3", "e": "0.6"}]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _stored(root):
    return {p: p.stat().st_mtime_ns for p in Path(root.removeprefix("file:")).rglob("*.parquet")}


@pytest.fixture
def history(spark):
    return snapshots.HistoryTable(spark, scratch_path(spark, "history"), "clients", rows_per_bucket=2)


def test_equals_replayed_steps(spark, history):
    whole = spark.createDataFrame([], snapshots.CLIENT_HISTORY)
    for run, shares in zip(RUNS, SHARES):
        before = _stored(history.closed_root)
        history.step(_snapshot(spark, shares), run)
        whole = spark.createDataFrame(snapshots.snapshot_step(whole, _snapshot(spark, shares), run, "clients").collect(),
                                      snapshots.CLIENT_HISTORY)
        assert _rows(history.read()) == _rows(whole)
        now = _stored(history.closed_root)
        assert {p: now[p] for p in before} == before  # closed files keep their names and contents


def test_a_run_writes_only_what_moved(spark, history):
    history.step(_snapshot(spark, SHARES[0]), RUNS[0])
    version = history.step(_snapshot(spark, SHARES[0] | {"b": "0.9"}), RUNS[1])
    assert [r["client_id"] for r in history.open.changes(version).collect()] == ["b"]
    assert history.read().count() == 4


def test_unfinished_and_repeated_runs(spark, history, monkeypatch):
    for run, shares in zip(RUNS[:2], SHARES):
        history.step(_snapshot(spark, shares), run)
    want = _rows(history.read())
    # a third run writes its open rows and dies before its closed ones
    with monkeypatch.context() as m:
        m.setattr(snapshots, "append_batch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            history.step(_snapshot(spark, {"d": "0.9", "x": "0.1"}), "2024-02-15 00:00:00")
    assert _rows(history.read()) == want
    history.step(_snapshot(spark, SHARES[2]), RUNS[2])  # "d" is as it was: the dead run's row does not show
    assert {r["client_id"]: r["revenue_share"] for r in history.read().where("valid_to is null").collect()} == {
        "a": None, "b": Decimal("0.3"), "c": Decimal("0.4"), "d": Decimal("0.5")}
    again = _rows(history.read())
    history.step(_snapshot(spark, SHARES[2]), RUNS[2])
    history.step(_snapshot(spark, SHARES[1]), RUNS[1])  # an older run sees what it saw
    assert _rows(history.read()) == again and _rows(history.read(upto="20240201T000000000000")) == want


def test_a_key_twice_in_a_snapshot_fails(spark, history):
    rows = _snapshot(spark, {"a": "0.1"})
    with pytest.raises(Exception, match="not unique"):
        history.step(rows.union(rows), RUNS[0])
