"""The report by retraction equals its rebuild, and reads no unchanged fact row."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql.types import StructField, StructType

from revmart import queries as Q
from revmart.plans import ledger as ledger_module
from revmart.plans import marts
from revmart.plans.ledger import PaymentLedger, signed_rows, sums_of
from revmart.plans.snapshots import CLIENT_HISTORY, PROVIDER_HISTORY
from revmart.schemas import RAW_PAYMENTS
from revmart.session import scratch_path
from revmart.sinks.storage import append_batch
from tests.conftest import SF_SMALL, ts


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _row(key, day, status, amount, client="C", provider="P", loaded="2024-02-01 00:00:00"):
    return (key, day and ts(f"{day} 10:00:00"), ts(loaded), status, amount and Decimal(amount), "recarga", "B", provider,
            client, "U", ts(loaded))


@pytest.fixture(scope="module")
def histories(spark):
    start = ts("2020-01-01 00:00:00")
    return (spark.createDataFrame([("P", "B", Decimal("0.1"), "amount", start, None)], PROVIDER_HISTORY),
            spark.createDataFrame([("C", Decimal("0.5"), "revenue_share", start, None)], CLIENT_HISTORY))


RUNS = [
    [_row("a", "2024-01-01", "confirmed", "10.00"), _row("b", "2024-01-01", "pending", "20.00"),
     _row("c", "2024-01-02", "confirmed", "30.00"), _row("d", "2024-01-03", "confirmed", "40.00", client="unknown"),
     _row("e", None, "confirmed", "50.00", client=None), _row("f", "2024-01-04", None, None)],
    # confirmed to rejected; a date that moves and empties its group; NULL group and NULL amount get values
    [_row("a", "2024-01-01", "rejected", "10.00", loaded="2024-02-02 00:00:00"),
     _row("c", "2024-01-05", "confirmed", "31.00", loaded="2024-02-02 00:00:00"),
     _row("e", None, "confirmed", "55.00", client=None, loaded="2024-02-02 00:00:00"),
     _row("f", "2024-01-04", "confirmed", "5.00", loaded="2024-02-02 00:00:00")],
    # back to no value; a new payment in the emptied group; a late row that loses
    [_row("f", "2024-01-04", "confirmed", None, loaded="2024-02-03 00:00:00"),
     _row("g", "2024-01-02", "confirmed", "7.00", loaded="2024-02-03 00:00:00"),
     _row("c", "2024-01-02", "confirmed", "1.00", loaded="2023-01-01 00:00:00")],
]


#: Parquet does not hold a table to its NOT NULL columns.
LOOSE = StructType([StructField(f.name, f.dataType) for f in RAW_PAYMENTS.fields])


def _append(spark, base, i):
    append_batch(spark.createDataFrame(RUNS[i], LOOSE), f"{base}/raw", f"{i + 1}")


def test_every_run_equals_the_rebuild(spark, histories):
    base = scratch_path(spark, "ledger")
    ledger = PaymentLedger(spark, f"{base}/ledger")
    for i in range(3):
        _append(spark, base, i)
        ledger.refresh(f"{base}/raw", *histories, f"{i + 1}")
        assert _rows(ledger.read_report()) == _rows(marts.daily_revenue(ledger.read_fact()))
    fact = {r["transaction_id"]: r for r in ledger.read_fact().collect()}
    assert len(fact) == 7 and fact["c"]["amount"] == Decimal("31.00") and fact["f"]["amount"] is None
    report = {(r["report_date"] and str(r["report_date"]), r["client_id"]): r for r in ledger.read_report().collect()}
    assert report["2024-01-04", "C"]["total_amount"] is None  # no value left: NULL, not 0
    assert report["2024-01-01", "C"]["confirmed_amount"] is None and report[None, None]["total_transactions"] == 1
    # as of an older version too
    assert _rows(ledger.read_report("2")) == _rows(marts.daily_revenue(ledger.read_fact("2")))


def test_only_changed_rows_are_read_and_written(spark, histories):
    base = scratch_path(spark, "ledger-io")
    ledger = PaymentLedger(spark, f"{base}/ledger")
    for i in range(2):
        _append(spark, base, i)
        ledger.refresh(f"{base}/raw", *histories, f"{i + 1}")
    written = ledger.table.changes("2")
    assert sorted(r["transaction_id"] for r in written.collect()) == ["a", "c", "e", "f"]
    change = sums_of(signed_rows(written))
    assert change.inputFiles() and all("/payments/changes/v=2" in f for f in change.inputFiles())
    assert signed_rows(written).count() == 8
    # the groups that no changed row is in are not written either
    assert {str(r["report_date"]) for r in ledger.sums.changes("2").collect()} == {
        "2024-01-01", "2024-01-02", "2024-01-04", "2024-01-05", "None"}


def test_unfinished_and_repeated_runs(spark, histories, monkeypatch):
    base = scratch_path(spark, "ledger-again")
    ledger = PaymentLedger(spark, f"{base}/ledger")
    _append(spark, base, 0)
    ledger.refresh(f"{base}/raw", *histories, "1")
    # Run 2 moves "c" to a group of its own and dies before its mark: payments and sums are written.
    moved = [*RUNS[1], _row("a", "2024-03-03", "confirmed", "10.00", loaded="2024-02-02 12:00:00")]
    append_batch(spark.createDataFrame(moved, LOOSE), f"{base}/raw", "2")
    with monkeypatch.context() as m:
        m.setattr(ledger_module, "_save_mark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ledger.refresh(f"{base}/raw", *histories, "2")
    assert {"2"} < ledger.sums.versions() and ledger.merged_up_to("3") == "1"
    # Run 3 starts from run 1 and moves it on: nothing of run 2's own group is left.
    again = [*RUNS[2], _row("a", "2024-04-04", "confirmed", "10.00", loaded="2024-02-03 00:00:00")]
    append_batch(spark.createDataFrame(again, LOOSE), f"{base}/raw", "3")
    for version in ("3", "3"):
        ledger.refresh(f"{base}/raw", *histories, version)
        assert _rows(ledger.read_report()) == _rows(marts.daily_revenue(ledger.read_fact()))
    days = {str(r["report_date"]) for r in ledger.read_report().collect()}
    assert "2024-03-03" not in days and "2024-04-04" in days
    assert ledger.read_fact().count() == 7


def test_no_rows(spark, histories):
    base = scratch_path(spark, "ledger-empty")
    ledger = PaymentLedger(spark, f"{base}/ledger")
    append_batch(spark.createDataFrame([], RAW_PAYMENTS), f"{base}/raw", "1")
    ledger.refresh(f"{base}/raw", *histories, "1")
    assert ledger.read_report().count() == 0 and ledger.read_fact().count() == 0
    _append(spark, base, 1)
    ledger.refresh(f"{base}/raw", *histories, "2")
    assert _rows(ledger.read_report()) == _rows(marts.daily_revenue(ledger.read_fact()))


def test_hot_payment_equals_the_partitioned_fact(spark):
    got = Q.q_fact_ledger(spark, SF_SMALL)
    assert _rows(got) == _rows(Q.q_fact_incremental_hot_payment(spark, SF_SMALL).select(*got.columns))
