"""Traps T14 and T20: rows are frozen at load, but a re-extracted copy restates them."""

from revmart.plans.fact import read_fact, refresh_fact
from revmart.schemas import RAW_PAYMENTS
from revmart.session import scratch_path
from tests.conftest import D, ts

HIST = ("provider_id string, biller_id string, commission_rate decimal(5,4), "
        "valid_from timestamp_ntz, valid_to timestamp_ntz")
CLIENTS = "client_id string, revenue_share decimal(5,4), valid_from timestamp_ntz, valid_to timestamp_ntz"


def _raw(spark, loaded):
    # created before the first rate version: the rate comes from the fallback
    return spark.createDataFrame([("t1", ts("2024-06-01 00:00:00"), ts("2024-06-01 00:00:00"),
                                   "confirmed", D("100.00"), "recarga", "B1", "P1", "C1", "U1",
                                   ts(loaded))], RAW_PAYMENTS)


def test_frozen_unless_reloaded(spark):
    clients = spark.createDataFrame([("C1", D("0.5000"), ts("2025-01-01 00:00:00"), None)], CLIENTS)
    v1 = spark.createDataFrame([("P1", "B1", D("0.0500"), ts("2025-01-01 00:00:00"), None)], HIST)
    v2 = spark.createDataFrame([("P1", "B1", D("0.0500"), ts("2025-01-01 00:00:00"),
                                 ts("2025-03-01 00:00:00")),
                                ("P1", "B1", D("0.0800"), ts("2025-03-01 00:00:00"), None)], HIST)
    root = scratch_path(spark, "restate")
    raw1 = _raw(spark, "2025-02-01 00:00:00")
    refresh_fact(spark, raw1, v1, clients, root, "1")
    assert read_fact(spark, root).first().gross_revenue == D("5.0000")
    # T14: the rate changed, nothing reloaded -> the row stays frozen
    refresh_fact(spark, raw1, v2, clients, root, "2")
    assert read_fact(spark, root).first().gross_revenue == D("5.0000")
    # T20: the same row extracted again (crash before the mark was saved) has a
    # newer loaded_at, wins the dedup and is restated at the current fallback rate
    raw2 = raw1.unionByName(_raw(spark, "2025-04-01 00:00:00"))
    refresh_fact(spark, raw2, v2, clients, root, "3")
    row = read_fact(spark, root).first()
    assert row.gross_revenue == D("8.0000") and row.commission_rate == D("0.0800")
    assert read_fact(spark, root).count() == 1
