from revmart.operators.dedup import SortKey, latest_version
from revmart.plans.staging import PAYMENT_ORDER, stg_payments
from tests.conftest import D, ts

SCHEMA = ("transaction_id string, created_at timestamp_ntz, updated_at timestamp_ntz, status string, "
          "amount decimal(12,2), type string, company_code string, external_provider_id string, "
          "client_id string, external_client_id string, loaded_at timestamp_ntz")


def _row(tid, upd, status, loaded):
    return (tid, ts("2025-01-01 10:00:00"), ts(upd) if upd else None, status, D("10.00"), "recarga",
            "B1", "P1", "C1", "U1", ts(loaded) if loaded else None)


ROWS = [
    # pending then confirmed: the later update wins
    _row("t1", "2025-01-01 10:00:00", "pending", "2025-01-02 00:00:00"),
    _row("t1", "2025-01-03 10:00:00", "confirmed", "2025-01-04 00:00:00"),
    # equal updated_at: the later load wins
    _row("t2", "2025-01-01 10:00:00", "pending", "2025-01-02 00:00:00"),
    _row("t2", "2025-01-01 10:00:00", "rejected", "2025-01-05 00:00:00"),
    # NULL updated_at loses to any value (NULLS LAST)
    _row("t3", None, "rejected", "2025-01-09 00:00:00"),
    _row("t3", "2025-01-01 10:00:00", "confirmed", "2025-01-02 00:00:00"),
    # NULL loaded_at wins a tie on updated_at (DESC puts NULL first there)
    _row("t4", "2025-01-01 10:00:00", "pending", "2025-01-02 00:00:00"),
    _row("t4", "2025-01-01 10:00:00", "confirmed", None),
]
EXPECTED = {"t1": "confirmed", "t2": "rejected", "t3": "confirmed", "t4": "confirmed"}


def test_latest_version_rules(spark):
    raw = spark.createDataFrame(ROWS, SCHEMA)
    for method in ("window", "aggregate"):
        got = {r.transaction_id: r.status for r in
               latest_version(raw, ["transaction_id"], PAYMENT_ORDER, method=method).collect()}
        assert got == EXPECTED, method


def test_stg_payments_shape(spark):
    out = stg_payments(spark.createDataFrame(ROWS, SCHEMA))
    assert out.columns == ["transaction_id", "transaction_timestamp", "transaction_date", "status",
                           "amount", "type", "company_code", "provider_id", "client_id",
                           "external_client_id", "loaded_at"]
    assert out.count() == 4


def test_window_plan_limits_before_shuffle(spark):
    raw = spark.createDataFrame(ROWS, SCHEMA)
    plan = latest_version(raw, ["transaction_id"], PAYMENT_ORDER)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_ascending_keys(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "k string, v int")
    got = latest_version(df, ["k"], [SortKey("v", descending=False)]).orderBy("k").collect()
    assert [(r.k, r.v) for r in got] == [("a", 1), ("b", 2)]
