from revmart.operators.dedup import SortKey
from revmart.plans import oltp
from revmart.schemas import SOURCE_PAYMENTS
from revmart.session import scratch_path
from revmart.sinks.partitioned import partition_versions
from tests.conftest import D, ts


def _rows(spark, rows):
    return spark.createDataFrame(
        [(tid, ts(created), ts(created), status, D("10.00"), "recarga", "B", "P", "C", "U")
         for tid, created, status in rows], SOURCE_PAYMENTS)


def test_insert_new_payments_counts_and_is_idempotent(spark):
    root = scratch_path(spark, "oltp-test")
    oltp.write_payments(spark, root, _rows(spark, [("a", "2025-01-01 00:00:00", "pending"),
                                                   ("z", "2024-06-01 00:00:00", "pending")]), "0")
    incoming = _rows(spark, [("a", "2025-02-01 00:00:00", "confirmed"),
                             ("b", "2025-01-05 00:00:00", "pending"),
                             ("b", "2025-01-03 00:00:00", "rejected")])
    order = [SortKey("updated_at", descending=False)]
    assert oltp.insert_new_payments(spark, root, incoming, order, "2025-03-01 00:00:00") == 1
    # the same run again (after a crash) rewrites its own version only
    oltp.insert_new_payments(spark, root, incoming, order, "2025-03-01 00:00:00")
    got = {r.transaction_id: r.status for r in oltp.read_payments(spark, root).collect()}
    assert got == {"a": "pending", "b": "rejected", "z": "pending"}
    versions = partition_versions(spark, root, oltp.PART_COL)
    assert versions["2024-06"] == "0" and versions["2025-01"] != "0"  # the other month's files stay


def test_confirm_newest_pending_stamps_only_chosen(spark):
    root = scratch_path(spark, "oltp-topk")
    oltp.write_payments(spark, root, _rows(spark, [("a", "2024-12-01 00:00:00", "pending"),
                                                   ("b", "2025-01-02 00:00:00", "pending"),
                                                   ("c", "2025-01-02 00:00:00", "pending"),
                                                   ("d", "2025-01-03 00:00:00", "confirmed")]), "0")
    oltp.confirm_newest_pending(spark, root, 2, "2025-05-01 00:00:00")
    rows = {r.transaction_id: r for r in oltp.read_payments(spark, root).collect()}
    # newest pending by created_at, ties broken by id: c then b
    assert {k for k, r in rows.items() if r.updated_at == ts("2025-05-01 00:00:00")} == {"b", "c"}
    assert rows["a"].status == "pending" and rows["b"].status == "confirmed"
    assert partition_versions(spark, root, oltp.PART_COL)["2024-12"] == "0"
