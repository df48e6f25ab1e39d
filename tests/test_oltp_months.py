"""Writes to the payments table read only the months that matter."""

from __future__ import annotations

from pyspark.sql.types import StructField, StructType

from revmart.operators.dedup import SortKey
from revmart.operators.keyfilter import FILTERS, add_keys, build_filters, possible_parts
from revmart.plans import oltp
from revmart.schemas import SOURCE_PAYMENTS
from revmart.session import scratch_path
from tests.conftest import D, ts

LOOSE = StructType([StructField(f.name, f.dataType) for f in SOURCE_PAYMENTS.fields])


def _payment(key, created, status="pending", amount="1.00"):
    return (key, created and ts(f"{created} 00:00:00"), ts("2024-01-01 00:00:00"), status, D(amount), "recarga", "B", "P",
            "C", "U")


def _stored(spark, rows):
    root = scratch_path(spark, "oltp-months")
    oltp.write_payments(spark, root, spark.createDataFrame(rows, LOOSE), "20240101T000000000000")
    return root


def test_bitmaps_hide_no_key_and_name_few_months(spark):
    rows = spark.range(20_000).selectExpr("cast(id as string) k", "concat('m', id % 20) m")
    filters = build_filters(rows, ["k"], "m").cache()
    assert filters.groupBy("part").count().count() == 20
    for m in range(20):
        asked = rows.where(f"m = 'm{m}'").limit(3).select("k")
        assert f"m{m}" in {r["part"] for r in possible_parts(filters, asked, ["k"]).collect()}
    everything = {r["part"] for r in possible_parts(filters, rows.select("k"), ["k"]).collect()}
    assert everything == {f"m{m}" for m in range(20)}
    unknown = spark.range(100).selectExpr("concat('other', id) k")  # 2000 questions, 1 in 4096 wrong
    assert possible_parts(filters, unknown, ["k"]).count() <= 3
    came = spark.createDataFrame([("new", "m3"), ("newer", "m99")], "k string, m string")
    added = add_keys(filters, came, ["k"], "m")
    assert added.count() == 2 * FILTERS
    keys = ["part", "filter", "piece"]
    now = filters.join(added.select(*keys), keys, "left_anti").unionByName(added)
    assert {"m3", "m99"} <= {r["part"] for r in possible_parts(now, came, ["k"]).collect()}
    m3 = rows.where("m = 'm3'").select("k")
    assert possible_parts(now, m3, ["k"]).where("part = 'm3'").count() == 1


def test_an_insert_reads_only_the_months_that_may_hold_its_keys(spark):
    rows = [_payment(f"{m}-{i}", f"2023-{m:02d}-01") for m in range(1, 13) for i in range(50)] + [_payment("none", None)]
    root = _stored(spark, rows)
    version = "20240102T000000000000"
    incoming = spark.createDataFrame([_payment("3-7", "2023-09-01"), _payment("none", "2023-05-01"),
                                      _payment("new", "2024-01-01")], LOOSE)
    months = oltp.months_of(spark, root, incoming, version)
    assert {"2023-03", "__HIVE_DEFAULT_PARTITION__"} <= months and len(months) <= 4
    read = oltp.read_payments(spark, root, before=version, only=months).inputFiles()
    assert {f.split("created_month=")[1].split("/")[0] for f in read} == months
    before = {f for f in oltp.read_payments(spark, root).inputFiles()}
    order = [SortKey("updated_at", descending=False)]
    assert oltp.insert_new_payments(spark, root, incoming, order, "2024-01-02 00:00:00") == 1
    after = {f for f in oltp.read_payments(spark, root).inputFiles()}
    assert before <= after and len(after) == len(before) + 1  # the new month only
    # the bitmaps know the new key: it is not inserted twice, nor by a run without them
    assert oltp.insert_new_payments(spark, root, incoming, order, "2024-01-03 00:00:00") == 0
    assert oltp.insert_new_payments(spark, root, incoming, order, "2024-01-04 00:00:00", look_up_at_most=0) == 0
    assert oltp.read_payments(spark, root).count() == len(rows) + 1


def _months_read(df):
    return {f.split("created_month=")[1].split("/")[0] for f in df.inputFiles()}


def test_newest_pending_stops_at_the_first_month_that_holds_enough(spark):
    rows = [_payment(f"{m:02d}-{i}", f"2023-{m:02d}-{i + 1:02d}") for m in range(1, 13) for i in range(9)]
    rows += [_payment("none", None), _payment("done", "2024-06-01", status="confirmed")]
    root = _stored(spark, rows)
    read = []
    whole = oltp.read_payments
    oltp.read_payments = lambda *a, **k: read.append(whole(*a, **k)) or read[-1]
    try:
        few = {r["transaction_id"] for r in oltp.newest_pending(spark, root, 5).collect()}
        first = [sorted(_months_read(df)) for df in read]
        read.clear()
        all_of_them = oltp.newest_pending(spark, root, 1000).collect()
        second = [sorted(_months_read(df)) for df in read]
    finally:
        oltp.read_payments = whole
    assert few == {f"12-{i}" for i in range(4, 9)}
    assert first == [["2024-06"], ["2023-11", "2023-12"]]  # one, then two: no more
    assert len(all_of_them) == 109 and second[-1] == ["__HIVE_DEFAULT_PARTITION__"]  # undated rows come last
    got = oltp.newest_pending(spark, root, 100).collect()
    want = sorted((r[0] for r in rows if r[3] == "pending" and r[1]), key=lambda k: (k[:2], int(k[3:])), reverse=True)[:100]
    assert sorted(r["transaction_id"] for r in got) == sorted(want)
    assert oltp.newest_pending(spark, _stored(spark, []), 3).count() == 0
