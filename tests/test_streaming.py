import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from revmart import queries as Q
from revmart.operators.dedup import SortKey
from revmart.functions.columns import ts_lit
from revmart.plans.enrich import enrich_payments
from revmart.plans.fact import read_fact_partitioned
from revmart.schemas import FACT_SCHEMA
from revmart.plans.marts import fact_rows
from revmart.plans.staging import stg_payments
from revmart.session import scratch_path
from revmart.sinks.storage import read_batches
from revmart.sources import fixtures as fx
from revmart.sinks.keyed import KeyedTable
from revmart.streaming import ingest as stream_ingest
from revmart.streaming.ingest import run_stream
from revmart.streaming.latest import read_latest, run_latest_stream
from tests.conftest import SF_SMALL


def test_two_available_now_runs_equal_batch(spark):
    base = scratch_path(spark, "stream-test")
    landing, raw_root, fact_root = f"{base}/landing", f"{base}/raw", f"{base}/fact"
    src = fx.source_payments(spark, SF_SMALL).drop("fixture_loaded_at")
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    cut = "1998-07-01 00:00:00"
    src.where(F.col("updated_at") <= ts_lit(cut)).write.mode("append").parquet(landing)
    assert run_stream(spark, landing, src.schema, raw_root, fact_root, f"{base}/ckpt", cut, ph, ch,
                      fx.TIEBREAK) >= 1
    # nothing new landed: the next run processes no batch
    assert run_stream(spark, landing, src.schema, raw_root, fact_root, f"{base}/ckpt",
                      "1998-07-02 00:00:00", ph, ch, fx.TIEBREAK) == 0
    src.where(F.col("updated_at") > ts_lit(cut)).write.mode("append").parquet(landing)
    run_stream(spark, landing, src.schema, raw_root, fact_root, f"{base}/ckpt",
               "2010-01-01 00:00:00", ph, ch, fx.TIEBREAK)
    raw_schema = StructType(list(src.schema.fields) + [StructField("loaded_at", TimestampNTZType())])
    raw = read_batches(spark, raw_root, raw_schema)
    assert raw.count() == src.where("type = 'recarga'").count()
    batch = fact_rows(enrich_payments(stg_payments(raw, tiebreak=fx.TIEBREAK), ph, ch))
    got = sorted(tuple(r) for r in read_fact_partitioned(spark, fact_root, FACT_SCHEMA).collect())
    assert got == sorted(tuple(r) for r in batch.collect())


def test_payment_that_goes_from_no_date_to_a_date_and_back_is_held_once(spark):
    base = scratch_path(spark, "stream-null-date")
    landing, fact_root = f"{base}/landing", f"{base}/fact"
    src = fx.source_payments(spark, SF_SMALL).drop("fixture_loaded_at")
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    first = src.where("type = 'recarga'").orderBy("transaction_id", "updated_at").limit(1)
    dated = spark.createDataFrame(first.collect(), StructType([StructField(f.name, f.dataType) for f in src.schema.fields]))
    undated = dated.withColumn("created_at", F.lit(None).cast(src.schema["created_at"].dataType))
    want = dated.select(F.to_date("created_at")).first()[0]
    for run, (rows, date) in enumerate([(undated, None), (dated, want), (undated, None)]):
        rows = rows.withColumn("updated_at", ts_lit(f"2001-01-0{run + 1} 00:00:00"))
        rows.select(*src.columns).write.mode("append").parquet(landing)
        run_stream(spark, landing, src.schema, f"{base}/raw", fact_root, f"{base}/ckpt",
                   f"2010-01-0{run + 1} 00:00:00", ph, ch, fx.TIEBREAK)
        fact = read_fact_partitioned(spark, fact_root, FACT_SCHEMA).collect()
        assert [r.transaction_date for r in fact] == [date]


def test_a_run_that_fails_between_raw_and_fact_leaves_one_stamp(spark, monkeypatch):
    base = scratch_path(spark, "stream-stamp")
    landing, raw_root, fact_root = f"{base}/landing", f"{base}/raw", f"{base}/fact"
    src = fx.source_payments(spark, SF_SMALL).drop("fixture_loaded_at")
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    src.write.parquet(landing)
    args = (spark, landing, src.schema, raw_root, fact_root, f"{base}/ckpt")
    with monkeypatch.context() as m:
        m.setattr(stream_ingest, "upsert_partitioned", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception):
            run_stream(*args, "2010-01-01 00:00:00", ph, ch, fx.TIEBREAK)
    assert run_stream(*args, "2010-01-02 00:00:00", ph, ch, fx.TIEBREAK, prune=True) >= 1
    raw_schema = StructType([*src.schema.fields, StructField("loaded_at", TimestampNTZType())])
    stamps = {r[0] for r in read_batches(spark, raw_root, raw_schema).select("loaded_at").distinct().collect()}
    in_fact = {r[0] for r in read_fact_partitioned(spark, fact_root, FACT_SCHEMA).select("loaded_at").distinct().collect()}
    assert stamps == in_fact == {dt.datetime(2010, 1, 1)}


def test_latest_writes_only_the_keys_that_came(spark):
    base = scratch_path(spark, "stream-latest")
    schema = StructType.fromDDL("k string, t int, v string")
    land = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/landing")
    run = lambda: run_latest_stream(spark, f"{base}/landing", schema, ["k"], [SortKey("t")], f"{base}/table",
                                    f"{base}/ckpt", rows_per_bucket=10)
    land([(f"k{i}", 1, "old") for i in range(40)])
    assert run() == 1
    land([("k7", 2, "new"), ("k8", 0, "late")])
    assert run() == 1 and run() == 0
    table = KeyedTable(spark, f"{base}/table", schema, ["k"])
    assert sorted(map(tuple, table.changes(max(table.versions())).collect())) == [("k7", 2, "new"), ("k8", 1, "old")]
    got = {r.k: r.v for r in read_latest(spark, f"{base}/table", schema, ["k"]).collect()}
    assert len(got) == 40 and got["k7"] == "new" and got["k8"] == "old"
