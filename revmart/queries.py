"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (or tables Spark derives from them)
in full; writing queries put their tables in a fresh folder under the
session's shared checkpoint dir.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions.columns import ts_lit
from revmart.operators.dedup import SortKey, latest_version
from revmart.operators.topk import semi_join, top_k_keys
from revmart.plans import checks, enrich, fact, ingest, marts, snapshots, staging
from revmart.schemas import RAW_CLIENTS, RAW_PAYMENTS, RAW_PROVIDERS, SOURCE_PAYMENTS, WATERMARK
from revmart.session import scratch_path
from revmart.sinks.storage import read_batches, read_current, version_id, write_version
from revmart.sources import fixtures as fx
from revmart.sources.tables import layer_table, read_table

# Fixed scenario parameters of the multi-run queries.
LATE_AFTER = "1998-05-01 00:00:00"
INGEST_RUNS = ["1998-07-01 00:00:00", "2010-01-01 00:00:00"]
EVENT_INGEST_RUNS = ["2024-01-15 00:00:00", "2024-03-01 00:00:00"]
FACT_FIRST_LOAD_BEFORE = "1998-01-01 00:00:00"
INSERT_EXISTING_BEFORE = "1998-01-01 00:00:00"
HOT_PAYMENT = "hot"
HOT_RUNS = ["1998-01-01 00:00:00", "1999-06-01 00:00:00", "2010-01-01 00:00:00"]
TOPK_N = 100
TOPK_MANY = 1000
TOPK_RUN_TS = "2010-01-01 00:00:00"


def _stg(spark, sf_dir) -> DataFrame:
    return staging.stg_payments(fx.raw_payments(spark, sf_dir), tiebreak=fx.TIEBREAK)


def _provider_history(spark, sf_dir, replay: bool = False) -> DataFrame:
    """Provider rate history: replayed run by run with ``scd2_step``, or rebuilt in one
    pass from the snapshot archive (equal, see tests/test_scd2.py)."""
    snaps = fx.provider_snapshots(spark, sf_dir)
    if replay:
        return snapshots.replay(spark, snaps, fx.SNAPSHOT_RUNS, "providers")
    return snapshots.rebuild(snaps, "providers")


def _client_history(spark, sf_dir, replay: bool = False) -> DataFrame:
    snaps = fx.client_snapshots(spark, sf_dir)
    if replay:
        return snapshots.replay(spark, snaps, fx.SNAPSHOT_RUNS, "clients")
    return snapshots.rebuild(snaps, "clients")


def _enriched(spark, sf_dir) -> DataFrame:
    return enrich.enrich_payments(_stg(spark, sf_dir), _provider_history(spark, sf_dir),
                                  _client_history(spark, sf_dir))


def _oltp_payments(spark, sf_dir) -> DataFrame:
    """The OLTP table (one row per payment): latest version of every source row."""
    src = fx.source_payments(spark, sf_dir)
    order = staging.payment_order(fx.TIEBREAK)
    order = [SortKey("updated_at"), SortKey("fixture_loaded_at", nulls_first=True)] + order[2:]
    return latest_version(src, ["transaction_id"], order).select(*SOURCE_PAYMENTS.fieldNames())


# ---- staging, snapshots, dimensions --------------------------------------

def q_latest_payments(spark, sf_dir):
    return _stg(spark, sf_dir)


def q_scd2_providers(spark, sf_dir):
    return _provider_history(spark, sf_dir, replay=True)


def q_scd2_clients(spark, sf_dir):
    return _client_history(spark, sf_dir, replay=True)


def q_dim_providers_current(spark, sf_dir):
    return marts.dim_providers(_provider_history(spark, sf_dir, replay=True))


def q_dim_clients_current(spark, sf_dir):
    return marts.dim_clients(_client_history(spark, sf_dir, replay=True))


# ---- point-in-time lookups, enrichment, marts -----------------------------

def q_interval_lookup_providers(spark, sf_dir):
    out = enrich.lookup_commission(_stg(spark, sf_dir), _provider_history(spark, sf_dir))
    return out.select("transaction_id", "transaction_timestamp", "provider_id",
                      out["company_code"].alias("biller_id"), "commission_rate")


def q_interval_lookup_clients(spark, sf_dir):
    out = enrich.lookup_share(_stg(spark, sf_dir), _client_history(spark, sf_dir))
    return out.select("transaction_id", "transaction_timestamp", "client_id", "revenue_share")


def q_payments_enriched(spark, sf_dir):
    return _enriched(spark, sf_dir)


def _stored(spark, rows: DataFrame, layer: str, name: str) -> DataFrame:
    """``rows`` as a stored table, for what is read by several runs or steps."""
    root = layer_table(scratch_path(spark, "stored"), layer, name)
    write_version(rows, root, version_id(INGEST_RUNS[1]))
    return read_current(spark, root, rows.schema)


def _stored_raw(spark, sf_dir) -> DataFrame:
    return _stored(spark, fx.raw_payments(spark, sf_dir), "raw", "payments")


def _large_histories(spark, sf_dir):
    """Both large histories, run by run: closed rows appended, open rows in key buckets."""
    pairs = _stored(spark, fx.supplier_parts(spark, sf_dir), "source", "supplier_parts")
    out = []
    for kind, snaps in (("providers", fx.large_provider_snapshots(pairs)),
                        ("clients", fx.large_client_snapshots(spark, sf_dir))):
        history = snapshots.HistoryTable(spark, scratch_path(spark, f"history_{kind}"), kind)
        for run in fx.SNAPSHOT_RUNS:
            history.step(snaps.where(F.col("run_ts") == ts_lit(run)), run)
        out.append(history.read())
    return out


def _stored_stg(spark, sf_dir) -> DataFrame:
    """The deduplicated payments with the large rate keys, as a stored table."""
    rows = staging.stg_payments(fx.large_payments(spark, sf_dir), tiebreak=fx.TIEBREAK)
    return _stored(spark, rows, "staging", "payments")


def q_scd2_large(spark, sf_dir):
    """History of the rates of every supplier and part, one row per version."""
    return _large_histories(spark, sf_dir)[0]


def q_interval_lookup_large(spark, sf_dir):
    """Rates by supplier and part, and shares by customer, at each payment's time: as-of merges, no broadcast."""
    providers, clients = _large_histories(spark, sf_dir)
    stg = _stored_stg(spark, sf_dir)
    out = enrich.lookup_share(enrich.lookup_commission(stg, providers, large=True), clients, large=True, times=stg)
    return out.select("transaction_id", "transaction_timestamp", "provider_id",
                      F.col("company_code").alias("biller_id"), "client_id", "commission_rate", "revenue_share")


def q_payments_enriched_large(spark, sf_dir):
    return enrich.enrich_payments(_stored_stg(spark, sf_dir), *_large_histories(spark, sf_dir), large=True)


def q_daily_revenue(spark, sf_dir):
    return marts.daily_revenue(marts.fact_rows(_enriched(spark, sf_dir)))


def q_fact_full(spark, sf_dir):
    root = layer_table(scratch_path(spark, "fact_full"), "marts", "fact_payments")
    fact.refresh_fact(spark, fx.raw_payments(spark, sf_dir), _provider_history(spark, sf_dir),
                      _client_history(spark, sf_dir), root, version_id(INGEST_RUNS[0]),
                      full_refresh=True, tiebreak=fx.TIEBREAK)
    return fact.read_fact(spark, root)


def q_fact_incremental_upsert(spark, sf_dir):
    """First load from the raw rows loaded before a cutoff, then one incremental run."""
    root = layer_table(scratch_path(spark, "fact_incr"), "marts", "fact_payments")
    raw = _stored_raw(spark, sf_dir)
    ph, ch = _provider_history(spark, sf_dir), _client_history(spark, sf_dir)
    first = raw.where(F.col("loaded_at") < ts_lit(FACT_FIRST_LOAD_BEFORE))
    fact.refresh_fact(spark, first, ph, ch, root, version_id(INGEST_RUNS[0]), tiebreak=fx.TIEBREAK)
    fact.refresh_fact(spark, raw, ph, ch, root, version_id(INGEST_RUNS[1]), tiebreak=fx.TIEBREAK)
    return fact.read_fact(spark, root)


def q_fact_incremental_partitioned(spark, sf_dir):
    """The same two runs on the date-partitioned fact (touched partitions rewritten only)."""
    from revmart.schemas import FACT_SCHEMA
    root = layer_table(scratch_path(spark, "fact_part"), "marts", "fact_payments")
    raw = _stored_raw(spark, sf_dir)
    ph, ch = _provider_history(spark, sf_dir), _client_history(spark, sf_dir)
    first = raw.where(F.col("loaded_at") < ts_lit(FACT_FIRST_LOAD_BEFORE))
    fact.refresh_fact_partitioned(spark, first, ph, ch, root, version_id(INGEST_RUNS[0]),
                                  tiebreak=fx.TIEBREAK)
    fact.refresh_fact_partitioned(spark, raw, ph, ch, root, version_id(INGEST_RUNS[1]),
                                  tiebreak=fx.TIEBREAK)
    return fact.read_fact_partitioned(spark, root, FACT_SCHEMA)


def q_daily_revenue_incremental(spark, sf_dir):
    """Report kept by recomputing only the partitions each fact run touched."""
    base = scratch_path(spark, "report_incr")
    fact_root = layer_table(base, "marts", "fact_payments")
    report_root = layer_table(base, "marts", "rpt_daily_revenue")
    raw = _stored_raw(spark, sf_dir)
    ph, ch = _provider_history(spark, sf_dir), _client_history(spark, sf_dir)
    first = raw.where(F.col("loaded_at") < ts_lit(FACT_FIRST_LOAD_BEFORE))
    for source, run_ts in ((first, INGEST_RUNS[0]), (raw, INGEST_RUNS[1])):
        fact.refresh_fact_partitioned(spark, source, ph, ch, fact_root, version_id(run_ts),
                                      tiebreak=fx.TIEBREAK)
        fact.refresh_report_partitioned(spark, fact_root, report_root, version_id(run_ts))
    return fact.read_report_partitioned(spark, report_root)


def q_daily_revenue_after_missed_report(spark, sf_dir):
    """Three fact runs; the report step of the middle one never happened."""
    base = scratch_path(spark, "report_missed")
    fact_root = layer_table(base, "marts", "fact_payments")
    report_root = layer_table(base, "marts", "rpt_daily_revenue")
    raw = _stored_raw(spark, sf_dir)
    ph, ch = _provider_history(spark, sf_dir), _client_history(spark, sf_dir)
    runs = [FACT_FIRST_LOAD_BEFORE, "1999-06-01 00:00:00", INGEST_RUNS[1]]
    for run_ts in runs:
        source = raw if run_ts == runs[-1] else raw.where(F.col("loaded_at") < ts_lit(run_ts))
        fact.refresh_fact_partitioned(spark, source, ph, ch, fact_root, version_id(run_ts),
                                      tiebreak=fx.TIEBREAK)
        if run_ts != runs[1]:
            fact.refresh_report_partitioned(spark, fact_root, report_root, version_id(run_ts))
    return fact.read_report_partitioned(spark, report_root)


def _hot_payments(spark, sf_dir) -> DataFrame:
    """The raw log where every third row is a version of one payment (``l_orderkey`` breaks its ties)."""
    raw = fx.raw_payments(spark, sf_dir).withColumn("l_orderkey", F.col("transaction_id").cast("long"))
    return raw.withColumn("transaction_id", F.when(F.col("l_partkey") % 3 == 0, F.lit(HOT_PAYMENT))
                          .otherwise(F.col("transaction_id")))


def q_fact_incremental_hot_payment(spark, sf_dir):
    """Three runs over a raw log of three batches, kept by the winner table; one payment has a third of all rows."""
    from revmart.plans.winners import WinnerTable, refresh_fact_from_winners
    from revmart.schemas import FACT_SCHEMA
    from revmart.sinks.storage import append_batch
    base = scratch_path(spark, "fact_hot")
    raw_root, fact_root = layer_table(base, "raw", "payments"), layer_table(base, "marts", "fact_payments")
    raw = _hot_payments(spark, sf_dir)
    winners = WinnerTable(spark, layer_table(base, "staging", "winners"), raw.schema, [*fx.TIEBREAK, "l_orderkey"])
    ph, ch = _provider_history(spark, sf_dir), _client_history(spark, sf_dir)
    for run_ts in HOT_RUNS:
        append_batch(_landed(raw, "loaded_at", run_ts, HOT_RUNS), raw_root, version_id(run_ts))
        refresh_fact_from_winners(spark, raw_root, winners, ph, ch, fact_root, version_id(run_ts))
    return fact.read_fact_partitioned(spark, fact_root, FACT_SCHEMA)


def _ledger_after_runs(spark, sf_dir):
    from revmart.plans.ledger import PaymentLedger
    from revmart.sinks.storage import append_batch
    base = scratch_path(spark, "ledger")
    raw_root = layer_table(base, "raw", "payments")
    raw = _hot_payments(spark, sf_dir)
    ledger = PaymentLedger(spark, layer_table(base, "marts", "ledger"), raw.schema, [*fx.TIEBREAK, "l_orderkey"])
    ph, ch = _provider_history(spark, sf_dir), _client_history(spark, sf_dir)
    for run_ts in HOT_RUNS:
        append_batch(_landed(raw, "loaded_at", run_ts, HOT_RUNS), raw_root, version_id(run_ts))
        ledger.refresh(raw_root, ph, ch, version_id(run_ts))
    return ledger


def q_daily_revenue_retraction(spark, sf_dir):
    """The report after three runs of the ledger: replaced fact rows taken off the stored sums, new ones added."""
    return _ledger_after_runs(spark, sf_dir).read_report()


def q_fact_ledger(spark, sf_dir):
    """The fact kept by key in the same three runs."""
    return _ledger_after_runs(spark, sf_dir).read_fact()


def q_fact_upsert_null_partition(spark, sf_dir):
    """Payments stored by month, one client's without one (NULL partition); the confirmed are upserted."""
    from revmart.sinks.partitioned import overwrite_partitioned, read_partitioned, upsert_partitioned
    root = layer_table(scratch_path(spark, "null_part"), "marts", "payments_by_month")
    rows = _stg(spark, sf_dir).select(
        "transaction_id", "status", "client_id", "amount",
        F.when(F.col("client_id") != "CLIENT_7", F.date_format("transaction_date", "yyyy-MM")).alias("month"))
    overwrite_partitioned(spark, rows, root, "month", version_id(INGEST_RUNS[0]))
    delta = rows.where("status = 'confirmed'").withColumn(
        "amount", (F.col("amount") + 1).cast(rows.schema["amount"].dataType))
    upsert_partitioned(spark, root, rows.schema, delta, ["transaction_id"], "month", version_id(INGEST_RUNS[1]))
    return read_partitioned(spark, root, rows.schema, "month")


def q_warehouse_daily_revenue(spark, sf_dir):
    """Two whole warehouse runs: the OLTP and the rate tables as of each run time.

    Run 1 sees payments updated up to mid-1998 and the first rate snapshot;
    run 2 sees everything and the last snapshot. Fact rows keep the rates
    seen when they were loaded; the report is kept incrementally.
    """
    from revmart.plans.warehouse import Warehouse, read_warehouse_report, run_warehouse
    wh = Warehouse(scratch_path(spark, "warehouse"))
    source = fx.source_payments(spark, sf_dir).drop("fixture_loaded_at")
    for run_ts, snap in ((INGEST_RUNS[0], 0), (INGEST_RUNS[1], len(fx.SNAPSHOT_RUNS) - 1)):
        visible = _visible(source, "updated_at", run_ts, INGEST_RUNS)
        run_warehouse(spark, wh, visible, fx.provider_source(spark, sf_dir, snap),
                      fx.client_source(spark, sf_dir, snap), run_ts, tiebreak=fx.TIEBREAK)
    return read_warehouse_report(spark, wh)


def _visible(table, col, run_ts, runs):
    """The source as of a run: rows up to its time; the last run sees every row."""
    return table if run_ts == runs[-1] else table.where(F.col(col) <= ts_lit(run_ts))


def _landed(table, col, run_ts, runs):
    """What lands before a run and after the one before it; rows without a time land last."""
    upto = lambda ts: F.coalesce(F.col(col) <= ts_lit(ts), F.lit(False))
    at = runs.index(run_ts)
    rows = table.where(~upto(runs[at - 1])) if at else table
    return rows if run_ts == runs[-1] else rows.where(upto(run_ts))


# ---- extract-load ---------------------------------------------------------

def _two_ingest_runs(spark, sf_dir):
    base = scratch_path(spark, "ingest")
    raw_root, control_root = layer_table(base, "raw", "payments"), layer_table(base, "raw", "watermark")
    source = fx.source_payments(spark, sf_dir, with_tiebreak=False)
    loaded = []
    for run_ts in INGEST_RUNS:
        visible = _visible(source, "updated_at", run_ts, INGEST_RUNS)
        loaded.append(ingest.incremental_ingest(spark, visible, raw_root, control_root, run_ts,
                                                type_filter=ingest.payments_type_filter()))
    return raw_root, control_root, loaded


def q_incremental_extract(spark, sf_dir):
    raw_root, _, _ = _two_ingest_runs(spark, sf_dir)
    return read_batches(spark, raw_root, RAW_PAYMENTS)


def q_ingest_row_counts(spark, sf_dir):
    """What each run says of itself: rows loaded (counted while they are written), the mark before and after."""
    _, _, loaded = _two_ingest_runs(spark, sf_dir)
    rows = [(i, r.rows, r.previous_mark, r.new_mark) for i, r in enumerate(loaded, 1)]
    return spark.createDataFrame(rows, "run int, rows_loaded long, previous_mark timestamp_ntz, new_mark timestamp_ntz")


def q_incremental_extract_lookback(spark, sf_dir):
    """Two ingest runs; the second looks back 90 days and loads the pending rows that the first did not see."""
    base = scratch_path(spark, "ingest_lookback")
    raw_root, control_root = layer_table(base, "raw", "payments"), layer_table(base, "raw", "watermark")
    source = fx.source_payments(spark, sf_dir, with_tiebreak=False)
    late = (F.col("status") == "pending") & (F.col("updated_at") > ts_lit(LATE_AFTER))
    for run_ts in INGEST_RUNS:
        visible = _visible(source, "updated_at", run_ts, INGEST_RUNS)
        ingest.incremental_ingest(spark, visible.where(~late) if run_ts == INGEST_RUNS[0] else visible, raw_root,
                                  control_root, run_ts, type_filter=ingest.payments_type_filter(),
                                  lookback=dt.timedelta(days=90))
    return read_batches(spark, raw_root, RAW_PAYMENTS)


def q_next_watermark(spark, sf_dir):
    _, control_root, _ = _two_ingest_runs(spark, sf_dir)
    return read_current(spark, control_root, WATERMARK)


def _events_raw_schema(events: DataFrame) -> T.StructType:
    return T.StructType(events.schema.fields + [T.StructField("loaded_at", T.TimestampNTZType())])


def q_events_incremental_extract(spark, sf_dir):
    """The same ingest job on the events table (mark on ts)."""
    base = scratch_path(spark, "events_ingest")
    raw_root, control_root = layer_table(base, "raw", "events"), layer_table(base, "raw", "watermark")
    events = read_table(spark, sf_dir, "events")
    schema = _events_raw_schema(events)
    for run_ts in EVENT_INGEST_RUNS:
        visible = _visible(events, "ts", run_ts, EVENT_INGEST_RUNS)
        ingest.incremental_ingest(spark, visible, raw_root, control_root, run_ts,
                                  table_name="events", mark_col="ts", columns=events.columns,
                                  key_col="event_id", raw_schema=schema)
    return read_batches(spark, raw_root, schema)


def _two_dimension_loads(spark, sf_dir, kind):
    root = layer_table(scratch_path(spark, f"dim_{kind}"), "raw", kind)
    for run in (0, 2):
        run_ts = fx.SNAPSHOT_RUNS[run]
        if kind == "providers":
            ingest.refresh_providers(fx.provider_source(spark, sf_dir, run), root, run_ts)
        else:
            ingest.refresh_clients(fx.client_source(spark, sf_dir, run), root, run_ts)
    return read_current(spark, root, RAW_PROVIDERS if kind == "providers" else RAW_CLIENTS)


def q_dimension_extract_providers(spark, sf_dir):
    return _two_dimension_loads(spark, sf_dir, "providers")


def q_dimension_extract_clients(spark, sf_dir):
    return _two_dimension_loads(spark, sf_dir, "clients")


def q_stream_ingest(spark, sf_dir):
    """Two ``availableNow`` runs of the streaming ingest; returns the fact table."""
    from revmart.streaming.ingest import run_stream
    base = scratch_path(spark, "stream")
    landing = f"{base}/landing"
    raw_root = layer_table(base, "raw", "payments")
    fact_root = layer_table(base, "marts", "fact_payments")
    source = fx.source_payments(spark, sf_dir).drop("fixture_loaded_at")
    ph, ch = _provider_history(spark, sf_dir), _client_history(spark, sf_dir)
    for run_ts in INGEST_RUNS:
        # Changes land as files; the stream picks up only unseen files.
        _landed(source, "updated_at", run_ts, INGEST_RUNS).write.mode("append").parquet(landing)
        run_stream(spark, landing, source.schema, raw_root, fact_root, f"{base}/_checkpoint",
                   run_ts, ph, ch, tiebreak=fx.TIEBREAK)
    from revmart.schemas import FACT_SCHEMA
    return fact.read_fact_partitioned(spark, fact_root, FACT_SCHEMA)


# ---- events: the operators on a second table ------------------------------

def q_latest_event_per_user(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return latest_version(events, ["user_id"], [SortKey("ts"), SortKey("event_id")])


def q_stream_latest_event_per_user(spark, sf_dir):
    """Events land in two chunks; two ``availableNow`` runs keep the latest event per user."""
    from revmart.streaming.latest import read_latest, run_latest_stream
    base = scratch_path(spark, "events_stream")
    landing, table_root = f"{base}/landing", layer_table(base, "marts", "latest_event")
    events = read_table(spark, sf_dir, "events")
    for run_ts in EVENT_INGEST_RUNS:
        _landed(events, "ts", run_ts, EVENT_INGEST_RUNS).write.mode("append").parquet(landing)
        run_latest_stream(spark, landing, events.schema, ["user_id"],
                          [SortKey("ts"), SortKey("event_id")], table_root, f"{base}/_checkpoint")
    return read_latest(spark, table_root, events.schema, ["user_id"])


# ---- OLTP-side writes -----------------------------------------------------

def q_insert_if_absent(spark, sf_dir):
    """The payments table holds orders before 1998; every source payment is then
    inserted if its id is new (the first version of each id wins)."""
    from revmart.plans import oltp
    root = layer_table(scratch_path(spark, "oltp"), "source", "payments")
    existing = (_oltp_payments(spark, sf_dir)
                .where(F.col("created_at") < ts_lit(INSERT_EXISTING_BEFORE)))
    oltp.write_payments(spark, root, existing, version_id(INSERT_EXISTING_BEFORE))
    first_version = [SortKey("updated_at", descending=False),
                     SortKey("fixture_loaded_at", descending=False),
                     SortKey("l_suppkey", descending=False), SortKey("l_partkey", descending=False)]
    oltp.insert_new_payments(spark, root, fx.source_payments(spark, sf_dir), first_version,
                             TOPK_RUN_TS)
    return oltp.read_payments(spark, root)


def q_insert_few_if_absent(spark, sf_dir):
    """The table holds the orders before July 1998; what came from June 1998 on, and March 1996 again, is inserted.

    The bitmaps of the months' keys say which months are read to find those that are there.
    """
    from revmart.plans import oltp
    root = layer_table(scratch_path(spark, "oltp"), "source", "payments")
    table = _oltp_payments(spark, sf_dir)
    oltp.write_payments(spark, root, table.where(F.col("created_at") < ts_lit("1998-07-01 00:00:00")),
                        version_id(INSERT_EXISTING_BEFORE))
    again = (F.col("created_at") >= ts_lit("1996-03-01 00:00:00")) & (F.col("created_at") < ts_lit("1996-04-01 00:00:00"))
    incoming = table.where((F.col("created_at") >= ts_lit("1998-06-01 00:00:00")) | again).withColumn(
        "amount", (F.col("amount") + 1).cast("decimal(12,2)"))  # what is kept shows
    oltp.insert_new_payments(spark, root, incoming, [SortKey("updated_at", descending=False)], TOPK_RUN_TS)
    return oltp.read_payments(spark, root)


def _pending_newest():
    return (F.col("status") == F.lit("pending"),
            [SortKey("created_at"), SortKey("transaction_id")])


def q_topk_update(spark, sf_dir):
    """The newest pending payments confirmed; only their months are written."""
    from revmart.plans import oltp
    root = layer_table(scratch_path(spark, "oltp"), "source", "payments")
    oltp.write_payments(spark, root, _oltp_payments(spark, sf_dir), version_id(INSERT_EXISTING_BEFORE))
    oltp.confirm_newest_pending(spark, root, TOPK_N, TOPK_RUN_TS)
    return oltp.read_payments(spark, root)


def q_topk_update_many(spark, sf_dir):
    """So many that they lie in a dozen months."""
    from revmart.plans import oltp
    root = layer_table(scratch_path(spark, "oltp"), "source", "payments")
    oltp.write_payments(spark, root, _oltp_payments(spark, sf_dir), version_id(INSERT_EXISTING_BEFORE))
    oltp.confirm_newest_pending(spark, root, TOPK_MANY, TOPK_RUN_TS)
    return oltp.read_payments(spark, root)


def q_semi_join_topk(spark, sf_dir):
    where, order = _pending_newest()
    table = _oltp_payments(spark, sf_dir)
    return semi_join(table, top_k_keys(table, ["transaction_id"], where, order, TOPK_N),
                     ["transaction_id"])


# ---- data quality ---------------------------------------------------------

def _dq_tables(spark, sf_dir) -> dict[str, DataFrame]:
    # Checks run on a built model: the enrichment is written as a table version
    # and the fact and report derive from it.
    built = _enriched(spark, sf_dir)
    root = layer_table(scratch_path(spark, "dq"), "marts", "payments_enriched")
    write_version(built, root, version_id(INGEST_RUNS[1]))
    enriched = read_current(spark, root, built.schema)
    fact_df = marts.fact_rows(enriched)
    last = len(fx.SNAPSHOT_RUNS) - 1
    return {
        "source_payments": fx.source_payments(spark, sf_dir),
        "raw_payments": fx.raw_payments(spark, sf_dir),
        "stg_payments": _stg(spark, sf_dir),
        "payments_enriched": enriched,
        "fact_payments": fact_df,
        "daily_revenue": marts.daily_revenue(fact_df),
        "raw_providers": fx.provider_source(spark, sf_dir, last),
        "raw_clients": fx.client_source(spark, sf_dir, last),
    }


def q_dq_unique(spark, sf_dir):
    return checks.unique_suite(_dq_tables(spark, sf_dir))


def q_dq_not_null(spark, sf_dir):
    return checks.not_null_suite(_dq_tables(spark, sf_dir))


def q_dq_accepted_values(spark, sf_dir):
    return checks.accepted_values_suite(_dq_tables(spark, sf_dir))


def q_dq_max_length(spark, sf_dir):
    return checks.length_suite(fx.raw_payments(spark, sf_dir))


def q_dq_scd2_overlap(spark, sf_dir):
    return checks.scd2_suite(_provider_history(spark, sf_dir, replay=True),
                             _client_history(spark, sf_dir, replay=True))


def q_dq_confirmation_rate_range(spark, sf_dir):
    return checks.report_range_suite(marts.daily_revenue(marts.fact_rows(_enriched(spark, sf_dir))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "incremental_extract": q_incremental_extract,
    "incremental_extract_lookback": q_incremental_extract_lookback,
    "ingest_row_counts": q_ingest_row_counts,
    "next_watermark": q_next_watermark,
    "events_incremental_extract": q_events_incremental_extract,
    "stream_ingest": q_stream_ingest,
    "dimension_extract_providers": q_dimension_extract_providers,
    "dimension_extract_clients": q_dimension_extract_clients,
    "latest_payments": q_latest_payments,
    "latest_event_per_user": q_latest_event_per_user,
    "stream_latest_event_per_user": q_stream_latest_event_per_user,
    "scd2_providers": q_scd2_providers,
    "scd2_clients": q_scd2_clients,
    "dim_providers_current": q_dim_providers_current,
    "dim_clients_current": q_dim_clients_current,
    "interval_lookup_providers": q_interval_lookup_providers,
    "interval_lookup_clients": q_interval_lookup_clients,
    "payments_enriched": q_payments_enriched,
    "scd2_large": q_scd2_large,
    "interval_lookup_large": q_interval_lookup_large,
    "payments_enriched_large": q_payments_enriched_large,
    "fact_full": q_fact_full,
    "fact_incremental_upsert": q_fact_incremental_upsert,
    "fact_incremental_partitioned": q_fact_incremental_partitioned,
    "daily_revenue": q_daily_revenue,
    "daily_revenue_incremental": q_daily_revenue_incremental,
    "daily_revenue_after_missed_report": q_daily_revenue_after_missed_report,
    "fact_incremental_hot_payment": q_fact_incremental_hot_payment,
    "fact_ledger": q_fact_ledger,
    "daily_revenue_retraction": q_daily_revenue_retraction,
    "fact_upsert_null_partition": q_fact_upsert_null_partition,
    "warehouse_daily_revenue": q_warehouse_daily_revenue,
    "insert_if_absent": q_insert_if_absent,
    "insert_few_if_absent": q_insert_few_if_absent,
    "topk_update": q_topk_update,
    "topk_update_many": q_topk_update_many,
    "semi_join_topk": q_semi_join_topk,
    "dq_unique": q_dq_unique,
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_max_length": q_dq_max_length,
    "dq_scd2_overlap": q_dq_scd2_overlap,
    "dq_confirmation_rate_range": q_dq_confirmation_rate_range,
}
