"""One run of the whole warehouse, in dependency order.

1. extract-load: rate dimensions (full refresh) and payments (incremental);
2. snapshots: SCD2 step of both dimensions; closed rows are appended, of the open ones
   those that moved are written;
3. models: fact (incremental upsert, or full refresh), daily report and
   current dimensions (rebuilt), each committed as a new version.

Every table lives under ``root`` in its layer; every write is a committed
version or an idempotent batch folder (see ``revmart.sinks``), so a run
that dies anywhere can simply be run again with the same ``run_ts``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from revmart.plans import ingest, marts
from revmart.plans.fact import (read_fact, read_fact_partitioned, read_report_partitioned,
                                refresh_fact, refresh_report_partitioned)
from revmart.plans.snapshots import HistoryTable
from revmart.plans.staging import client_snapshot_input, provider_snapshot_input
from revmart.plans.winners import WinnerTable, merged_up_to, refresh_fact_from_winners
from revmart.schemas import FACT_SCHEMA, RAW_CLIENTS, RAW_PAYMENTS, RAW_PROVIDERS
from revmart.sinks.storage import (read_batches, read_current, read_version, version_id,
                                   write_version)
from revmart.sources.tables import layer_table


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, layer: str, name: str) -> str:
        return layer_table(self.root, layer, name)

    raw_payments = property(lambda self: self.path("raw", "payments"))
    raw_providers = property(lambda self: self.path("raw", "providers"))
    raw_clients = property(lambda self: self.path("raw", "clients"))
    watermarks = property(lambda self: self.path("raw", "watermark"))
    histories = property(lambda self: {"providers": self.provider_history, "clients": self.client_history})
    winners = property(lambda self: self.path("staging", "winners"))
    provider_history = property(lambda self: self.path("snapshots", "providers"))
    client_history = property(lambda self: self.path("snapshots", "clients"))
    fact = property(lambda self: self.path("marts", "fact_payments"))
    report = property(lambda self: self.path("marts", "rpt_daily_revenue"))
    dim_providers = property(lambda self: self.path("marts", "dim_providers"))
    dim_clients = property(lambda self: self.path("marts", "dim_clients"))


@dataclass
class RunSummary:
    payments_loaded: int
    watermark: dt.datetime
    fact_version: str


def load_dimensions(spark: SparkSession, wh: Warehouse, provider_source: DataFrame,
                    client_source: DataFrame, run_ts: str) -> None:
    ingest.refresh_providers(provider_source, wh.raw_providers, run_ts)
    ingest.refresh_clients(client_source, wh.raw_clients, run_ts)


def run_warehouse(spark: SparkSession, wh: Warehouse, payment_source: DataFrame,
                 provider_source: DataFrame, client_source: DataFrame, run_ts: str,
                 full_refresh: bool = False, lookback: dt.timedelta | None = None,
                 fact_layout: str = "partitioned", grain: str = "month",
                 retain_versions: int | None = None,
                 tiebreak: list[str] | None = None) -> RunSummary:
    """``fact_layout``: "partitioned" merges the new raw batches into the winner table and
    rewrites only touched date partitions (use ``grain="day"`` at TB scale); "versioned"
    reads the whole raw log and rewrites the whole fact each run.
    ``tiebreak``: extra source columns carried into raw and used as the last
    dedup keys (when the source can hold equal versions of one payment)."""
    raw_schema = RAW_PAYMENTS
    if tiebreak:
        raw_schema = StructType(list(RAW_PAYMENTS.fields) + [
            payment_source.schema[c] for c in tiebreak])
    version = version_id(run_ts)
    load_dimensions(spark, wh, provider_source, client_source, run_ts)
    loaded = ingest.incremental_ingest(spark, payment_source, wh.raw_payments, wh.watermarks,
                                       run_ts, type_filter=ingest.payments_type_filter(),
                                       columns=[c for c in raw_schema.fieldNames()
                                                if c != "loaded_at"],
                                       lookback=lookback, raw_schema=raw_schema)

    histories = {kind: HistoryTable(spark, root, kind) for kind, root in wh.histories.items()}
    histories["providers"].step(
        provider_snapshot_input(read_version(spark, wh.raw_providers, version, RAW_PROVIDERS)), run_ts)
    histories["clients"].step(
        client_snapshot_input(read_version(spark, wh.raw_clients, version, RAW_CLIENTS)), run_ts)
    # everything as of this run, also when an older run is run again after a newer one
    ph, ch = histories["providers"].read(upto=version), histories["clients"].read(upto=version)
    winners = WinnerTable(spark, wh.winners, raw_schema, tiebreak)
    if fact_layout == "partitioned":
        refresh_fact_from_winners(spark, wh.raw_payments, winners, ph, ch, wh.fact, version,
                                  full_refresh=full_refresh, grain=grain)
        # only the report partitions of changed fact partitions
        refresh_report_partitioned(spark, wh.fact, wh.report, version, grain, full=full_refresh)
    else:
        raw = read_batches(spark, wh.raw_payments, raw_schema, upto=version)
        refresh_fact(spark, raw, ph, ch, wh.fact, version, full_refresh=full_refresh,
                     tiebreak=tiebreak)
        write_version(marts.daily_revenue(read_fact(spark, wh.fact)), wh.report, version)
    write_version(marts.dim_providers(ph), wh.dim_providers, version)
    write_version(marts.dim_clients(ch), wh.dim_clients, version)
    if retain_versions:
        prune_old(spark, wh, retain_versions)
        if merged := merged_up_to(spark, winners, wh.fact, before=version):
            winners.table.prune(keep=merged)  # a re-run of this run still finds its state
        for history in histories.values():
            if done := history.complete(before=version):
                history.open.prune(keep=done)
    return RunSummary(loaded.rows, loaded.new_mark, version)


def prune_old(spark: SparkSession, wh: Warehouse, keep: int) -> None:
    """Retention: old table versions and superseded partition revisions."""
    from revmart.sinks.partitioned import prune_revisions
    from revmart.sinks.storage import prune_versions
    from revmart.plans.fact import PART_COL, REPORT_PART_COL
    for root in (wh.raw_providers, wh.raw_clients, wh.watermarks, wh.dim_providers, wh.dim_clients,
                 f"{wh.fact}/_mark"):
        prune_versions(spark, root, keep)
    prune_revisions(spark, wh.fact, PART_COL)
    prune_revisions(spark, wh.report, REPORT_PART_COL)


def check_warehouse(spark: SparkSession, wh: Warehouse,
                    raw_schema: StructType = RAW_PAYMENTS) -> DataFrame:
    """The quality suite on the tables as they are stored."""
    from revmart.operators.quality import union_all
    from revmart.plans import checks
    raw = read_batches(spark, wh.raw_payments, raw_schema)
    report = read_report_partitioned(spark, wh.report)
    tables = {
        "raw_payments": raw, "fact_payments": read_fact_partitioned(spark, wh.fact, FACT_SCHEMA),
        "daily_revenue": report,
        "raw_providers": read_current(spark, wh.raw_providers, RAW_PROVIDERS),
        "raw_clients": read_current(spark, wh.raw_clients, RAW_CLIENTS)}
    return union_all([
        checks.not_null_suite(tables), checks.accepted_values_suite(tables), checks.unique_suite(tables),
        checks.length_suite(raw), checks.report_range_suite(report),
        checks.scd2_suite(*[HistoryTable(spark, root, kind).read() for kind, root in wh.histories.items()])])


def read_warehouse_fact(spark: SparkSession, wh: Warehouse, fact_layout: str = "partitioned"):
    if fact_layout == "partitioned":
        return read_fact_partitioned(spark, wh.fact, FACT_SCHEMA)
    return read_fact(spark, wh.fact)


def read_warehouse_report(spark: SparkSession, wh: Warehouse, fact_layout: str = "partitioned"):
    if fact_layout == "partitioned":
        return read_report_partitioned(spark, wh.report)
    from revmart.plans.marts import daily_revenue
    return read_current(spark, wh.report, daily_revenue(read_fact(spark, wh.fact)).schema)
