"""The incremental fact table: keyed upsert of re-enriched changed payments.

Incremental run: take the winners (latest versions) whose ``loaded_at`` is
newer than the greatest ``loaded_at`` already in the fact, re-enrich them
with the current history, and replace their keys (delete+insert). Rows are
frozen with the rates seen when they were loaded; ``full_refresh`` rebuilds
everything from raw.

Changed-key pruning: a winner newer than the mark is itself a raw row newer
than the mark, so raw is first semi-joined to the keys having such a row;
only those keys go through the dedup window. Same result, far less work
when the delta is small.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from revmart.functions.columns import ts_lit
from revmart.operators.upsert import keyed_upsert
from revmart.plans.enrich import enrich_payments
from revmart.plans.marts import daily_revenue, fact_rows
from revmart.plans.staging import stg_payments
from revmart.schemas import EPOCH, FACT_COLUMNS, FACT_SCHEMA, REPORT_COLUMNS, REPORT_SCHEMA
from revmart.sinks.partitioned import (current_partitions, overwrite_partitioned,
                                       partition_versions, read_partitioned, upsert_partitioned,
                                       write_partitions)
from revmart.sinks.storage import current_version, read_current, write_version

KEY = ["transaction_id"]


def max_loaded_at(fact: DataFrame) -> dt.datetime:
    """``coalesce(max(loaded_at), epoch)`` of the fact: one scalar to the driver."""
    value = fact.agg(F.max("loaded_at").alias("m")).first()["m"]
    return value if value is not None else dt.datetime.fromisoformat(EPOCH)


def changed_rows(raw: DataFrame, mark: dt.datetime) -> DataFrame:
    """All raw rows of the payments that have a row loaded after ``mark``."""
    changed = raw.where(F.col("loaded_at") > ts_lit(mark)).select("transaction_id").distinct()
    return raw.join(changed, on="transaction_id", how="left_semi")


def fact_delta(raw: DataFrame, provider_history: DataFrame, client_history: DataFrame,
               mark: dt.datetime, tiebreak: list[str] | None = None, prune: bool = True) -> DataFrame:
    """Winners loaded after ``mark``, enriched, in fact layout."""
    source = changed_rows(raw, mark) if prune else raw
    stg = stg_payments(source, tiebreak=tiebreak).where(F.col("loaded_at") > ts_lit(mark))
    return fact_rows(enrich_payments(stg, provider_history, client_history))


def refresh_fact(spark: SparkSession, raw: DataFrame, provider_history: DataFrame,
                 client_history: DataFrame, fact_root: str, version: str,
                 full_refresh: bool = False, tiebreak: list[str] | None = None,
                 prune: bool = True) -> str:
    """Write the next version of the fact table; returns its path."""
    if full_refresh or current_version(spark, fact_root, before=version) is None:
        stg = stg_payments(raw, tiebreak=tiebreak)
        new = fact_rows(enrich_payments(stg, provider_history, client_history))
    else:
        existing = read_current(spark, fact_root, FACT_SCHEMA, before=version)
        mark = max_loaded_at(existing)
        delta = fact_delta(raw, provider_history, client_history, mark, tiebreak, prune)
        new = keyed_upsert(existing, delta, KEY)
    return write_version(new.select(*FACT_COLUMNS), fact_root, version)


def read_fact(spark: SparkSession, fact_root: str) -> DataFrame:
    return read_current(spark, fact_root, FACT_SCHEMA).select(*FACT_COLUMNS)


# ---- partitioned layout: rewrite only the touched date partitions ----------

PART_COL = "fact_partition"
# Partition grain of the stored fact: "day" at TB scale (a day holds tens of
# GB there), "month" for the small test scales.
GRAIN_FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def _with_partition(rows: DataFrame, grain: str) -> DataFrame:
    return rows.withColumn(PART_COL, F.date_format("transaction_date", GRAIN_FORMATS[grain]))


def _mark_root(fact_root: str) -> str:
    return f"{fact_root.rstrip('/')}/_mark"


def read_fact_mark(spark: SparkSession, fact_root: str, before: str | None = None) -> dt.datetime:
    """The fact's ``max(loaded_at)``, kept beside it so no run scans the fact for it."""
    marks = read_current(spark, _mark_root(fact_root), "max_loaded_at timestamp_ntz", before)
    row = marks.agg(F.max("max_loaded_at").alias("m")).first()
    return row["m"] if row and row["m"] is not None else dt.datetime.fromisoformat(EPOCH)


def _save_mark(spark: SparkSession, fact_root: str, mark: dt.datetime, version: str) -> None:
    df = spark.range(1).select(ts_lit(mark).alias("max_loaded_at"))
    write_version(df, _mark_root(fact_root), version)


def refresh_fact_partitioned(spark: SparkSession, raw: DataFrame, provider_history: DataFrame,
                             client_history: DataFrame, fact_root: str, version: str,
                             full_refresh: bool = False, tiebreak: list[str] | None = None,
                             prune: bool = True,
                             files_per_partition: int = 1, grain: str = "month") -> set[str] | None:
    """Fact refresh that rewrites only the date partitions a run touches.

    The mark is saved after the data commit; a crash in between re-runs the
    same delta next time, which the keyed upsert absorbs.
    """
    obs = Observation(f"fact_{version}")
    first = not current_partitions(spark, fact_root, PART_COL, before=version)
    if full_refresh or first:
        stg = stg_payments(raw, tiebreak=tiebreak)
        rows = fact_rows(enrich_payments(stg, provider_history, client_history))
        rows = _with_partition(rows, grain).observe(obs, F.max("loaded_at").alias("m"))
        overwrite_partitioned(spark, rows, fact_root, PART_COL, version, files_per_partition,
                              KEY)
        touched = None
        mark = obs.get.get("m")
    else:
        prev = read_fact_mark(spark, fact_root, before=version)
        delta = fact_delta(raw, provider_history, client_history, prev, tiebreak, prune)
        delta = _with_partition(delta, grain).observe(obs, F.max("loaded_at").alias("m"))
        # A stored row came from some raw row of its payment: the dates of all of
        # them hold every partition the changed keys can live in.
        homes = changed_rows(raw, prev).select(
            F.date_format("created_at", GRAIN_FORMATS[grain]).alias(PART_COL))
        touched = upsert_partitioned(spark, fact_root, delta.schema, delta, KEY, PART_COL, version,
                                     files_per_partition, homes=homes)
        observed = obs.get.get("m") if touched else None
        mark = max(prev, observed) if observed is not None else prev
    _save_mark(spark, fact_root, mark or dt.datetime.fromisoformat(EPOCH), version)
    return touched


def _stored(schema: StructType, part_col: str) -> StructType:
    """``schema`` plus the storage partition column (a new StructType; never ``.add``)."""
    return StructType(list(schema.fields) + [StructField(part_col, StringType())])


def read_fact_partitioned(spark: SparkSession, fact_root: str,
                          schema: StructType = FACT_SCHEMA) -> DataFrame:
    return read_partitioned(spark, fact_root, _stored(schema, PART_COL), PART_COL) \
        .select(*FACT_COLUMNS)


# ---- report partitions follow the fact partitions ---------------------------

REPORT_PART_COL = "report_partition"


def refresh_report_partitioned(spark: SparkSession, fact_root: str, report_root: str,
                               version: str, grain: str = "month", full: bool = False) -> set[str]:
    """Recompute the daily report for the fact partitions that changed since it was built.

    A report row depends on the fact rows of its own date only, and a fact
    partition holds whole dates, so rebuilding the changed partitions gives
    exactly the full rebuild. What changed is read from the two tables: the
    fact partitions whose committed revision is newer than the report's. So a
    run whose report step was missed is made up for by the next one.
    """
    built = partition_versions(spark, report_root, REPORT_PART_COL)
    stored = partition_versions(spark, fact_root, PART_COL)
    touched = {value for value, rev in stored.items() if full or rev > built.get(value, "")}
    if not touched:
        return touched
    fact = read_partitioned(spark, fact_root, _stored(FACT_SCHEMA, PART_COL), PART_COL, only=touched)
    report = daily_revenue(fact).withColumn(
        REPORT_PART_COL, F.date_format("report_date", GRAIN_FORMATS[grain]))
    write_partitions(spark, report, report_root, REPORT_PART_COL, version, touched)
    return touched


def read_report_partitioned(spark: SparkSession, report_root: str) -> DataFrame:
    return read_partitioned(spark, report_root, _stored(REPORT_SCHEMA, REPORT_PART_COL),
                            REPORT_PART_COL).select(*REPORT_COLUMNS)
