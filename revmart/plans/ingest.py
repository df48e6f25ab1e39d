"""Extract-load jobs: incremental payments by a high-water mark, full-refresh dimensions.

The mark is the greatest ``updated_at`` loaded so far, kept in a control
table (one row per source). A run extracts ``type = recarga`` rows with
``updated_at > mark`` (strict: a row updated at or before the mark but seen
only now is missed unless ``lookback`` widens the window), stamps them
with the run's ``loaded_at``, appends them, and only then saves the new
mark, and only if rows were loaded. A crash between the append and the
mark re-extracts the same rows next time (at-least-once); the dedup in
staging absorbs the copies.

A batch is range-partitioned and sorted by the mark column, so each file and
row group of the raw log holds a narrow range of it. A lookback then reads of
the raw log what its window can touch, by the ranges in the Parquet footers.
Spark pushes no comparison of ``timestamp_ntz`` into a Parquet scan; the files
hold the mark's day beside it (a date, which is pushed), not part of the schema.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from revmart.functions.columns import ts_lit
from revmart.schemas import (EPOCH, INGESTED_TYPE, RAW_CLIENTS, RAW_PAYMENTS, RAW_PROVIDERS,
                             SOURCE_PAYMENTS, WATERMARK)
from revmart.sinks.storage import append_batch, read_batches, read_current, version_id, write_version

MARK_DAY = "__mark_day"
PAYMENTS_SOURCE_NAME = "process_payments"


@dataclass
class IngestResult:
    rows: int
    previous_mark: dt.datetime
    new_mark: dt.datetime


def read_watermark(spark: SparkSession, control_root: str, table_name: str,
                   before: str | None = None) -> dt.datetime:
    """Mark of ``table_name``; the epoch when the source was never loaded."""
    marks = read_current(spark, control_root, WATERMARK, before)
    row = marks.where(F.col("table_name") == table_name).agg(
        F.max("last_loaded_at").alias("m")).first()
    if row is None or row["m"] is None:
        return dt.datetime.fromisoformat(EPOCH)
    return row["m"]


def save_watermark(spark: SparkSession, control_root: str, table_name: str, mark: dt.datetime,
                   version: str) -> None:
    """Insert or replace the source's row: a new version of the control table."""
    marks = read_current(spark, control_root, WATERMARK, before=version)
    new_row = spark.range(1).select(F.lit(table_name).alias("table_name"),
                                    ts_lit(mark).alias("last_loaded_at"))
    kept = marks.where(F.col("table_name") != table_name)
    write_version(kept.unionByName(new_row.select(*WATERMARK.fieldNames())).coalesce(1),
                  control_root, version)


def incremental_ingest(spark: SparkSession, source: DataFrame, raw_root: str, control_root: str,
                       run_ts: str, table_name: str = PAYMENTS_SOURCE_NAME,
                       mark_col: str = "updated_at", type_filter: Column | None = None,
                       columns: list[str] | None = None, key_col: str = "transaction_id",
                       lookback: dt.timedelta | None = None,
                       raw_schema=RAW_PAYMENTS) -> IngestResult:
    """One run of the extract-load job (append to raw, then advance the mark)."""
    columns = columns or SOURCE_PAYMENTS.fieldNames()
    # the mark as it was before this run (a re-run of the run sees the same)
    mark = read_watermark(spark, control_root, table_name, before=version_id(run_ts))
    lower = mark - lookback if lookback else mark
    extracted = source
    if type_filter is not None:
        extracted = extracted.where(type_filter)
    extracted = extracted.where(F.col(mark_col) > ts_lit(lower)).select(*columns)
    if lookback:
        # Rows re-read by the widened window that raw already holds are not
        # loaded again (a reload would win the dedup with a newer loaded_at).
        # only raw rows inside the widened window can collide (filter pushed to the scan)
        seen = read_window(spark, raw_root, raw_schema, mark_col, lower, version_id(run_ts)).select(key_col, mark_col)
        extracted = extracted.join(seen, on=[key_col, mark_col], how="left_anti")
    stamped = extracted.withColumn("loaded_at", ts_lit(run_ts))
    obs = Observation(f"ingest_{version_id(run_ts)}")
    ordered = (stamped.select(*raw_schema.fieldNames(), F.to_date(mark_col).alias(MARK_DAY))
               .repartitionByRange(mark_col).sortWithinPartitions(mark_col))
    # observed behind the exchange: the sampling of the ranges counts nothing
    ordered = ordered.observe(obs, F.count(F.lit(1)).alias("rows"),
                              F.max(mark_col).alias("max_mark"))
    append_batch(ordered, raw_root, version_id(run_ts))
    metrics = obs.get
    rows = int(metrics.get("rows") or 0)
    new_mark = mark
    if rows > 0 and metrics.get("max_mark") is not None and metrics["max_mark"] > mark:
        new_mark = metrics["max_mark"]
    if rows > 0:
        save_watermark(spark, control_root, table_name, new_mark, version_id(run_ts))
    return IngestResult(rows=rows, previous_mark=mark, new_mark=new_mark)


def read_window(spark: SparkSession, raw_root: str, raw_schema, mark_col: str, lower: dt.datetime,
                exclude: str | None = None) -> DataFrame:
    """The raw rows with a mark after ``lower``, by row groups that can hold some (files without the day: all)."""
    schema = StructType([*raw_schema.fields, StructField(MARK_DAY, DateType())])
    day = F.col(MARK_DAY)
    rows = read_batches(spark, raw_root, schema, exclude=exclude)
    return rows.where((day.isNull() | (day >= F.lit(lower.date()))) & (F.col(mark_col) > ts_lit(lower))).drop(MARK_DAY)


def payments_type_filter() -> Column:
    return F.col("type") == F.lit(INGESTED_TYPE)


def refresh_dimension(source: DataFrame, root: str, run_ts: str, commission_type: str,
                      schema) -> str:
    """Full refresh: the filtered source, stamped, as a new version (empty source -> empty table)."""
    out = (source.where(F.col("commission_type") == commission_type)
           .withColumn("loaded_at", ts_lit(run_ts)).select(*schema.fieldNames()))
    return write_version(out, root, version_id(run_ts))


def refresh_providers(source: DataFrame, root: str, run_ts: str) -> str:
    return refresh_dimension(source, root, run_ts, "amount", RAW_PROVIDERS)


def refresh_clients(source: DataFrame, root: str, run_ts: str) -> str:
    return refresh_dimension(source, root, run_ts, "revenue_share", RAW_CLIENTS)
