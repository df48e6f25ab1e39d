"""Writes to the source payments table: insert-if-absent and the top-k status update.

The table is keyed by ``transaction_id`` and stored by the month of
``created_at`` (NULL has a partition of its own), in committed partition
revisions (``sinks/partitioned.py``). An operation writes a new revision of
the months that hold its rows; the files of the others stay. A crashed
operation leaves the table unchanged, and a re-run with the same version id
writes the same revisions.

Beside it lie bitmaps of each month's hashed keys (``operators/keyfilter.py``),
in a keyed table under the same versions. They say which months an incoming
key can be in, and only those are read to find it. A version's bitmaps are
written before its rows, so they always cover what is stored.

The newest payments are found from the newest month backwards: a month is
read only if the newer ones did not hold enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from revmart.functions.columns import ts_lit
from revmart.operators.dedup import SortKey, latest_version
from revmart.operators.keyfilter import FILTER_KEYS, FILTER_SCHEMA, add_keys, build_filters, possible_parts
from revmart.schemas import SOURCE_PAYMENTS
from revmart.sinks.keyed import KeyedTable
from revmart.sinks.partitioned import (NULL_FOLDER, current_partitions, overwrite_partitioned, read_partitioned,
                                       upsert_partitioned)
from revmart.sinks.storage import version_id

KEY = ["transaction_id"]
# newest first, id as the tie-break that makes the top-k deterministic
NEWEST = [SortKey("created_at"), SortKey("transaction_id")]


PART_COL = "created_month"
STORED = StructType([*SOURCE_PAYMENTS.fields, StructField(PART_COL, StringType())])


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn(PART_COL, F.date_format("created_at", "yyyy-MM"))


def _with_folder(rows: DataFrame) -> DataFrame:
    """The keys, and the month as it stands in a folder name."""
    return rows.select(*KEY, F.coalesce(F.date_format("created_at", "yyyy-MM"), F.lit(NULL_FOLDER)).alias("folder"))


def _filters(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, f"{root.rstrip('/')}/_keys", StructType.fromDDL(FILTER_SCHEMA), FILTER_KEYS,
                      rows_per_bucket=20_000)


def write_payments(spark: SparkSession, root: str, rows: DataFrame, version: str) -> None:
    """Full load of the table and of its key bitmaps."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # read for the bitmaps and for the table
    filters = build_filters(_with_folder(rows), KEY, "folder")
    months = rows.select(F.date_format("created_at", "yyyy-MM")).distinct().count()
    _filters(spark, root).create(filters, version, at_most=months * 1000)
    overwrite_partitioned(spark, _with_month(rows), root, PART_COL, version)
    rows.unpersist()


def read_payments(spark: SparkSession, root: str, before: str | None = None,
                  only: set[str] | None = None) -> DataFrame:
    """The table, or just some of its months (as folder names)."""
    return read_partitioned(spark, root, STORED, PART_COL, only=only, before=before).select(
        *SOURCE_PAYMENTS.fieldNames())


def _change(spark: SparkSession, root: str, rows: DataFrame, version: str) -> set[str]:
    """Put rows in place by key; none of them moves to another month."""
    delta = _with_month(rows)
    return upsert_partitioned(spark, root, STORED, delta, KEY, PART_COL, version, homes=delta.select(PART_COL).limit(0))


def months_of(spark: SparkSession, root: str, incoming: DataFrame, version: str) -> set[str] | None:
    """The months that may hold a key of ``incoming``; None (all) where no bitmaps cover the table."""
    filters = _filters(spark, root)
    covered = max((v for v in filters.versions() if v < version), default=None)
    if covered is None:
        return None
    return {r["part"] for r in possible_parts(filters.read(covered), incoming, KEY).collect()}  # months: the calendar


def insert_new_payments(spark: SparkSession, root: str, incoming: DataFrame, order: list[SortKey], run_ts: str,
                        look_up_at_most: int = 1_000_000) -> int:
    """``INSERT ... ON CONFLICT (transaction_id) DO NOTHING``; returns rows inserted.

    A batch of at most ``look_up_at_most`` keys is looked up in the bitmaps and
    joined to the months that may hold some of them. A larger one is joined to
    all months: it would have keys in most of them.
    """
    version = version_id(run_ts)
    filters = _filters(spark, root)
    covered = max((v for v in filters.versions() if v < version), default=None)
    first = latest_version(incoming, KEY, order).persist(StorageLevel.MEMORY_AND_DISK)
    only = months_of(spark, root, first, version) if first.count() <= look_up_at_most else None
    existing = read_payments(spark, root, before=version, only=only)
    obs = Observation(f"insert_{version}")
    new_rows = first.join(existing.select(*KEY), on=KEY, how="left_anti").select(*SOURCE_PAYMENTS.fieldNames())
    new_rows = new_rows.observe(obs, F.count(F.lit(1)).alias("rows")).persist(StorageLevel.MEMORY_AND_DISK)
    if covered is not None:  # before the rows themselves
        filters.put(add_keys(filters.read(covered), _with_folder(new_rows), KEY, "folder"), version, covered)
        filters.fold(version)
    written = _change(spark, root, new_rows, version)
    new_rows.unpersist()
    first.unpersist()
    return int(obs.get["rows"]) if written else 0


def newest_pending(spark: SparkSession, root: str, n: int, before: str | None = None) -> DataFrame:
    """The ``n`` newest pending rows, reading months from the newest one backwards until they are found.

    Each step reads twice as many months as the one before; rows without a date come last.
    """
    stored = current_partitions(spark, root, PART_COL, before)
    months = sorted((m for m, path in stored.items() if path and m != NULL_FOLDER), reverse=True)
    months += [NULL_FOLDER] if stored.get(NULL_FOLDER) else []
    order = [k.to_column() for k in NEWEST]
    chosen, left, step = [], n, 1
    while months and left > 0:
        some, months, step = set(months[:step]), months[step:], 2 * step
        if NULL_FOLDER in some and len(some) > 1:  # by itself: after all others
            some, months = some - {NULL_FOLDER}, [NULL_FOLDER]
        rows = (read_payments(spark, root, before, some).where(F.col("status") == F.lit("pending"))
                .orderBy(*order).limit(left).persist(StorageLevel.MEMORY_AND_DISK))
        chosen.append(rows)
        left -= rows.count()
    return reduce(DataFrame.unionByName, chosen) if chosen else read_payments(spark, root, before).limit(0)


def confirm_newest_pending(spark: SparkSession, root: str, n: int, run_ts: str) -> None:
    """Set the ``n`` newest pending payments to confirmed, stamping ``updated_at``."""
    version = version_id(run_ts)
    chosen = newest_pending(spark, root, n, before=version)
    _change(spark, root, chosen.withColumns({"status": F.lit("confirmed"), "updated_at": ts_lit(run_ts)}), version)
