"""SCD2 snapshot models of the two rate dimensions.

Each snapshot run reads the committed history, applies one ``scd2_step``
and commits the result as the next version of the history table, so a
run's lineage is one step deep and a crashed run changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions.columns import null_safe_differs, ts_lit
from revmart.operators.scd2 import guard_unique, history_from_snapshots, scd2_step
from revmart.sinks.keyed import KeyedTable
from revmart.sinks.storage import (append_batch, committed_batches, read_batches, read_current, version_id,
                                   write_version)

PROVIDER_KEYS = ["provider_id", "biller_id"]
PROVIDER_CHECK = ["commission_rate", "commission_type"]
CLIENT_KEYS = ["client_id"]
CLIENT_CHECK = ["revenue_share", "commission_type"]

_VALIDITY = [T.StructField("valid_from", T.TimestampNTZType(), False),
             T.StructField("valid_to", T.TimestampNTZType(), True)]
PROVIDER_HISTORY = T.StructType([
    T.StructField("provider_id", T.StringType(), True),
    T.StructField("biller_id", T.StringType(), True),
    T.StructField("commission_rate", T.DecimalType(5, 4), True),
    T.StructField("commission_type", T.StringType(), True),
] + _VALIDITY)
CLIENT_HISTORY = T.StructType([
    T.StructField("client_id", T.StringType(), True),
    T.StructField("revenue_share", T.DecimalType(5, 4), True),
    T.StructField("commission_type", T.StringType(), True),
] + _VALIDITY)

SPECS = {
    "providers": (PROVIDER_HISTORY, PROVIDER_KEYS, PROVIDER_CHECK),
    "clients": (CLIENT_HISTORY, CLIENT_KEYS, CLIENT_CHECK),
}


def snapshot_step(history: DataFrame, incoming: DataFrame, run_ts: str, kind: str) -> DataFrame:
    schema, keys, check = SPECS[kind]
    data_cols = [f.name for f in schema.fields if f.name not in ("valid_from", "valid_to")]
    return scd2_step(history, incoming.select(*data_cols), keys, check, ts_lit(run_ts))


def run_snapshot(spark: SparkSession, root: str, incoming: DataFrame, run_ts: str,
                 kind: str) -> str:
    """One snapshot run: committed history + incoming -> next committed version."""
    schema = SPECS[kind][0]
    version = version_id(run_ts)
    history = read_current(spark, root, schema, before=version)
    return write_version(snapshot_step(history, incoming, run_ts, kind).hint("rebalance"), root, version)


def replay(spark: SparkSession, snapshots: DataFrame, runs: list[str], kind: str,
           root: str | None = None) -> DataFrame:
    """Run the snapshot once per run time (``run_ts`` picks each run's input).

    With ``root`` every run is committed as a table version (the warehouse run's
    way); without it the runs are chained lazily into one plan, which reads
    each intermediate history once.
    """
    if root is None:
        history = spark.createDataFrame([], SPECS[kind][0])
        for run in runs:
            incoming = snapshots.where(F.col("run_ts") == ts_lit(run)).drop("run_ts")
            history = snapshot_step(history, incoming, run, kind)
        return history
    for run in runs:
        incoming = snapshots.where(F.col("run_ts") == ts_lit(run)).drop("run_ts")
        run_snapshot(spark, root, incoming, run, kind)
    return read_current(spark, root, SPECS[kind][0])


def rebuild(snapshots: DataFrame, kind: str) -> DataFrame:
    """The same history from the archive of all snapshots in one pass (no replay)."""
    schema, keys, check = SPECS[kind]
    data_cols = [f.name for f in schema.fields if f.name not in ("valid_from", "valid_to")]
    hist = history_from_snapshots(snapshots.select(*data_cols, "run_ts"), keys, check)
    return hist.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


class HistoryTable:
    """An SCD2 history whose closed rows are written once.

        <root>/open/                    the open row of each key, a keyed table (sinks/keyed.py)
        <root>/closed/batch=<version>/  the rows that the run closed; never written again

    A run joins the snapshot to the open rows, which lie bucketed by the key,
    and writes the keys that are new or changed, each with the row that it
    closes. The closed rows are then taken from that write. Both together give
    the rules of ``scd2_step``; a version counts where both are committed.
    """

    def __init__(self, spark: SparkSession, root: str, kind: str, **options) -> None:
        self.spark, self.kind, self.closed_root = spark, kind, f"{root.rstrip('/')}/closed"
        self.schema, self.keys, self.check = SPECS[kind]
        self.data = [f.name for f in self.schema.fields if f.name not in ("valid_from", "valid_to")]
        open_fields = [f for f in self.schema.fields if f.name != "valid_to"]
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in self.schema.fields])
        self.open = KeyedTable(spark, f"{root.rstrip('/')}/open",
                               T.StructType([*open_fields, T.StructField("closes", nullable)]), self.keys, **options)

    def complete(self, before: str | None = None, upto: str | None = None) -> str | None:
        """The newest version that holds in both parts."""
        both = self.open.versions() & set(committed_batches(self.spark, self.closed_root))
        return max((v for v in both if (before is None or v < before) and (upto is None or v <= upto)), default=None)

    def read(self, upto: str | None = None) -> DataFrame:
        """The whole history as of the newest complete version (up to ``upto``)."""
        version = self.complete(upto=upto)
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        open_rows = self.open.read(version, [*self.data, "valid_from"]).withColumn(
            "valid_to", F.lit(None).cast(self.schema["valid_to"].dataType))
        closed = read_batches(self.spark, self.closed_root, self.schema, upto=version)
        return open_rows.select(*self.schema.fieldNames()).unionByName(closed)

    def step(self, incoming: DataFrame, run_ts: str) -> str:
        """One snapshot run; returns its version."""
        version = version_id(run_ts)
        after = self.complete(before=version)
        self.open.discard(after, version)  # of unfinished runs
        incoming = incoming.select(*self.data)
        at_most = incoming.count()
        # dealt once: the guard, the join and the write take the rows where they lie
        incoming = guard_unique(self.open.placed(incoming, after, at_most), self.keys, "scd2 incoming snapshot")
        closes = self.open.schema["closes"].dataType
        if after is None:
            self.open.create(incoming.select("*", ts_lit(run_ts).alias("valid_from"), F.lit(None).cast(closes).alias("closes")),
                             version, at_most)
        else:
            old = self.open.read(after, [*self.data, "valid_from"])
            old = old.select(*[F.col(c).alias(f"old_{c}") for c in old.columns], F.lit(True).alias("known"))
            joined = incoming.join(old, [F.col(k) == F.col(f"old_{k}") for k in self.keys], "left")
            differs = null_safe_differs([F.col(f"old_{c}") for c in self.check], [F.col(c) for c in self.check])
            old_row = F.struct(*[F.col(f"old_{c}").alias(c) for c in (*self.data, "valid_from")],
                               ts_lit(run_ts).alias("valid_to"))
            moved = joined.where(F.col("known").isNull() | differs).select(
                *self.data, ts_lit(run_ts).alias("valid_from"), F.when(F.col("known"), old_row).cast(closes).alias("closes"))
            self.open.put(moved, version, after, at_most)
        closed = self.open.changes(version).where("closes is not null").select("closes.*")
        append_batch(closed, self.closed_root, version)
        self.open.fold(version)
        return version
