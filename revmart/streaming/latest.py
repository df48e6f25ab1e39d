"""Streaming "latest row per key" table for any keyed change stream.

A streaming aggregation ``groupBy(keys).agg(max_by(row, order))`` in update
mode keeps each key's current winner in the state store; every micro-batch
emits the winners of the keys that came. They are written as the changes of
that version of a keyed table (``sinks/keyed.py``): a batch writes these rows
and nothing else, readers merge, and now and then the changes are folded into
the base. Replayed batches write the same version again, so the table stays
exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from revmart.operators.dedup import SortKey, latest_by_aggregate
from revmart.sinks.keyed import KeyedTable
from revmart.sinks.storage import read_version, write_version


def run_latest_stream(spark: SparkSession, landing_dir: str, schema: StructType, keys: list[str],
                      order: list[SortKey], table_root: str, checkpoint_dir: str,
                      max_files_per_trigger: int | None = None, **options) -> int:
    """One ``availableNow`` run; returns the number of micro-batches that changed the table."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    winners = latest_by_aggregate(reader.parquet(landing_dir), keys, order)
    table = KeyedTable(spark, table_root, schema, keys, **options)
    changed = []

    def put(batch: DataFrame, batch_id: int) -> None:
        version = f"{batch_id:012d}"
        after = max((v for v in table.versions() if v < version), default=None)
        if after is None:  # written as it comes first: the base's buckets follow its number of rows
            write_version(batch, f"{table.root}/first", version)
            first = read_version(spark, f"{table.root}/first", version, schema)
            table.create(first, version, at_most=first.count())
        else:
            table.put(batch, version, after)
        if not table.changes(version).isEmpty():
            changed.append(batch_id)
        table.fold(version)

    query = (winners.writeStream.outputMode("update").foreachBatch(put)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(changed)


def read_latest(spark: SparkSession, table_root: str, schema: StructType, keys: list[str]) -> DataFrame:
    return KeyedTable(spark, table_root, schema, keys).read()
