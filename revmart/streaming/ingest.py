"""Continuous ingest: a landing folder of payment changes -> raw log -> fact upsert.

The file source's checkpoint (the set of processed files) replaces the
batch job's high-water mark, so late rows are never skipped. Two streaming
queries run one after the other:

1. **raw log**: ``type = recarga`` rows of the landing folder, stamped with
   ``loaded_at``, are written per micro-batch to folder ``batch=<batch id>``. A
   batch replayed after its folder was committed (crash before the commit log)
   is left as the first attempt wrote it, with its stamp; one that was not is
   written anew. Either way raw holds it once, whichever run replays it.
2. **latest version + fact**: reads the raw log's files, so a payment has one
   stamp in raw and in the fact whichever run gets it there. It starts when the
   first query has ended: all batches are then committed and no file it sees is
   written again. A streaming aggregation
   ``groupBy(transaction_id).agg(max_by(row, order))`` keeps each payment's
   current winner in the state store (RocksDB), partitioned by key across
   executors, with the dates of all versions seen (NULL too). In update mode each
   micro-batch emits only the payments whose winner changed; those are
   enriched and upserted into the date-partitioned fact as revision
   ``<batch id>``. The dates say which partitions can hold the payment, so
   the fact's keys are never searched. A batch whose revision is committed
   is not written again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from revmart.functions.columns import ts_lit
from revmart.operators.dedup import latest_by_aggregate
from revmart.plans.enrich import enrich_payments
from revmart.plans.fact import GRAIN_FORMATS, PART_COL, KEY
from revmart.plans.marts import fact_rows
from revmart.plans.staging import payment_order, stg_project
from revmart.schemas import FACT_SCHEMA, INGESTED_TYPE
from revmart.sinks.partitioned import is_committed, prune_revisions, upsert_partitioned
from revmart.sinks.storage import _fs, append_batch, is_batch_committed


def _id(batch_id: int) -> str:
    """The same for every attempt at a micro-batch."""
    return f"{batch_id:012d}"


def _undated() -> Column:
    """Stands for a NULL date in a set, which drops NULLs: a day that no timestamp reaches."""
    return F.date_from_unix_date(F.lit(2**31 - 1))


def run_stream(spark: SparkSession, landing_dir: str, landing_schema: StructType, raw_root: str,
               fact_root: str, checkpoint_dir: str, run_ts: str, provider_history: DataFrame,
               client_history: DataFrame, tiebreak: list[str] | None = None,
               max_files_per_trigger: int | None = None, grain: str = "month", prune: bool = False) -> int:
    """Process everything that landed since the last run (``availableNow``).

    ``prune`` deletes the fact's superseded revisions afterwards. Returns the
    number of micro-batches that changed the fact.
    """
    raw_schema = StructType(landing_schema.fields + [StructField("loaded_at", TimestampNTZType())])

    def files(schema: StructType, folder: str) -> DataFrame:
        reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.parquet(folder)

    def append_raw(batch: DataFrame, batch_id: int) -> None:
        if not is_batch_committed(spark, raw_root, _id(batch_id)):
            append_batch(batch, raw_root, _id(batch_id))

    changed = []
    stored = StructType(list(FACT_SCHEMA.fields) + [StructField(PART_COL, StringType())])

    def upsert_fact(winners: DataFrame, batch_id: int) -> None:
        if is_committed(spark, fact_root, _id(batch_id)):
            winners.write.format("noop").mode("overwrite").save()  # the state has to be carried on
            return
        winners = winners.persist()  # read for the rows and for their dates
        delta = fact_rows(enrich_payments(stg_project(winners), provider_history, client_history))
        delta = delta.withColumn(PART_COL, F.date_format("transaction_date", GRAIN_FORMATS[grain]))
        homes = winners.select(F.explode("dates").alias("d")).select(
            F.date_format(F.nullif("d", _undated()), GRAIN_FORMATS[grain]).alias(PART_COL))
        if upsert_partitioned(spark, fact_root, stored, delta, KEY, PART_COL, _id(batch_id), homes=homes):
            changed.append(batch_id)
        winners.unpersist()

    landed = (files(landing_schema, landing_dir).where(F.col("type") == F.lit(INGESTED_TYPE))
              .withColumn("loaded_at", ts_lit(run_ts)).select(*raw_schema.fieldNames()))
    (landed.writeStream.foreachBatch(append_raw).option("checkpointLocation", f"{checkpoint_dir}/raw")
     .trigger(availableNow=True).start().awaitTermination())
    fs, path, _ = _fs(spark, raw_root)
    fs.mkdirs(path)  # where nothing has landed yet
    # a payment's dates: one, or a few where its date moved
    dates = F.collect_set(F.coalesce(F.to_date("created_at"), _undated()))
    winners = latest_by_aggregate(files(raw_schema, raw_root), ["transaction_id"], payment_order(tiebreak),
                                  dates.alias("dates"))
    (winners.writeStream.outputMode("update").foreachBatch(upsert_fact)
     .option("checkpointLocation", f"{checkpoint_dir}/fact")
     .trigger(availableNow=True).start().awaitTermination())
    if prune:
        prune_revisions(spark, fact_root, PART_COL)
    return len(changed)
