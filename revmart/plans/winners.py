"""The current winner of each payment, and a fact that follows it.

``WinnerTable`` holds the latest version of every payment as a keyed table
(``sinks/keyed.py``). A run reads the raw batches that came since the last
run, keeps each payment's best row of them (a payment with a third of all
rows shrinks to one row per task before the exchange), compares it with the
stored winner by the dedup order, and adds the rows that won. Older raw
batches are not read, and the stored winners are neither moved nor rewritten:
of them the merge reads the key, the order and the date.

The changed winners, written with the date of the row each replaces, are all
that the fact needs: which rows to enrich, and which date partitions hold
the rows they replace. The fact's mark is saved last, so a version counts as
done in both tables only where both have it; whatever a crashed run left out
is merged by the next one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType, TimestampNTZType

from revmart.functions.columns import ts_lit
from revmart.operators.dedup import latest_version, order_value
from revmart.plans.enrich import enrich_payments
from revmart.plans.fact import (GRAIN_FORMATS, KEY, PART_COL, _mark_root, _save_mark, _stored, _with_partition,
                                read_fact_mark)
from revmart.plans.marts import fact_rows
from revmart.plans.staging import payment_order, stg_project
from revmart.schemas import EPOCH, FACT_SCHEMA, RAW_PAYMENTS
from revmart.sinks.keyed import KeyedTable
from revmart.sinks.partitioned import overwrite_partitioned, upsert_partitioned
from revmart.sinks.storage import committed_versions, read_batches

#: Of the winner that a changed row replaces.
REPLACES, REPLACED_AT = "replaces", "replaced_created_at"


class WinnerTable:
    def __init__(self, spark: SparkSession, root: str, raw_schema: StructType = RAW_PAYMENTS,
                 tiebreak: list[str] | None = None, **options) -> None:
        self.spark, self.raw_schema, self.order = spark, raw_schema, payment_order(tiebreak)
        stored = StructType([*raw_schema.fields, StructField(REPLACES, BooleanType()),
                             StructField(REPLACED_AT, TimestampNTZType())])
        self.table = KeyedTable(spark, root, stored, KEY, **options)

    def read(self, upto: str | None = None) -> DataFrame:
        """The winners as raw rows, without a dedup."""
        return self.table.read(upto, self.raw_schema.fieldNames())

    def merge(self, raw_root: str, version: str, after: str | None) -> DataFrame:
        """Merge the raw batches up to ``version`` into the winners as of ``after`` (None: all batches, anew).

        Versions between the two are those of unfinished runs and go.
        Returns the winners that changed, as they were written: raw columns, whether one is replaced
        and its ``created_at``.
        """
        self.table.discard(after, version)
        raw = read_batches(self.spark, raw_root, self.raw_schema, upto=version, after=after)
        at_most = raw.count()
        best = self.table.placed(latest_version(raw, KEY, self.order), after, at_most)
        if after is None:
            fresh = best.withColumns({REPLACES: F.lit(False), REPLACED_AT: F.lit(None).cast("timestamp_ntz")})
            self.table.create(fresh, version, at_most)
        else:
            self.table.put(self._won(best, after), version, after, at_most)
            self.table.fold(version)
        return self.table.changes(version)

    def _won(self, best: DataFrame, after: str) -> DataFrame:
        needed = list(dict.fromkeys([*KEY, *(k.column for k in self.order), "created_at"]))
        stored = self.table.read(after, needed).select(*(F.col(c).alias(f"stored_{c}") for c in needed))
        joined = best.join(stored, [F.col(k) == F.col(f"stored_{k}") for k in KEY], "left")
        known = F.col(f"stored_{KEY[0]}").isNotNull()
        return joined.where(~known | (order_value(self.order) > order_value(self.order, "stored_"))).select(
            *self.raw_schema.fieldNames(), known.alias(REPLACES), F.col("stored_created_at").alias(REPLACED_AT))


def merged_up_to(spark: SparkSession, winners: WinnerTable, fact_root: str, before: str) -> str | None:
    """The newest version older than ``before`` that is complete in the winners and in the fact."""
    both = winners.table.versions() & set(committed_versions(spark, _mark_root(fact_root)))
    return max((v for v in both if v < before), default=None)


def refresh_fact_from_winners(spark: SparkSession, raw_root: str, winners: WinnerTable,
                              provider_history: DataFrame, client_history: DataFrame, fact_root: str,
                              version: str, full_refresh: bool = False, files_per_partition: int = 1,
                              grain: str = "month") -> set[str] | None:
    """Winners merged with the new raw batches, then the touched date partitions of the fact.

    The rows are those of ``refresh_fact_partitioned``. Returns the touched
    partitions, None where the whole fact was written.
    """
    after = merged_up_to(spark, winners, fact_root, version)
    changed = winners.merge(raw_root, version, after)
    obs = Observation(f"fact_{version}")
    newest = F.max("loaded_at").alias("m")

    def as_fact(rows: DataFrame) -> DataFrame:
        enriched = enrich_payments(stg_project(rows), provider_history, client_history)
        return _with_partition(fact_rows(enriched), grain).observe(obs, newest)

    if full_refresh or after is None:
        overwrite_partitioned(spark, as_fact(winners.read(version)), fact_root, PART_COL, version,
                              files_per_partition, KEY)
        touched, mark = None, obs.get.get("m")
    else:
        mark = read_fact_mark(spark, fact_root, before=version)
        late = changed.where(F.col("loaded_at") > ts_lit(mark))
        homes = late.where(REPLACES).select(F.date_format(REPLACED_AT, GRAIN_FORMATS[grain]).alias(PART_COL))
        touched = upsert_partitioned(spark, fact_root, _stored(FACT_SCHEMA, PART_COL), as_fact(late), KEY, PART_COL,
                                     version, files_per_partition, homes=homes)
        mark = max(mark, (obs.get.get("m") if touched else None) or mark)
    _save_mark(spark, fact_root, mark or dt.datetime.fromisoformat(EPOCH), version)
    return touched
