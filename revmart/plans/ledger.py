"""A fact kept by key, and a daily report kept by retraction.

The ledger is a keyed table (``sinks/keyed.py``) with one row per payment:
the order columns of its winner and the fact row as it was loaded. A run
merges the raw batches that came since; a payment whose winner changed gets
a new row, which also holds the fact row that it replaces. Only such rows
are written.

The report's counts and sums are stored per (date, client, provider). A run
reads the rows that the ledger wrote, takes each replaced fact row as -1 and
each new one as +1, adds these up by group, and adds the result to the stored
sums of the groups that occur. Unchanged fact rows are not read. A SUM of no
values is NULL, not 0, so every sum is kept beside the number of its values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions.columns import ts_lit
from revmart.functions.kpis import safe_ratio
from revmart.operators.dedup import latest_version, order_value
from revmart.plans.enrich import enrich_payments
from revmart.plans.fact import KEY, _save_mark, max_loaded_at, read_fact_mark
from revmart.plans.marts import fact_rows
from revmart.plans.staging import payment_order, stg_project
from revmart.schemas import FACT_COLUMNS, FACT_SCHEMA, RATIO, RAW_PAYMENTS, REPORT_COLUMNS, SUM_KPI, SUM_MONEY
from revmart.sinks.keyed import KeyedTable
from revmart.sinks.storage import committed_versions, read_batches, read_version, write_version

GROUP = {"report_date": "transaction_date", "client_id": "client_id", "provider_id": "provider_id"}
#: stored sum -> (its type, the value that a fact row adds)
MEASURES = {
    "total_amount": (SUM_MONEY, lambda row: row["amount"]),
    "confirmed_amount": (SUM_MONEY, lambda row: F.when(row["status"] == F.lit("confirmed"), row["amount"])),
    "gross_revenue": (SUM_KPI, lambda row: row["gross_revenue"]),
    "client_payout": (SUM_KPI, lambda row: row["client_payout"]),
    "net_revenue": (SUM_KPI, lambda row: row["net_revenue"]),
}
COUNTS = ["total_transactions", "confirmed_transactions"]
SUMS = T.StructType(
    [T.StructField("group_key", T.StringType()), T.StructField("report_date", T.DateType()),
     T.StructField("client_id", T.StringType()), T.StructField("provider_id", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COUNTS]
    + [f for m, (kind, _) in MEASURES.items()
       for f in (T.StructField(m, kind), T.StructField(f"{m}_values", T.LongType()))])


class PaymentLedger:
    def __init__(self, spark: SparkSession, root: str, raw_schema: T.StructType = RAW_PAYMENTS,
                 tiebreak: list[str] | None = None, **options) -> None:
        self.spark, self.root, self.raw_schema = spark, root.rstrip("/"), raw_schema
        self.order = payment_order(tiebreak)
        self.order_cols = [k.column for k in self.order]
        stored = T.StructType([
            raw_schema[KEY[0]], *(T.StructField(c, raw_schema[c].dataType) for c in self.order_cols),
            T.StructField("fact", FACT_SCHEMA), T.StructField("replaced", FACT_SCHEMA),
            T.StructField("counts", T.BooleanType())])
        self.table = KeyedTable(spark, f"{self.root}/payments", stored, KEY, **options)
        self.sums = KeyedTable(spark, f"{self.root}/sums", SUMS, ["group_key"], **options)

    def merged_up_to(self, before: str) -> str | None:
        """The newest version older than ``before`` that is complete: the mark is saved last."""
        both = self.table.versions() & self.sums.versions() & set(
            committed_versions(self.spark, f"{self.root}/_mark"))
        return max((v for v in both if v < before), default=None)

    def read_fact(self, upto: str | None = None) -> DataFrame:
        rows = self.table.read(upto, [*KEY, "fact"]).where("fact is not null")
        return rows.select("fact.*").select(*FACT_COLUMNS)

    def read_report(self, upto: str | None = None) -> DataFrame:
        rows = self.sums.read(upto).where("total_transactions > 0")
        return rows.select(
            *GROUP, *COUNTS, *[F.when(F.col(f"{m}_values") > 0, F.col(m)).alias(m) for m in MEASURES],
            safe_ratio(F.col("confirmed_transactions"), F.col("total_transactions")).cast(RATIO)
            .alias("confirmation_rate")).select(*REPORT_COLUMNS)

    # ---- one run ---------------------------------------------------------

    def refresh(self, raw_root: str, provider_history: DataFrame, client_history: DataFrame, version: str) -> None:
        """Merge the raw batches up to ``version``; then the report's sums; the mark last."""
        after = self.merged_up_to(version)
        self.table.discard(after, version)  # of unfinished runs
        self.sums.discard(after, version)
        mark = read_fact_mark(self.spark, self.root, before=version) if after else None
        raw = read_batches(self.spark, raw_root, self.raw_schema, upto=version, after=after)
        at_most = raw.count()
        best = latest_version(raw, KEY, self.order)
        won = self._won(self.table.placed(best, after, at_most) if after else best, after)
        write_version(won, f"{self.root}/won", version)  # read twice below
        won = read_version(self.spark, f"{self.root}/won", version, won.schema)
        rows = self._with_facts(won, mark, provider_history, client_history)
        if after is None:
            self.table.create(rows, version, at_most)
        else:
            self.table.put(rows, version, after, at_most)
        written = self.table.changes(version)
        self._add_to_sums(written, version, after)
        newest = max_loaded_at(written.where("counts").select("fact.loaded_at"))
        _save_mark(self.spark, self.root, max(newest, mark or dt.datetime.min), version)
        self.table.fold(version)
        self.sums.fold(version)

    def _won(self, best: DataFrame, after: str | None) -> DataFrame:
        """Payments whose winner changed: the raw columns, and the fact row so far as ``replaced``."""
        if after is None:
            return best.withColumn("replaced", F.lit(None).cast(FACT_SCHEMA))
        needed = [*KEY, *self.order_cols, "fact"]
        stored = self.table.read(after, needed).select(*[F.col(c).alias(f"stored_{c}") for c in needed])
        joined = best.join(stored, [F.col(k) == F.col(f"stored_{k}") for k in KEY], "left")
        changed = F.col(f"stored_{KEY[0]}").isNull() | (order_value(self.order) > order_value(self.order, "stored_"))
        return joined.where(changed).select(*self.raw_schema.fieldNames(), F.col("stored_fact").alias("replaced"))

    def _with_facts(self, won: DataFrame, mark: dt.datetime | None, provider_history: DataFrame,
                    client_history: DataFrame) -> DataFrame:
        """Ledger rows. A winner that was loaded no later than the mark leaves its fact row as it is."""
        late = won if mark is None else won.where(F.col("loaded_at") > ts_lit(mark))
        facts = fact_rows(enrich_payments(stg_project(late), provider_history, client_history)).select(
            F.col(KEY[0]).alias("fact_key"), F.struct(*FACT_COLUMNS).alias("new_fact"))
        joined = won.join(facts, F.col(KEY[0]) == F.col("fact_key"), "left")
        counts = F.col("fact_key").isNotNull()
        return joined.select(
            *KEY, *self.order_cols, F.when(counts, F.col("new_fact")).otherwise(F.col("replaced")).alias("fact"),
            F.when(counts, F.col("replaced")).alias("replaced"), counts.alias("counts"))

    def _add_to_sums(self, written: DataFrame, version: str, after: str | None) -> None:
        change, at_most = sums_of(signed_rows(written)), written.count()
        if after is None:
            self.sums.create(change, version, at_most)
            return
        stored = self.sums.read(after)
        numbers = [c for c in SUMS.fieldNames() if c not in ("group_key", *GROUP)]
        stored = stored.select(F.col("group_key").alias("stored_key"), *[F.col(c).alias(f"stored_{c}") for c in numbers])
        added = change.join(stored, F.col("group_key") == F.col("stored_key"), "left").select(
            "group_key", *GROUP, *[(F.col(c) + F.coalesce(f"stored_{c}", F.lit(0))).cast(SUMS[c].dataType).alias(c)
                                   for c in numbers])
        self.sums.put(added, version, after, 2 * at_most)


def signed_rows(written: DataFrame) -> DataFrame:
    """(sign, fact): the fact rows that came, +1, and those that they replace, -1."""
    came = F.struct(F.lit(1).alias("sign"), F.col("fact").alias("fact"))
    went = F.struct(F.lit(-1).alias("sign"), F.col("replaced").alias("fact"))
    both = written.where("counts").select(F.explode(F.array(came, went)).alias("x")).select("x.*")
    return both.where("fact is not null")


def sums_of(signed: DataFrame) -> DataFrame:
    """What signed fact rows add to the stored counts and sums of their groups (partial sums before the shuffle)."""
    def total(value: Column) -> Column:
        return F.sum(F.when(F.col("sign") > 0, value).otherwise(-value))

    fact = F.col("fact")
    confirmed = F.coalesce(fact["status"] == F.lit("confirmed"), F.lit(False))
    one = F.lit(1).cast("long")
    sums = [total(one).alias("total_transactions"), total(confirmed.cast("long")).alias("confirmed_transactions")]
    for name, (kind, value) in MEASURES.items():
        sums += [F.coalesce(total(value(fact)).cast(kind), F.lit(0).cast(kind)).alias(name),
                 total(value(fact).isNotNull().cast("long")).alias(f"{name}_values")]
    groups = signed.groupBy(*[fact[c].alias(g) for g, c in GROUP.items()]).agg(*sums)
    # a key without NULLs, which stored groups are found by
    return groups.select(F.to_json(F.struct(*GROUP), {"ignoreNullFields": "false"}).alias("group_key"),
                         *SUMS.fieldNames()[1:])
