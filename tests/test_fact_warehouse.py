"""Fact refresh and whole-warehouse scenarios on the sf0.001 tables."""

from pyspark.sql import functions as F

from revmart.functions.columns import ts_lit
from revmart.plans.fact import fact_delta, read_fact, refresh_fact
from revmart.plans.marts import fact_rows
from revmart.plans.enrich import enrich_payments
from revmart.plans.marts import daily_revenue
from revmart.plans.warehouse import (Warehouse, read_warehouse_fact, read_warehouse_report,
                                    run_warehouse)
from revmart.plans.staging import stg_payments
from revmart import queries as Q
from revmart.session import scratch_path
from revmart.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_equals_full_refresh(spark):
    raw = fx.raw_payments(spark, SF_SMALL)
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    root = scratch_path(spark, "fact-test")
    first = raw.where(F.col("loaded_at") < ts_lit("1998-01-01 00:00:00"))
    refresh_fact(spark, first, ph, ch, root, "1", tiebreak=fx.TIEBREAK)
    refresh_fact(spark, raw, ph, ch, root, "2", tiebreak=fx.TIEBREAK)
    full = fact_rows(enrich_payments(stg_payments(raw, tiebreak=fx.TIEBREAK), ph, ch))
    assert _set(read_fact(spark, root)) == _set(full)
    # re-running run 2 (after a crash) reads version 1 again, not its own output
    refresh_fact(spark, raw, ph, ch, root, "2", tiebreak=fx.TIEBREAK)
    assert _set(read_fact(spark, root)) == _set(full)


def test_partitioned_rerun_is_idempotent(spark):
    from revmart.plans.fact import read_fact_partitioned, refresh_fact_partitioned
    raw = fx.raw_payments(spark, SF_SMALL)
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    root = scratch_path(spark, "fact-part-rerun")
    first = raw.where(F.col("loaded_at") < ts_lit("1998-01-01 00:00:00"))
    refresh_fact_partitioned(spark, first, ph, ch, root, "1", tiebreak=fx.TIEBREAK)
    refresh_fact_partitioned(spark, raw, ph, ch, root, "2", tiebreak=fx.TIEBREAK)
    once = _set(read_fact_partitioned(spark, root))
    refresh_fact_partitioned(spark, raw, ph, ch, root, "2", tiebreak=fx.TIEBREAK)
    assert _set(read_fact_partitioned(spark, root)) == once


def test_changed_key_pruning_is_exact(spark):
    raw = fx.raw_payments(spark, SF_SMALL)
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    import datetime as dt
    mark = dt.datetime(1998, 6, 1)
    pruned = fact_delta(raw, ph, ch, mark, fx.TIEBREAK, prune=True)
    plain = fact_delta(raw, ph, ch, mark, fx.TIEBREAK, prune=False)
    assert _set(pruned) == _set(plain) and len(_set(plain)) > 0


def test_warehouse_two_runs(spark):
    """Run 1 sees payments up to mid-1998 and the first rates; run 2 sees everything."""
    wh = Warehouse(scratch_path(spark, "warehouse"))
    src = fx.source_payments(spark, SF_SMALL, with_tiebreak=False)
    runs = [("1998-07-01 00:00:00", 0), ("2010-01-01 00:00:00", 2)]
    for run_ts, snap in runs:
        visible = src.where(F.col("updated_at") <= ts_lit(run_ts))
        s = run_warehouse(spark, wh, visible, fx.provider_source(spark, SF_SMALL, snap),
                         fx.client_source(spark, SF_SMALL, snap), run_ts)
        assert s.payments_loaded > 0
    fact = read_warehouse_fact(spark, wh)
    # one row per payment, all recarga payments present
    n_ids = src.where("type = 'recarga'").select("transaction_id").distinct().count()
    assert fact.count() == n_ids == fact.select("transaction_id").distinct().count()
    # the incrementally kept report equals a full rebuild over the fact
    assert _set(read_warehouse_report(spark, wh)) == _set(daily_revenue(fact))
    # a third run with no new rows leaves the fact unchanged
    before = _set(fact)
    run_warehouse(spark, wh, src, fx.provider_source(spark, SF_SMALL, 2),
                  fx.client_source(spark, SF_SMALL, 2), "2010-01-02 00:00:00", retain_versions=1)
    assert _set(read_warehouse_fact(spark, wh)) == before


def test_partitioned_fact_moves_and_empties_partition(spark):
    import datetime as dt
    from revmart.schemas import FACT_SCHEMA
    from revmart.sinks.partitioned import current_partitions, upsert_partitioned
    from revmart.plans.fact import PART_COL, read_fact_partitioned, refresh_fact_partitioned
    raw = fx.raw_payments(spark, SF_SMALL)
    ph, ch = Q._provider_history(spark, SF_SMALL), Q._client_history(spark, SF_SMALL)
    root = scratch_path(spark, "fact-part-test")
    refresh_fact_partitioned(spark, raw, ph, ch, root, "1", tiebreak=fx.TIEBREAK)
    fact = read_fact_partitioned(spark, root, FACT_SCHEMA)
    # move every payment of one month to another date: its partition empties
    month = fact.select(F.date_format("transaction_date", "yyyy-MM").alias("m")).first().m
    moved = (fact.where(F.date_format("transaction_date", "yyyy-MM") == month)
             .withColumn("transaction_date", F.lit(dt.date(2030, 1, 1)))
             .withColumn(PART_COL, F.lit("2030-01")))
    n_moved = moved.count()
    from pyspark.sql.types import StringType, StructField, StructType
    stored = StructType(list(FACT_SCHEMA.fields) + [StructField(PART_COL, StringType())])
    touched = upsert_partitioned(spark, root, stored, moved, ["transaction_id"], PART_COL, "2")
    assert touched == {month, "2030-01"}
    parts = current_partitions(spark, root, PART_COL)
    assert parts[month] is None and parts["2030-01"] is not None
    after = read_fact_partitioned(spark, root, FACT_SCHEMA)
    assert after.count() == fact.count()
    assert after.where(F.col("transaction_date") == dt.date(2030, 1, 1)).count() == n_moved


def test_partitioned_uncommitted_revision_is_invisible(spark):
    import datetime as dt
    import os
    from revmart.sinks.partitioned import overwrite_partitioned, read_partitioned
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("id string, d date, x int")
    root = scratch_path(spark, "part-crash")
    df = spark.createDataFrame([("a", dt.date(2025, 1, 1), 1)], schema)
    overwrite_partitioned(spark, df, root, "d", "0001")
    # a crashed later run: data folder written, commit marker missing
    crashed = spark.createDataFrame([("a", dt.date(2025, 1, 1), 2)], schema)
    crashed.withColumn("__rev", F.lit("0002")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("d", "__rev").parquet(root)
    assert [r.x for r in read_partitioned(spark, root, schema, "d").collect()] == [1]
    assert os.path.isdir(root.replace("file:", "") + "/d=2025-01-01/__rev=0002")
