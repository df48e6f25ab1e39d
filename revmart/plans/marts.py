"""Marts: the fact table, the daily revenue report, current dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.functions.kpis import safe_ratio
from revmart.operators.scd2 import current_rows
from revmart.schemas import FACT_COLUMNS, RATIO, REPORT_COLUMNS, SUM_KPI, SUM_MONEY


def _confirmed():
    return F.col("status") == F.lit("confirmed")


def fact_rows(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def daily_revenue(fact: DataFrame) -> DataFrame:
    """One row per (date, client, provider); always a full rebuild.

    Partial aggregation runs before the shuffle, so a hot group costs one
    row per map task, not one per payment.
    """
    CONFIRMED = _confirmed()
    agg = fact.groupBy(F.col("transaction_date").alias("report_date"), "client_id",
                       "provider_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(CONFIRMED).alias("confirmed_transactions"),
        F.round(F.sum("amount"), 2).cast(SUM_MONEY).alias("total_amount"),
        # no matching row -> NULL, not 0
        F.round(F.sum(F.when(CONFIRMED, F.col("amount"))), 2).cast(SUM_MONEY).alias("confirmed_amount"),
        F.round(F.sum("gross_revenue"), 4).cast(SUM_KPI).alias("gross_revenue"),
        F.round(F.sum("client_payout"), 4).cast(SUM_KPI).alias("client_payout"),
        F.round(F.sum("net_revenue"), 4).cast(SUM_KPI).alias("net_revenue"),
    )
    return agg.withColumn(
        "confirmation_rate",
        safe_ratio(F.col("confirmed_transactions"), F.col("total_transactions")).cast(RATIO),
    ).select(*REPORT_COLUMNS)


def dim_providers(provider_history: DataFrame) -> DataFrame:
    return current_rows(provider_history).select(
        "provider_id", "biller_id", "commission_rate", "commission_type", "valid_from")


def dim_clients(client_history: DataFrame) -> DataFrame:
    return current_rows(client_history).select(
        "client_id", "revenue_share", "commission_type", "valid_from")
