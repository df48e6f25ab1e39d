"""Payments enriched with the rates valid at payment time, and the KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.functions.kpis import client_payout, gross_revenue, net_revenue
from revmart.operators.asof import asof_lookup
from revmart.operators.temporal import interval_lookup
from revmart.schemas import ENRICHED_COLUMNS

PROVIDER_KEYS = {"provider_id": "provider_id", "company_code": "biller_id"}
CLIENT_KEYS = {"client_id": "client_id"}


def _lookup(payments: DataFrame, history: DataFrame, keys: dict[str, str], values: dict[str, str],
            salt_buckets: int | None, large: bool, times: DataFrame | None = None) -> DataFrame:
    if large:
        return asof_lookup(payments, history, keys, "transaction_timestamp", values, times=times)
    return interval_lookup(payments, history, keys, "transaction_timestamp", values, salt_buckets=salt_buckets)


def lookup_commission(payments: DataFrame, provider_history: DataFrame,
                      salt_buckets: int | None = None, large: bool = False) -> DataFrame:
    return _lookup(payments, provider_history, PROVIDER_KEYS, {"commission_rate": "commission_rate"},
                   salt_buckets, large)


def lookup_share(payments: DataFrame, client_history: DataFrame,
                 salt_buckets: int | None = None, large: bool = False, times: DataFrame | None = None) -> DataFrame:
    """``times``: where ``payments`` is itself a lookup's result, the table that it was made of."""
    return _lookup(payments, client_history, CLIENT_KEYS, {"revenue_share": "revenue_share"}, salt_buckets, large, times)


def enrich_payments(stg: DataFrame, provider_history: DataFrame, client_history: DataFrame,
                    salt_buckets: int | None = None, large: bool = False) -> DataFrame:
    """``salt_buckets`` salts the lookups' shuffle; ``large``: histories of any size, by an as-of merge
    (which reads the payments several times: pass a stored table)."""
    with_rates = lookup_share(lookup_commission(stg, provider_history, salt_buckets, large),
                              client_history, salt_buckets, large, times=stg)
    return with_rates.select(
        "transaction_id", "transaction_date", "transaction_timestamp", "status", "amount",
        "provider_id", F.col("company_code").alias("biller_id"), "client_id",
        "external_client_id",
        F.col("commission_rate").cast("decimal(5,4)").alias("commission_rate"),
        F.col("revenue_share").cast("decimal(5,4)").alias("revenue_share"),
        gross_revenue().alias("gross_revenue"),
        client_payout().alias("client_payout"),
        net_revenue().alias("net_revenue"),
        "loaded_at",
    ).select(*ENRICHED_COLUMNS)
