"""Staging models: typed, renamed projections; payments deduplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.operators.dedup import SortKey, latest_version
from revmart.schemas import (CLIENT_COMMISSION_TYPE, PROVIDER_COMMISSION_TYPE,
                             STG_PAYMENTS_COLUMNS)

# Latest version: newest updated_at (NULL last), then newest loaded_at with
# NULL first (PostgreSQL's default for DESC, which the models rely on).
PAYMENT_ORDER = [SortKey("updated_at", descending=True, nulls_first=False),
                 SortKey("loaded_at", descending=True, nulls_first=True)]


def payment_order(tiebreak: list[str] | None = None) -> list[SortKey]:
    return PAYMENT_ORDER + [SortKey(c, descending=True, nulls_first=False) for c in tiebreak or []]


def stg_payments(raw: DataFrame, tiebreak: list[str] | None = None,
                 method: str = "window") -> DataFrame:
    """Latest version of each payment, typed and renamed."""
    latest = latest_version(raw, ["transaction_id"], payment_order(tiebreak), method=method)
    return stg_project(latest)


def stg_project(latest: DataFrame) -> DataFrame:
    """Typed, renamed staging columns of already-deduplicated payment rows."""
    return latest.select(
        "transaction_id",
        F.col("created_at").alias("transaction_timestamp"),
        F.to_date("created_at").alias("transaction_date"),
        "status",
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        "type",
        "company_code",
        F.col("external_provider_id").alias("provider_id"),
        "client_id",
        "external_client_id",
        "loaded_at",
    ).select(*STG_PAYMENTS_COLUMNS)


def stg_providers(raw_providers: DataFrame) -> DataFrame:
    return raw_providers.where(F.col("commission_type") == PROVIDER_COMMISSION_TYPE).select(
        F.col("external_provider_id").alias("provider_id"),
        F.col("company_code").alias("biller_id"),
        F.col("commission_rate").cast("decimal(5,4)").alias("commission_rate"),
        "commission_type",
        "loaded_at")


def stg_clients(raw_clients: DataFrame) -> DataFrame:
    return raw_clients.where(F.col("commission_type") == CLIENT_COMMISSION_TYPE).select(
        "client_id",
        F.col("revenue_share").cast("decimal(5,4)").alias("revenue_share"),
        "commission_type",
        "loaded_at")


def provider_snapshot_input(raw_providers: DataFrame) -> DataFrame:
    """What the provider snapshot compares: key (provider, biller) + checked columns."""
    return stg_providers(raw_providers).drop("loaded_at")


def client_snapshot_input(raw_clients: DataFrame) -> DataFrame:
    return stg_clients(raw_clients).drop("loaded_at")
