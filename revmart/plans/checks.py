"""The warehouse's data-quality suite (the declarative tests of each layer)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revmart.operators.quality import Rule, column_checks, scd2_checks, union_all, unique_check
from revmart.schemas import (CLIENT_COMMISSION_TYPE, INGESTED_TYPE, PAYMENT_STATUSES,
                             PROVIDER_COMMISSION_TYPE)

STATUSES = tuple(PAYMENT_STATUSES)

# The column-length limits of the raw payments table.
RAW_PAYMENT_LENGTHS = {
    "transaction_id": 64, "status": 20, "type": 30, "company_code": 50,
    "external_provider_id": 50, "client_id": 50, "external_client_id": 50,
}

NOT_NULL = {
    "raw_payments": ["transaction_id", "created_at", "status", "amount", "type"],
    "raw_providers": ["external_provider_id", "company_code", "commission_rate", "commission_type"],
    "raw_clients": ["client_id", "revenue_share", "commission_type"],
    "payments_enriched": ["transaction_id", "gross_revenue", "client_payout", "net_revenue"],
    "fact_payments": ["transaction_id", "status", "amount", "gross_revenue", "client_payout",
                      "net_revenue"],
    "daily_revenue": ["report_date", "client_id", "provider_id"],
}

ACCEPTED = {
    "source_payments": [("type", (INGESTED_TYPE,))],
    "raw_payments": [("status", STATUSES), ("type", (INGESTED_TYPE,))],
    "raw_providers": [("commission_type", (PROVIDER_COMMISSION_TYPE,))],
    "raw_clients": [("commission_type", (CLIENT_COMMISSION_TYPE,))],
    "fact_payments": [("status", STATUSES)],
}

UNIQUE = {
    # Expected to fail on an append-only log: kept to show it (see README).
    "raw_payments": ["transaction_id"],
    "stg_payments": ["transaction_id"],
    "payments_enriched": ["transaction_id"],
    "fact_payments": ["transaction_id"],
    "raw_clients": ["client_id"],
    "raw_providers": ["external_provider_id", "company_code"],
}


def not_null_suite(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([column_checks(tables[t], t, [Rule(c, "not_null") for c in cols])
                      for t, cols in NOT_NULL.items() if t in tables])


def accepted_values_suite(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([column_checks(tables[t], t, [Rule(c, "accepted_values", v) for c, v in rules])
                      for t, rules in ACCEPTED.items() if t in tables])


def unique_suite(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([unique_check(tables[t], t, keys) for t, keys in UNIQUE.items() if t in tables])


def length_suite(raw_payments: DataFrame) -> DataFrame:
    return column_checks(raw_payments, "raw_payments",
                         [Rule(c, "max_length", max_length=n) for c, n in RAW_PAYMENT_LENGTHS.items()])


def scd2_suite(provider_history: DataFrame, client_history: DataFrame) -> DataFrame:
    return union_all([scd2_checks(provider_history, "provider_history", ["provider_id", "biller_id"]),
                      scd2_checks(client_history, "client_history", ["client_id"])])


def report_range_suite(report: DataFrame) -> DataFrame:
    return column_checks(report, "daily_revenue", [Rule("confirmation_rate", "range", low=0, high=1)])
