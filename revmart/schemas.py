"""Explicit schemas of the raw and derived tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(5, 4)
ROW_KPI = T.DecimalType(20, 4)
SUM_MONEY = T.DecimalType(38, 2)
SUM_KPI = T.DecimalType(38, 4)
RATIO = T.DecimalType(10, 4)
TS = T.TimestampNTZType()

# OLTP payments source: ten columns, transaction_id is the key.
SOURCE_PAYMENTS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("created_at", TS, False),
    T.StructField("updated_at", TS, True),
    T.StructField("status", T.StringType(), True),
    T.StructField("amount", MONEY, True),
    T.StructField("type", T.StringType(), True),
    T.StructField("company_code", T.StringType(), True),
    T.StructField("external_provider_id", T.StringType(), True),
    T.StructField("client_id", T.StringType(), True),
    T.StructField("external_client_id", T.StringType(), True),
])

# Append-only raw log: the source columns plus the load stamp.
RAW_PAYMENTS = T.StructType(SOURCE_PAYMENTS.fields + [T.StructField("loaded_at", TS, True)])

RAW_PROVIDERS = T.StructType([
    T.StructField("external_provider_id", T.StringType(), False),
    T.StructField("company_code", T.StringType(), False),
    T.StructField("commission_rate", RATE, True),
    T.StructField("commission_type", T.StringType(), True),
    T.StructField("loaded_at", TS, True),
])

RAW_CLIENTS = T.StructType([
    T.StructField("client_id", T.StringType(), False),
    T.StructField("revenue_share", RATE, True),
    T.StructField("commission_type", T.StringType(), True),
    T.StructField("loaded_at", TS, True),
])

# Control table of the high-water marks, one row per source.
WATERMARK = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("last_loaded_at", TS, False),
])

# Column order of the outputs (fixed by the models they mirror).
STG_PAYMENTS_COLUMNS = [
    "transaction_id", "transaction_timestamp", "transaction_date", "status", "amount", "type",
    "company_code", "provider_id", "client_id", "external_client_id", "loaded_at",
]
ENRICHED_COLUMNS = [
    "transaction_id", "transaction_date", "transaction_timestamp", "status", "amount",
    "provider_id", "biller_id", "client_id", "external_client_id", "commission_rate",
    "revenue_share", "gross_revenue", "client_payout", "net_revenue", "loaded_at",
]
FACT_COLUMNS = [
    "transaction_id", "transaction_date", "transaction_timestamp", "status", "amount",
    "gross_revenue", "client_payout", "net_revenue", "client_id", "provider_id", "biller_id",
    "external_client_id", "commission_rate", "revenue_share", "loaded_at",
]
FACT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("transaction_timestamp", TS),
    T.StructField("status", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("gross_revenue", ROW_KPI),
    T.StructField("client_payout", ROW_KPI),
    T.StructField("net_revenue", ROW_KPI),
    T.StructField("client_id", T.StringType()),
    T.StructField("provider_id", T.StringType()),
    T.StructField("biller_id", T.StringType()),
    T.StructField("external_client_id", T.StringType()),
    T.StructField("commission_rate", RATE),
    T.StructField("revenue_share", RATE),
    T.StructField("loaded_at", TS),
])
REPORT_SCHEMA = T.StructType([
    T.StructField("report_date", T.DateType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("provider_id", T.StringType()),
    T.StructField("total_transactions", T.LongType()),
    T.StructField("confirmed_transactions", T.LongType()),
    T.StructField("total_amount", SUM_MONEY),
    T.StructField("confirmed_amount", SUM_MONEY),
    T.StructField("gross_revenue", SUM_KPI),
    T.StructField("client_payout", SUM_KPI),
    T.StructField("net_revenue", SUM_KPI),
    T.StructField("confirmation_rate", RATIO),
])
REPORT_COLUMNS = [
    "report_date", "client_id", "provider_id", "total_transactions", "confirmed_transactions",
    "total_amount", "confirmed_amount", "gross_revenue", "client_payout", "net_revenue",
    "confirmation_rate",
]
PROVIDER_HISTORY_COLUMNS = [
    "provider_id", "biller_id", "commission_rate", "commission_type", "valid_from", "valid_to",
]
CLIENT_HISTORY_COLUMNS = ["client_id", "revenue_share", "commission_type", "valid_from", "valid_to"]

# Accepted domain values of the data-quality rules.
PAYMENT_STATUSES = ["confirmed", "pending", "rejected"]
INGESTED_TYPE = "recarga"
PROVIDER_COMMISSION_TYPE = "amount"
CLIENT_COMMISSION_TYPE = "revenue_share"
EPOCH = "1970-01-01 00:00:00"
