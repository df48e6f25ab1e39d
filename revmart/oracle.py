"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written from the rules, in other shapes than the Spark code: the winner of a
payment by ``arg_max`` over its ordering, point-in-time values by a join and
``arg_max`` per payment, money in whole units, the report from sums of
indicators, the quality rules listed by hand. Every output column is cast to
the type the Spark query produces.
"""

from __future__ import annotations

CTE_SOURCE = """
source_payments AS (
    SELECT CAST(l.l_orderkey AS VARCHAR) AS transaction_id,
           o.o_orderdate AS created_at,
           l.l_shipdate AS updated_at,
           CASE l.l_returnflag WHEN 'N' THEN 'confirmed' WHEN 'A' THEN 'pending'
                               WHEN 'R' THEN 'rejected' END AS status,
           CAST(l.l_extendedprice AS DECIMAL(12,2)) AS amount,
           CASE l.l_linestatus WHEN 'O' THEN 'recarga' WHEN 'F' THEN 'other' END AS "type",
           pt.p_brand AS company_code,
           'PROV_' || CAST(l.l_suppkey % 10 AS VARCHAR) AS external_provider_id,
           'CLIENT_' || CAST(c.c_nationkey AS VARCHAR) AS client_id,
           'USER_' || CAST(o.o_custkey AS VARCHAR) AS external_client_id,
           l.l_shipdate + to_hours(CAST(l.l_linenumber AS BIGINT)) AS fixture_loaded_at,
           l.l_suppkey, l.l_partkey
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part pt ON l.l_partkey = pt.p_partkey
    JOIN customer c ON o.o_custkey = c.c_custkey
),
raw_payments AS (
    SELECT * EXCLUDE (fixture_loaded_at), fixture_loaded_at AS loaded_at
    FROM source_payments WHERE "type" = 'recarga'
)"""

def stg_cte(name: str = "stg_payments", source: str = "raw_payments") -> str:
    """The winner per payment: newest update, then newest load (an unknown one first), then the tiebreak."""
    return f"""
{name}_won AS (
    SELECT arg_max(r, row(coalesce(r.updated_at, TIMESTAMP '0001-01-01 00:00:00'),
                          coalesce(r.loaded_at, TIMESTAMP '9999-01-01 00:00:00'),
                          coalesce(r.l_suppkey, -1), coalesce(r.l_partkey, -1))) AS w
    FROM {source} r GROUP BY r.transaction_id
),
{name} AS (
    SELECT w.transaction_id AS transaction_id, w.created_at AS transaction_timestamp,
           w.created_at::DATE AS transaction_date, w.status AS status, w.amount::DECIMAL(12,2) AS amount,
           w."type" AS "type", w.company_code AS company_code, w.external_provider_id AS provider_id,
           w.client_id AS client_id, w.external_client_id AS external_client_id, w.loaded_at AS loaded_at
    FROM {name}_won
)"""


CTE_STG = stg_cte()

CTE_SNAPSHOTS = """
runs AS (
    SELECT * FROM (VALUES (0, TIMESTAMP '1996-01-01 00:00:00'),
                          (1, TIMESTAMP '1998-01-01 00:00:00'),
                          (2, TIMESTAMP '2000-01-01 00:00:00')) r(e, run_ts)
),
brands AS (
    SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS b
    FROM (SELECT DISTINCT p_brand FROM part) x
),
provider_snapshots AS (
    SELECT 'PROV_' || CAST(p AS VARCHAR) AS provider_id, p_brand AS biller_id,
           CAST((400 + (7 * p + 3 * b + 5 * (CASE WHEN (p + b) % 3 = 0 THEN 0 ELSE e END)) % 200)
                * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(5,4)) AS commission_rate,
           'amount' AS commission_type, run_ts
    FROM brands CROSS JOIN (SELECT range AS p FROM range(10)) ps CROSS JOIN runs
    WHERE (p + b) % 11 <> 0 AND NOT (e = 2 AND (p + b) % 7 = 0)
),
client_snapshots AS (
    SELECT 'CLIENT_' || CAST(n_nationkey AS VARCHAR) AS client_id,
           CAST((5000 + (137 * n_nationkey + 250 * (CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE e END)) % 2000)
                * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(5,4)) AS revenue_share,
           'revenue_share' AS commission_type, run_ts
    FROM nation CROSS JOIN runs
    WHERE n_nationkey <> 24
),
provider_history AS (
    SELECT provider_id, biller_id, commission_rate, commission_type, run_ts AS valid_from,
           lead(run_ts) OVER (PARTITION BY provider_id, biller_id ORDER BY run_ts) AS valid_to
    FROM (SELECT *, lag(commission_rate) OVER w AS prev_rate, lag(commission_type) OVER w AS prev_type,
                 row_number() OVER w AS k
          FROM provider_snapshots
          WINDOW w AS (PARTITION BY provider_id, biller_id ORDER BY run_ts)) s
    WHERE k = 1 OR prev_rate IS DISTINCT FROM commission_rate
          OR prev_type IS DISTINCT FROM commission_type
),
client_history AS (
    SELECT client_id, revenue_share, commission_type, run_ts AS valid_from,
           lead(run_ts) OVER (PARTITION BY client_id ORDER BY run_ts) AS valid_to
    FROM (SELECT *, lag(revenue_share) OVER w AS prev_share, lag(commission_type) OVER w AS prev_type,
                 row_number() OVER w AS k
          FROM client_snapshots
          WINDOW w AS (PARTITION BY client_id ORDER BY run_ts)) s
    WHERE k = 1 OR prev_share IS DISTINCT FROM revenue_share
          OR prev_type IS DISTINCT FROM commission_type
)"""

PROVIDER_KEYS = {"provider_id": "provider_id", "biller_id": "company_code"}
CLIENT_KEYS = {"client_id": "client_id"}


def lookup_cte(name: str, stg: str, history: str, keys: dict[str, str], value: str) -> str:
    """Per payment: the value in force at its time, else that of the open row (latest start first)."""
    on = " AND ".join(f"h.{k} = s.{c}" for k, c in keys.items())
    inside = "h.valid_from <= s.transaction_timestamp AND s.transaction_timestamp < coalesce(h.valid_to, 'infinity')"
    return f"""
{name} AS (
    SELECT s.transaction_id,
           coalesce(arg_max(h.{value}, h.valid_from) FILTER (WHERE {inside}),
                    arg_max(h.{value}, h.valid_from) FILTER (WHERE h.valid_to IS NULL))::DECIMAL(5,4) AS {value}
    FROM {stg} s JOIN {history} h ON {on}
    GROUP BY s.transaction_id
)"""


def enriched_cte(stg: str = "stg_payments", name: str = "enriched",
                 provider_history: str = "provider_history",
                 client_history: str = "client_history") -> str:
    """Amounts in cents and rates in ten-thousandths: products are whole numbers, rounded half up by division."""
    return f"""{lookup_cte(f"{name}_rate", stg, provider_history, PROVIDER_KEYS, "commission_rate")},
{lookup_cte(f"{name}_share", stg, client_history, CLIENT_KEYS, "revenue_share")},
{name}_units AS (
    SELECT s.*, commission_rate, revenue_share, (status IS NOT DISTINCT FROM 'confirmed')::INT AS is_confirmed,
           (amount * 100)::BIGINT * (commission_rate * 10000)::BIGINT AS gross_e6,
           (revenue_share * 10000)::BIGINT AS share_e4
    FROM {stg} s LEFT JOIN {name}_rate USING (transaction_id) LEFT JOIN {name}_share USING (transaction_id)
),
{name}_whole AS (
    SELECT *, CASE is_confirmed WHEN 0 THEN 0 ELSE (gross_e6 + 50) // 100 END AS gross_e4,
           CASE is_confirmed WHEN 0 THEN 0 ELSE (gross_e6 * share_e4 + 500000) // 1000000 END AS payout_e4,
           CASE is_confirmed WHEN 0 THEN 0 ELSE (gross_e6 * (10000 - share_e4) + 500000) // 1000000 END AS net_e4
    FROM {name}_units
),
{name} AS (
    SELECT transaction_id, transaction_date, transaction_timestamp, status, amount, provider_id,
           company_code AS biller_id, client_id, external_client_id, commission_rate, revenue_share,
           (gross_e4 * 0.0001::DECIMAL(5,4))::DECIMAL(20,4) AS gross_revenue,
           (payout_e4 * 0.0001::DECIMAL(5,4))::DECIMAL(20,4) AS client_payout,
           (net_e4 * 0.0001::DECIMAL(5,4))::DECIMAL(20,4) AS net_revenue, loaded_at
    FROM {name}_whole
)"""


def report_select(fact: str) -> str:
    """Sums of per-row indicators and of confirmed amounts, then the ratio in ten-thousandths."""
    return f"""
SELECT day AS report_date, client AS client_id, provider AS provider_id, n AS total_transactions,
       good AS confirmed_transactions, total::DECIMAL(38,2) AS total_amount,
       good_total::DECIMAL(38,2) AS confirmed_amount, gross::DECIMAL(38,4) AS gross_revenue,
       payout::DECIMAL(38,4) AS client_payout, net::DECIMAL(38,4) AS net_revenue,
       (((20000 * good + n) // (2 * n))::DECIMAL(20,0) * 0.0001)::DECIMAL(10,4) AS confirmation_rate
FROM (
    SELECT day, client, provider, sum(1)::BIGINT AS n, sum(hit)::BIGINT AS good, sum(amount) AS total,
           sum(amount * nullif(hit, 0)) AS good_total, sum(gross) AS gross, sum(payout) AS payout, sum(net) AS net
    FROM (SELECT transaction_date AS day, client_id AS client, provider_id AS provider, amount,
                 coalesce((status = 'confirmed')::INT, 0) AS hit, gross_revenue AS gross,
                 client_payout AS payout, net_revenue AS net FROM {fact}) marked
    GROUP BY ALL
) summed"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


PIPE = (CTE_SOURCE, CTE_STG, CTE_SNAPSHOTS)

ORACLE: dict[str, str] = {
    "latest_payments": _with(CTE_SOURCE, CTE_STG) + "\nSELECT * FROM stg_payments",
    "scd2_providers": _with(CTE_SNAPSHOTS) + "\nSELECT * FROM provider_history",
    "scd2_clients": _with(CTE_SNAPSHOTS) + "\nSELECT * FROM client_history",
    "dim_providers_current": _with(CTE_SNAPSHOTS) + """
SELECT provider_id, biller_id, commission_rate, commission_type, valid_from
FROM provider_history WHERE valid_to IS NULL""",
    "dim_clients_current": _with(CTE_SNAPSHOTS) + """
SELECT client_id, revenue_share, commission_type, valid_from
FROM client_history WHERE valid_to IS NULL""",
    "interval_lookup_providers": _with(
        *PIPE, lookup_cte("rate", "stg_payments", "provider_history", PROVIDER_KEYS, "commission_rate")) + """
SELECT transaction_id, transaction_timestamp, provider_id, company_code AS biller_id, commission_rate
FROM stg_payments LEFT JOIN rate USING (transaction_id)""",
    "interval_lookup_clients": _with(
        *PIPE, lookup_cte("share", "stg_payments", "client_history", CLIENT_KEYS, "revenue_share")) + """
SELECT transaction_id, transaction_timestamp, client_id, revenue_share
FROM stg_payments LEFT JOIN share USING (transaction_id)""",
    "payments_enriched": _with(*PIPE, enriched_cte()) + "\nSELECT * FROM enriched",
    "daily_revenue": _with(*PIPE, enriched_cte()) + report_select("enriched"),
}


# Rates of every supplier x part and of every customer: the same rules on other keys.
CTE_LARGE = """
large_raw AS (
    SELECT * REPLACE ('SUPP_' || l_suppkey::VARCHAR AS external_provider_id, 'PART_' || l_partkey::VARCHAR AS company_code,
                      'CUST_' || substr(external_client_id, 6) AS client_id)
    FROM raw_payments
),
large_pairs AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE (l_suppkey + l_partkey) % 11 <> 0),
large_provider_marks AS (
    SELECT 'SUPP_' || s::VARCHAR AS provider_id, 'PART_' || p::VARCHAR AS biller_id,
           (400 + (7 * s + 3 * p + CASE WHEN (s + p) % 3 = 0 THEN 0 ELSE 5 * e END) % 200)::BIGINT AS units, run_ts
    FROM large_pairs CROSS JOIN runs WHERE e <> 2 OR (s + p) % 7 <> 0
),
large_provider_history AS (
    SELECT provider_id, biller_id, (min(units) * 0.0001::DECIMAL(5,4))::DECIMAL(5,4) AS commission_rate,
           'amount' AS commission_type, min(run_ts) AS valid_from,
           lead(min(run_ts)) OVER (PARTITION BY provider_id, biller_id ORDER BY min(run_ts)) AS valid_to
    FROM large_provider_marks GROUP BY provider_id, biller_id, units
),
large_client_marks AS (
    SELECT 'CUST_' || c_custkey::VARCHAR AS client_id,
           (5000 + (137 * c_custkey + CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 250 * e END) % 2000)::BIGINT AS units, run_ts
    FROM customer CROSS JOIN runs WHERE c_custkey % 25 <> 24
),
large_client_history AS (
    SELECT client_id, (min(units) * 0.0001::DECIMAL(5,4))::DECIMAL(5,4) AS revenue_share,
           'revenue_share' AS commission_type, min(run_ts) AS valid_from,
           lead(min(run_ts)) OVER (PARTITION BY client_id ORDER BY min(run_ts)) AS valid_to
    FROM large_client_marks GROUP BY client_id, units
)"""
LARGE_PIPE = (CTE_SOURCE, CTE_SNAPSHOTS, CTE_LARGE, stg_cte("large_stg", "large_raw"))

ORACLE["scd2_large"] = _with(CTE_SNAPSHOTS, CTE_SOURCE, CTE_LARGE) + "\nSELECT * FROM large_provider_history"
ORACLE["interval_lookup_large"] = _with(
    *LARGE_PIPE, lookup_cte("rate", "large_stg", "large_provider_history", PROVIDER_KEYS, "commission_rate"),
    lookup_cte("share", "large_stg", "large_client_history", CLIENT_KEYS, "revenue_share")) + """
SELECT transaction_id, transaction_timestamp, provider_id, company_code AS biller_id, client_id, commission_rate,
       revenue_share
FROM large_stg LEFT JOIN rate USING (transaction_id) LEFT JOIN share USING (transaction_id)"""
ORACLE["payments_enriched_large"] = _with(
    *LARGE_PIPE, enriched_cte("large_stg", "large_enriched", "large_provider_history", "large_client_history")) + """
SELECT * FROM large_enriched"""

# ---- extract-load ----------------------------------------------------------

SOURCE_COLS = ("transaction_id, created_at, updated_at, status, amount, \"type\", company_code, "
               "external_provider_id, client_id, external_client_id")
RUN1, RUN2 = "TIMESTAMP '1998-07-01 00:00:00'", "TIMESTAMP '2010-01-01 00:00:00'"

CTE_INGEST = f"""
run1 AS (
    SELECT {SOURCE_COLS}, {RUN1} AS loaded_at FROM source_payments
    WHERE "type" = 'recarga' AND updated_at > TIMESTAMP '1970-01-01 00:00:00' AND updated_at <= {RUN1}
),
run2 AS (
    SELECT {SOURCE_COLS}, {RUN2} AS loaded_at FROM source_payments
    WHERE "type" = 'recarga' AND updated_at > (SELECT max(updated_at) FROM run1)
)"""

EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
EV1, EV2 = "TIMESTAMP '2024-01-15 00:00:00'", "TIMESTAMP '2024-03-01 00:00:00'"

ORACLE["incremental_extract"] = _with(CTE_SOURCE, CTE_INGEST) + """
SELECT * FROM run1 UNION ALL SELECT * FROM run2"""

# A pair (id, update) that the first run loaded is not loaded again; late pending rows of the window are.
ORACLE["incremental_extract_lookback"] = _with(CTE_SOURCE, f"""
run1 AS (
    SELECT {SOURCE_COLS}, {RUN1} AS loaded_at FROM source_payments
    WHERE "type" = 'recarga' AND updated_at > TIMESTAMP '1970-01-01 00:00:00' AND updated_at <= {RUN1}
      AND NOT (status = 'pending' AND updated_at > TIMESTAMP '1998-05-01 00:00:00')
)""") + f"""
SELECT * FROM run1
UNION ALL
SELECT {SOURCE_COLS}, {RUN2} AS loaded_at FROM source_payments s
WHERE "type" = 'recarga' AND updated_at > (SELECT max(updated_at) - INTERVAL 90 DAY FROM run1)
  AND (transaction_id, updated_at) NOT IN (SELECT (transaction_id, updated_at) FROM run1)"""

ORACLE["ingest_row_counts"] = _with(CTE_SOURCE, CTE_INGEST) + """
SELECT 1 AS run, count(*) AS rows_loaded, TIMESTAMP '1970-01-01 00:00:00' AS previous_mark, max(updated_at) AS new_mark
FROM run1
UNION ALL
SELECT 2, count(*), (SELECT max(updated_at) FROM run1), max(updated_at) FROM run2"""

ORACLE["next_watermark"] = _with(CTE_SOURCE, CTE_INGEST) + """
SELECT 'process_payments' AS table_name, max(updated_at) AS last_loaded_at
FROM (SELECT updated_at FROM run1 UNION ALL SELECT updated_at FROM run2) r"""

ORACLE["events_incremental_extract"] = f"""
WITH e1 AS (SELECT {EVENT_COLS}, {EV1} AS loaded_at FROM events
            WHERE ts > TIMESTAMP '1970-01-01 00:00:00' AND ts <= {EV1}),
     e2 AS (SELECT {EVENT_COLS}, {EV2} AS loaded_at FROM events
            WHERE ts > (SELECT max(ts) FROM e1))
SELECT * FROM e1 UNION ALL SELECT * FROM e2"""

ORACLE["dimension_extract_providers"] = _with(CTE_SNAPSHOTS) + """
SELECT provider_id AS external_provider_id, biller_id AS company_code, commission_rate,
       commission_type, run_ts AS loaded_at
FROM provider_snapshots WHERE run_ts = TIMESTAMP '2000-01-01 00:00:00' AND commission_type = 'amount'"""

ORACLE["dimension_extract_clients"] = _with(CTE_SNAPSHOTS) + """
SELECT client_id, revenue_share, commission_type, run_ts AS loaded_at
FROM client_snapshots WHERE run_ts = TIMESTAMP '2000-01-01 00:00:00'
  AND commission_type = 'revenue_share'"""

ORACLE["latest_event_per_user"] = """
SELECT w.event_id, w.ts, w.user_id, w.event_type, w.value, w.props
FROM (SELECT arg_max(e, row(e.ts, e.event_id)) AS w FROM events e GROUP BY e.user_id)"""

# ---- fact ------------------------------------------------------------------

FACT_COLS = ("transaction_id, transaction_date, transaction_timestamp, status, amount, gross_revenue, "
             "client_payout, net_revenue, client_id, provider_id, biller_id, external_client_id, "
             "commission_rate, revenue_share, loaded_at")

ORACLE["fact_full"] = _with(*PIPE, enriched_cte()) + f"\nSELECT {FACT_COLS} FROM enriched"

ORACLE["fact_incremental_upsert"] = _with(
    CTE_SOURCE, CTE_SNAPSHOTS,
    """
raw_first AS (SELECT * FROM raw_payments WHERE loaded_at < TIMESTAMP '1998-01-01 00:00:00')""",
    stg_cte("stg_first", "raw_first"), enriched_cte("stg_first", "enriched_first"),
    f"""
fact_first AS (SELECT {FACT_COLS} FROM enriched_first)""",
    CTE_STG, enriched_cte(),
    f"""
delta AS (
    SELECT {FACT_COLS} FROM enriched
    WHERE loaded_at > (SELECT coalesce(max(loaded_at), TIMESTAMP '1970-01-01 00:00:00') FROM fact_first)
)""") + """
SELECT * FROM fact_first f WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.transaction_id = f.transaction_id)
UNION ALL
SELECT * FROM delta"""

# Three runs; a run's delta is the winners of all raw rows so far that were loaded after the fact's newest row.
def _hot_run(k: int, upto: str) -> tuple[str, ...]:
    previous = f"hot_fact{k - 1}" if k > 1 else "(SELECT * FROM enriched WHERE false)"
    return (f"""
hot_raw{k} AS (SELECT * FROM hot_raw WHERE {upto})""",
            stg_cte(f"hot_stg{k}", f"hot_raw{k}").replace("coalesce(r.l_partkey, -1))", "coalesce(r.l_partkey, -1), r.l_orderkey)"),
            enriched_cte(f"hot_stg{k}", f"hot_enriched{k}"), f"""
hot_delta{k} AS (
    SELECT * FROM hot_enriched{k}
    WHERE loaded_at > (SELECT coalesce(max(loaded_at), TIMESTAMP '1970-01-01 00:00:00') FROM {previous})
),
hot_fact{k} AS (
    SELECT * FROM {previous} WHERE transaction_id NOT IN (SELECT transaction_id FROM hot_delta{k})
    UNION ALL SELECT * FROM hot_delta{k}
)""")


HOT_PIPE = _with(*PIPE, enriched_cte(), """
hot_raw AS (
    SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 'hot' ELSE transaction_id END AS transaction_id),
           transaction_id::BIGINT AS l_orderkey
    FROM raw_payments
)""", *_hot_run(1, "loaded_at <= TIMESTAMP '1998-01-01 00:00:00'"), *_hot_run(2, "loaded_at <= TIMESTAMP '1999-06-01 00:00:00'"),
    *_hot_run(3, "true"))
ORACLE["fact_incremental_hot_payment"] = ORACLE["fact_ledger"] = HOT_PIPE + f"\nSELECT {FACT_COLS} FROM hot_fact3"
ORACLE["daily_revenue_retraction"] = HOT_PIPE + report_select("hot_fact3")

# ---- OLTP-side writes ----------------------------------------------------------

OLTP_FIELDS = ", ".join(f"w.{c.strip()} AS {c.strip()}" for c in SOURCE_COLS.split(","))

CTE_OLTP = f"""
oltp_won AS (
    SELECT arg_max(s, row(s.updated_at, s.fixture_loaded_at, s.l_suppkey, s.l_partkey)) AS w
    FROM source_payments s GROUP BY s.transaction_id
),
oltp AS (SELECT {OLTP_FIELDS} FROM oltp_won),
chosen AS (
    SELECT transaction_id FROM oltp WHERE status = 'pending'
    ORDER BY created_at DESC NULLS LAST, transaction_id DESC NULLS LAST LIMIT 100
)"""

ORACLE["insert_if_absent"] = _with(CTE_SOURCE, CTE_OLTP, f"""
existing AS (SELECT * FROM oltp WHERE created_at < TIMESTAMP '1998-01-01 00:00:00'),
first_won AS (
    SELECT arg_min(s, row(s.updated_at, s.fixture_loaded_at, s.l_suppkey, s.l_partkey)) AS w
    FROM source_payments s GROUP BY s.transaction_id
),
incoming AS (SELECT {OLTP_FIELDS} FROM first_won)""") + """
SELECT * FROM existing
UNION ALL
SELECT * FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.transaction_id = i.transaction_id)"""

ORACLE["topk_update"] = _with(CTE_SOURCE, CTE_OLTP) + """
SELECT transaction_id, created_at,
       CASE WHEN transaction_id IN (SELECT transaction_id FROM chosen)
            THEN TIMESTAMP '2010-01-01 00:00:00' ELSE updated_at END AS updated_at,
       CASE WHEN transaction_id IN (SELECT transaction_id FROM chosen)
            THEN 'confirmed' ELSE status END AS status,
       amount, "type", company_code, external_provider_id, client_id, external_client_id
FROM oltp"""

ORACLE["topk_update_many"] = ORACLE["topk_update"].replace("LIMIT 100", "LIMIT 1000")
ORACLE["insert_few_if_absent"] = _with(CTE_SOURCE, CTE_OLTP) + """
SELECT * REPLACE (CASE WHEN created_at < TIMESTAMP '1998-07-01 00:00:00' THEN amount
                       ELSE (amount + 1)::DECIMAL(12,2) END AS amount)
FROM oltp WHERE created_at IS NOT NULL"""

ORACLE["semi_join_topk"] = _with(CTE_SOURCE, CTE_OLTP) + """
SELECT * FROM oltp WHERE transaction_id IN (SELECT transaction_id FROM chosen)"""

# ---- data quality ------------------------------------------------------------

CTE_DQ_TABLES = """
fact_payments AS (SELECT * FROM enriched),
daily_revenue AS (""" + report_select("enriched") + """),
raw_providers AS (
    SELECT provider_id AS external_provider_id, biller_id AS company_code, commission_rate, commission_type
    FROM provider_snapshots WHERE run_ts = TIMESTAMP '2000-01-01 00:00:00'),
raw_clients AS (
    SELECT client_id, revenue_share, commission_type
    FROM client_snapshots WHERE run_ts = TIMESTAMP '2000-01-01 00:00:00'),
payments_enriched AS (SELECT * FROM enriched)"""

DQ_PIPE = (*PIPE, enriched_cte(), CTE_DQ_TABLES)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _q(name: str) -> str:
    return name if name != "type" else '"type"'


#: (table, column) of the not_null rules
DQ_NOT_NULL = """
raw_payments transaction_id, raw_payments created_at, raw_payments status, raw_payments amount, raw_payments type,
raw_providers external_provider_id, raw_providers company_code, raw_providers commission_rate,
raw_providers commission_type, raw_clients client_id, raw_clients revenue_share, raw_clients commission_type,
payments_enriched transaction_id, payments_enriched gross_revenue, payments_enriched client_payout,
payments_enriched net_revenue, fact_payments transaction_id, fact_payments status, fact_payments amount,
fact_payments gross_revenue, fact_payments client_payout, fact_payments net_revenue,
daily_revenue report_date, daily_revenue client_id, daily_revenue provider_id"""

DQ_ACCEPTED = [
    ("source_payments", "type", "'recarga'"),
    ("raw_payments", "status", "'pending', 'confirmed', 'rejected'"),
    ("raw_payments", "type", "'recarga'"),
    ("raw_providers", "commission_type", "'amount'"),
    ("raw_clients", "commission_type", "'revenue_share'"),
    ("fact_payments", "status", "'pending', 'confirmed', 'rejected'"),
]

DQ_UNIQUE = [
    ("raw_payments", "transaction_id"), ("stg_payments", "transaction_id"),
    ("payments_enriched", "transaction_id"), ("fact_payments", "transaction_id"),
    ("raw_clients", "client_id"), ("raw_providers", "external_provider_id,company_code"),
]

DQ_LENGTHS = [
    ("transaction_id", 64), ("status", 20), ("type", 30), ("company_code", 50),
    ("external_provider_id", 50), ("client_id", 50), ("external_client_id", 50),
]


def _dq_row(table: str, column: str, rule: str, failures: str, rows: str, source: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
            f"{failures}::BIGINT AS failures, {rows}::BIGINT AS failing_rows FROM {source}")


def _dq_not_null() -> str:
    pairs = [p.split() for p in DQ_NOT_NULL.split(",")]
    return _union([_dq_row(t, c, "not_null", f"(count(*) - count({_q(c)}))", f"(count(*) - count({_q(c)}))", t)
                   for t, c in pairs])


def _dq_accepted() -> str:
    return _union([_dq_row(t, c, "accepted_values", "count(DISTINCT bad)", "count(bad)",
                           f"(SELECT CASE WHEN {_q(c)} IN ({v}) THEN NULL ELSE {_q(c)} END AS bad FROM {t})")
                   for t, c, v in DQ_ACCEPTED])


def _dq_unique() -> str:
    return _union([_dq_row(t, k, "unique", "count(*)", "coalesce(sum(n), 0)",
                           f"(SELECT count(*) AS n FROM {t} WHERE (row({k}) IS NOT NULL) AND "
                           + " AND ".join(f"{c} IS NOT NULL" for c in k.split(","))
                           + f" GROUP BY {k} HAVING n > 1)")
                   for t, k in DQ_UNIQUE])


def _dq_lengths() -> str:
    return _union([_dq_row("raw_payments", c, "max_length", f"coalesce(sum((length({_q(c)}) > {n})::INT), 0)",
                           f"coalesce(sum((length({_q(c)}) > {n})::INT), 0)", "raw_payments") for c, n in DQ_LENGTHS])


def _dq_scd2(table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    per_key = f"""(SELECT {k}, count(*) FILTER (WHERE valid_to IS NULL) AS open_rows,
            count(*) FILTER (WHERE nxt IS NOT NULL AND (valid_to IS NULL OR valid_to > nxt)) AS n_overlaps
     FROM (SELECT *, lead(valid_from) OVER (PARTITION BY {k}
                                           ORDER BY valid_from, valid_to NULLS LAST) AS nxt
           FROM {table}) x GROUP BY {k})"""
    col = ",".join(keys)
    return _union([
        f"SELECT '{table}' AS table_name, '{col}' AS column_name, 'scd2_no_overlap' AS rule, "
        f"count(*) FILTER (WHERE n_overlaps > 0) AS failures, "
        f"CAST(coalesce(sum(n_overlaps), 0) AS BIGINT) AS failing_rows FROM {per_key} a",
        f"SELECT '{table}' AS table_name, '{col}' AS column_name, 'scd2_single_open_row' AS rule, "
        f"count(*) FILTER (WHERE open_rows > 1) AS failures, "
        f"CAST(coalesce(sum(open_rows) FILTER (WHERE open_rows > 1), 0) AS BIGINT) AS failing_rows "
        f"FROM {per_key} b",
    ])


ORACLE["dq_not_null"] = _with(*DQ_PIPE) + "\n" + _dq_not_null()
ORACLE["dq_accepted_values"] = _with(*DQ_PIPE) + "\n" + _dq_accepted()
ORACLE["dq_unique"] = _with(*DQ_PIPE) + "\n" + _dq_unique()
ORACLE["dq_max_length"] = _with(CTE_SOURCE) + "\n" + _dq_lengths()
ORACLE["dq_scd2_overlap"] = _with(CTE_SNAPSHOTS) + "\n" + _union([
    _dq_scd2("provider_history", ["provider_id", "biller_id"]),
    _dq_scd2("client_history", ["client_id"])])
ORACLE["dq_confirmation_rate_range"] = _with(*PIPE, enriched_cte(), """
daily_revenue AS (""" + report_select("enriched") + ")") + """
SELECT 'daily_revenue' AS table_name, 'confirmation_rate' AS column_name, 'range' AS rule,
       count(*) FILTER (WHERE confirmation_rate IS NOT NULL AND NOT (confirmation_rate BETWEEN 0 AND 1))
           AS failures,
       count(*) FILTER (WHERE confirmation_rate IS NOT NULL AND NOT (confirmation_rate BETWEEN 0 AND 1))
           AS failing_rows
FROM daily_revenue"""

# ---- streaming ingest ----------------------------------------------------------

ORACLE["stream_ingest"] = _with(
    CTE_SOURCE, CTE_SNAPSHOTS, f"""
raw_stream AS (
    SELECT {SOURCE_COLS}, l_suppkey, l_partkey,
           CASE WHEN updated_at <= {RUN1} THEN {RUN1} ELSE {RUN2} END AS loaded_at
    FROM source_payments WHERE "type" = 'recarga'
)""", stg_cte("stg_stream", "raw_stream"), enriched_cte("stg_stream", "enriched_stream")) + f"""
SELECT {FACT_COLS} FROM enriched_stream"""

ORACLE["fact_incremental_partitioned"] = ORACLE["fact_incremental_upsert"]

ORACLE["daily_revenue_incremental"] = (
    ORACLE["fact_incremental_upsert"].replace(
        "\nSELECT * FROM fact_first f WHERE NOT EXISTS",
        ",\nfinal_fact AS (\nSELECT * FROM fact_first f WHERE NOT EXISTS", 1)
    + "\n)" + report_select("final_fact"))

ORACLE["stream_latest_event_per_user"] = ORACLE["latest_event_per_user"]


# ---- two whole warehouse runs ----------------------------------------------------

def _scd2_second_run(s0: str, s2: str, keys: list[str], value: str) -> str:
    """History after snapshot runs at RUN1 (snapshot s0) and RUN2 (snapshot s2)."""
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    a_cols = ", ".join(f"a.{c}" for c in keys + [value, "commission_type"])
    b_cols = ", ".join(f"b.{c}" for c in keys + [value, "commission_type"])
    differs = (f"(b.{value} IS DISTINCT FROM a.{value} "
               f"OR b.commission_type IS DISTINCT FROM a.commission_type)")
    return f"""
    SELECT {a_cols}, {RUN1} AS valid_from,
           CASE WHEN b.{keys[0]} IS NOT NULL AND {differs} THEN {RUN2} END AS valid_to
    FROM {s0} a LEFT JOIN {s2} b ON {on}
    UNION ALL
    SELECT {b_cols}, {RUN2} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
    FROM {s2} b LEFT JOIN {s0} a ON {on}
    WHERE a.{keys[0]} IS NULL OR {differs}"""


_W_FIRST = "TIMESTAMP '1996-01-01 00:00:00'"
_W_LAST = "TIMESTAMP '2000-01-01 00:00:00'"

CTE_WAREHOUSE = f"""
wraw1 AS (
    SELECT {SOURCE_COLS}, l_suppkey, l_partkey, {RUN1} AS loaded_at FROM source_payments
    WHERE "type" = 'recarga' AND updated_at > TIMESTAMP '1970-01-01 00:00:00' AND updated_at <= {RUN1}
),
wraw_all AS (
    SELECT * FROM wraw1
    UNION ALL
    SELECT {SOURCE_COLS}, l_suppkey, l_partkey, {RUN2} AS loaded_at FROM source_payments
    WHERE "type" = 'recarga' AND updated_at > (SELECT max(updated_at) FROM wraw1)
),
psnap0 AS (SELECT provider_id, biller_id, commission_rate, commission_type
           FROM provider_snapshots WHERE run_ts = {_W_FIRST}),
psnap2 AS (SELECT provider_id, biller_id, commission_rate, commission_type
           FROM provider_snapshots WHERE run_ts = {_W_LAST}),
csnap0 AS (SELECT client_id, revenue_share, commission_type
           FROM client_snapshots WHERE run_ts = {_W_FIRST}),
csnap2 AS (SELECT client_id, revenue_share, commission_type
           FROM client_snapshots WHERE run_ts = {_W_LAST}),
ph1 AS (SELECT *, {RUN1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM psnap0),
ch1 AS (SELECT *, {RUN1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM csnap0),
ph2 AS ({_scd2_second_run("psnap0", "psnap2", ["provider_id", "biller_id"], "commission_rate")}),
ch2 AS ({_scd2_second_run("csnap0", "csnap2", ["client_id"], "revenue_share")})"""

ORACLE["warehouse_daily_revenue"] = _with(
    CTE_SOURCE, CTE_SNAPSHOTS, CTE_WAREHOUSE,
    stg_cte("wstg1", "wraw1"), enriched_cte("wstg1", "wenr1", "ph1", "ch1"),
    f"""
wfact1 AS (SELECT {FACT_COLS} FROM wenr1)""",
    stg_cte("wstg2", "wraw_all"), enriched_cte("wstg2", "wenr2", "ph2", "ch2"),
    f"""
wdelta AS (
    SELECT {FACT_COLS} FROM wenr2
    WHERE loaded_at > (SELECT coalesce(max(loaded_at), TIMESTAMP '1970-01-01 00:00:00') FROM wfact1)
),
wfact2 AS (
    SELECT * FROM wfact1 f WHERE NOT EXISTS (SELECT 1 FROM wdelta d WHERE d.transaction_id = f.transaction_id)
    UNION ALL
    SELECT * FROM wdelta
)""") + report_select("wfact2")


# With unchanging rates every incremental path ends where a full build does.
ORACLE["daily_revenue_after_missed_report"] = ORACLE["daily_revenue"]

ORACLE["fact_upsert_null_partition"] = _with(CTE_SOURCE, CTE_STG) + """
SELECT transaction_id, status, client_id,
       CASE WHEN status = 'confirmed' THEN amount + 1 ELSE amount END::DECIMAL(12,2) AS amount,
       CASE WHEN client_id <> 'CLIENT_7' THEN strftime(transaction_date, '%Y-%m') END AS month
FROM stg_payments"""
