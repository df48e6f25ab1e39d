"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from revmart.functions.columns import hours_after, ts_lit
from revmart.functions.kpis import client_payout, gross_revenue, net_revenue, safe_ratio

__all__ = ["client_payout", "gross_revenue", "hours_after", "net_revenue", "safe_ratio", "ts_lit"]
