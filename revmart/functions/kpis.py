"""Revenue KPIs of one payment, in exact decimals.

Each KPI is rounded on its own from the unrounded product, so net revenue
may differ from gross minus payout in the last digit. Only confirmed
payments earn revenue; any other status (NULL included) gives 0, while a
confirmed payment without a rate gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revmart.schemas import ROW_KPI

# Fixed value: the only status that earns revenue.
CONFIRMED = "confirmed"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _confirmed_only(status: Column, value: Column) -> Column:
    return F.when(status == F.lit(CONFIRMED), value).otherwise(F.lit(0)).cast(ROW_KPI)


def gross_revenue(status="status", amount="amount", commission="commission_rate") -> Column:
    return _confirmed_only(_col(status), F.round(_col(amount) * _col(commission), 4))


def client_payout(status="status", amount="amount", commission="commission_rate",
                  share="revenue_share") -> Column:
    return _confirmed_only(_col(status), F.round(_col(amount) * _col(commission) * _col(share), 4))


def net_revenue(status="status", amount="amount", commission="commission_rate",
                share="revenue_share") -> Column:
    return _confirmed_only(
        _col(status), F.round(_col(amount) * _col(commission) * (F.lit(1) - _col(share)), 4))


def safe_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """``round(n / nullif(d, 0), digits)`` on exact decimals (NULL when d = 0)."""
    return F.round(numerator.cast("decimal(20,0)") / F.nullif(denominator, F.lit(0)), digits)
