from decimal import Decimal

from revmart.plans.marts import daily_revenue
from revmart.schemas import REPORT_COLUMNS
from tests.conftest import D

FACT = ("transaction_date date, client_id string, provider_id string, status string, "
        "amount decimal(12,2), gross_revenue decimal(20,4), client_payout decimal(20,4), "
        "net_revenue decimal(20,4)")


def test_report_groups(spark):
    import datetime as dt
    d = dt.date(2025, 1, 1)
    rows = [
        (d, "C1", "P1", "confirmed", D("100.00"), D("5.0000"), D("3.0000"), D("2.0000")),
        (d, "C1", "P1", "pending", D("50.00"), D("0"), D("0"), D("0")),
        (d, "C1", "P1", "pending", D("50.00"), D("0"), D("0"), D("0")),
        (d, "C2", "P1", "pending", D("10.00"), D("0"), D("0"), D("0")),          # no confirmed
        (d, "C3", "P1", "confirmed", D("10.00"), None, None, None),               # NULL KPIs only
    ]
    out = {(r.client_id): r for r in daily_revenue(spark.createDataFrame(rows, FACT)).collect()}
    c1 = out["C1"]
    assert (c1.total_transactions, c1.confirmed_transactions) == (3, 1)
    assert c1.total_amount == Decimal("200.00") and c1.confirmed_amount == Decimal("100.00")
    assert c1.confirmation_rate == Decimal("0.3333")
    assert out["C2"].confirmed_amount is None and out["C2"].confirmation_rate == Decimal("0.0000")
    assert out["C3"].gross_revenue is None and out["C3"].confirmation_rate == Decimal("1.0000")
    assert daily_revenue(spark.createDataFrame(rows, FACT)).columns == REPORT_COLUMNS
