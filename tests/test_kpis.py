from decimal import Decimal

from revmart.functions.kpis import client_payout, gross_revenue, net_revenue
from tests.conftest import D

# Worked goldens: amount, commission, share, status -> gross, payout, net
GOLDENS = [
    ("100.00", "0.0500", "0.6000", "confirmed", "5.0000", "3.0000", "2.0000"),
    ("100.00", "0.0500", "0.6000", "pending", "0.0000", "0.0000", "0.0000"),
    ("150.55", "0.0485", "0.5500", "confirmed", "7.3017", "4.0159", "3.2858"),
    ("100.00", None, "0.6000", "confirmed", None, None, None),
    ("100.00", "0.0500", None, "confirmed", "5.0000", None, None),
    ("100.00", None, None, "rejected", "0.0000", "0.0000", "0.0000"),
    ("0.01", "0.0100", "0.5000", "confirmed", "0.0001", "0.0001", "0.0001"),
    ("100.00", "0.0500", "0.6000", None, "0.0000", "0.0000", "0.0000"),
]


def test_kpi_goldens(spark):
    rows = [(D(a), D(c) if c else None, D(r) if r else None, s) for a, c, r, s, *_ in GOLDENS]
    df = spark.createDataFrame(
        rows, "amount decimal(12,2), commission_rate decimal(5,4), revenue_share decimal(5,4), status string")
    out = df.select(gross_revenue().alias("g"), client_payout().alias("p"),
                    net_revenue().alias("n")).collect()
    for row, (*_, g, p, n) in zip(out, GOLDENS, strict=True):
        expect = [Decimal(x) if x is not None else None for x in (g, p, n)]
        assert [row.g, row.p, row.n] == expect


def test_kpi_types_are_stable(spark):
    df = spark.createDataFrame([(D("1.00"), D("0.1000"), D("0.5000"), "confirmed")],
                               "amount decimal(12,2), commission_rate decimal(5,4), "
                               "revenue_share decimal(5,4), status string")
    out = df.select(gross_revenue().alias("g"), net_revenue().alias("n"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["decimal(20,4)"] * 2


def test_net_rounds_separately(spark):
    # net is rounded from the unrounded product, not gross - payout
    df = spark.createDataFrame([(D("0.01"), D("0.0100"), D("0.5000"), "confirmed")],
                               "amount decimal(12,2), commission_rate decimal(5,4), "
                               "revenue_share decimal(5,4), status string")
    r = df.select(gross_revenue().alias("g"), client_payout().alias("p"),
                  net_revenue().alias("n")).first()
    assert r.g - r.p == Decimal("0.0000") and r.n == Decimal("0.0001")


def test_half_up_on_negative(spark):
    df = spark.createDataFrame([(D("-0.01"), D("0.0050"), D("0.0000"), "confirmed")],
                               "amount decimal(12,2), commission_rate decimal(5,4), "
                               "revenue_share decimal(5,4), status string")
    assert df.select(gross_revenue().alias("g")).first().g == Decimal("-0.0001")
