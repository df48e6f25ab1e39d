"""Property: the KPIs equal exact decimal arithmetic rounded half-up, for any inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from revmart.functions.kpis import client_payout, gross_revenue, net_revenue

amounts = st.integers(min_value=-10**12 + 1, max_value=10**12 - 1).map(lambda n: Decimal(n) / 100)
rates = st.one_of(st.none(), st.integers(min_value=0, max_value=9999).map(lambda n: Decimal(n) / 10000))
statuses = st.sampled_from(["confirmed", "pending", "rejected", None])
rows = st.lists(st.tuples(amounts, rates, rates, statuses), min_size=1, max_size=60)


def _expect(amount, c, r, status):
    if status != "confirmed":
        return (Decimal(0),) * 3
    q = Decimal("0.0001")

    def rnd(x):
        return None if x is None else x.quantize(q, rounding=ROUND_HALF_UP)
    gross = rnd(amount * c) if c is not None else None
    payout = rnd(amount * c * r) if c is not None and r is not None else None
    net = rnd(amount * c * (1 - r)) if c is not None and r is not None else None
    return gross, payout, net


@settings(max_examples=15, deadline=None)
@given(rows)
def test_kpis_match_exact_half_up(spark, data):
    df = spark.createDataFrame(data, "amount decimal(12,2), commission_rate decimal(5,4), "
                                     "revenue_share decimal(5,4), status string")
    got = df.select(gross_revenue().alias("g"), client_payout().alias("p"),
                    net_revenue().alias("n")).collect()
    for row, (a, c, r, s) in zip(got, data, strict=True):
        assert (row.g, row.p, row.n) == _expect(a, c, r, s)
