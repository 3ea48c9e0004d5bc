from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from regiostat.functions.decimals import exact_mean


def ref(s: Decimal, n: int) -> Decimal:
    q = abs(s) / Decimal(n)
    r = q.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return -r if s < 0 else r


def test_ties_round_away_from_zero(spark):
    rows = [(Decimal("0.05"), 2), (Decimal("-0.05"), 2), (Decimal("10.00"), 3), (None, 2), (Decimal("1.00"), 0)]
    df = spark.createDataFrame(rows, "s decimal(20,2), n long")
    got = [r[0] for r in df.select(exact_mean("s", "n")).collect()]
    assert got == [Decimal("0.03"), Decimal("-0.03"), Decimal("3.33"), None, None]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**7)), min_size=1, max_size=20))
def test_matches_exact_rational(spark, pairs):
    rows = [(Decimal(c) / 100, n) for c, n in pairs]
    df = spark.createDataFrame(rows, "s decimal(20,2), n long")
    got = [r[0] for r in df.select(exact_mean("s", "n")).collect()]
    assert got == [ref(s, n) for s, n in rows]
