"""Properties of the exact decimal helpers against Python's Decimal (HALF_UP)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.functions import mean, ratio

pairs = st.lists(
    st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6)), min_size=1, max_size=200
)


def _half_up(x: Decimal) -> Decimal:
    return x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@settings(max_examples=15, deadline=None)
@given(pairs)
def test_ratio_is_exact_half_up(spark, data):
    df = spark.createDataFrame(data, "a long, b long")
    got = df.select("a", "b", ratio("a", "b").alias("r"), ratio("a", "b", percent=True).alias("p")).collect()
    for row in got:
        if row.b == 0:
            assert row.r is None and row.p is None
        else:
            assert row.r == _half_up(Decimal(row.a) / Decimal(row.b))
            assert row.p == _half_up(Decimal(row.a) * 100 / Decimal(row.b))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 10**6)), min_size=1, max_size=300))
def test_mean_is_exact_half_up(spark, data):
    df = spark.createDataFrame(data, "g int, v long")
    got = {r.g: r.m for r in df.groupBy("g").agg(mean("v").alias("m")).collect()}
    for g in {k for k, _ in data}:
        vals = [v for k, v in data if k == g]
        assert got[g] == _half_up(Decimal(sum(vals)) / Decimal(len(vals)))
