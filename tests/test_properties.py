"""Property tests: exact rounding and ratios against Python's Decimal arithmetic.

All generated cases go through Spark as one DataFrame (one job), compared
with a brute-force Decimal evaluation of the same rule.
"""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.functions.measures import ratio, round_dec


def _half_up(x: Decimal, places: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(0, 10 ** 9)), min_size=1, max_size=200))
def test_ratio_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = df.select("n", "d", ratio(F.col("n"), F.col("d")).alias("pct"),
                    ratio(F.col("n"), F.col("d"), pct=False).alias("plain")).collect()
    for r in got:
        if r.d == 0:
            assert r.pct is None and r.plain is None
            continue
        q6 = _half_up(Decimal(r.n) / Decimal(r.d), 6)
        assert r.pct == float(_half_up(q6 * 100, 2))
        assert r.plain == float(_half_up(q6, 2))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10 ** 9, 10 ** 9), min_size=1, max_size=200), st.sampled_from([1, 2]))
def test_round_dec_matches_decimal_on_cent_grid(spark, thousandths, places):
    # values with three decimals: the third digit decides, ties included
    xs = [t / 1000 for t in thousandths]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.r for r in df.select(round_dec(F.col("x"), places).alias("r")).collect()]
    want = [float(_half_up(Decimal(repr(x)), places)) for x in xs]
    assert got == want
