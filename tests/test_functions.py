import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum import fixed
from stratum.functions import dates, measures, parse, tiers


def _one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("text,expected", [
    ("3.7", 4), ("2.5", 3), ("2.0", 2), ("1", 1), (" 12 ", 12), ("-2.5", -3),
    ("abc", None), ("12d", None), ("", None), (None, None), ("1e3", 1000),
])
def test_try_number_rounds_half_up(spark, text, expected):
    assert _one(spark, parse.try_number, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("9999.99", 9999.99), ("12d", None), ("12f", None), ("NaN", None), ("0x10", None),
    ("abc", None), (".5", 0.5), ("-1.25e2", -125.0),
])
def test_try_double_is_strict_about_suffixes(spark, text, expected):
    assert _one(spark, parse.try_double, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("2024-03-03", dt.date(2024, 3, 3)), ("2024-02-30", None), ("05/01/2024", None),
    ("2024-1-5", None), ("bad-date", None), (None, None),
])
def test_try_date_is_strict(spark, text, expected):
    assert _one(spark, parse.try_date, text) == expected


def test_flag_and_percent(spark):
    rows = spark.createDataFrame([("t", "97%"), ("f", None), (None, "abc%"), ("T", "5")], "f string, p string")
    got = rows.select(parse.flag("f").alias("f"), parse.percent("p").alias("p")).collect()
    assert [r.f for r in got] == [True, False, False, False]
    assert [r.p for r in got] == [97.0, None, None, 5.0]


def test_money_strips_symbols(spark):
    assert _one(spark, parse.money, "$1,200.50") == 1200.5
    assert _one(spark, parse.money, "n/a") is None


def test_strict_int_fails_on_bad_text(spark):
    df = spark.createDataFrame([("x1",)], "v string").select(parse.strict_int("v", "listing_id").alias("r"))
    with pytest.raises(Exception, match="listing_id"):
        df.collect()
    assert _one(spark, lambda c: parse.strict_int(c), "42") == 42


@pytest.mark.parametrize("nights,label", [(1, "Flexible"), (7, "Weekly"), (30, "Monthly"), (31, "Long Stay"),
                                          (None, "Long Stay"), (0, "Flexible")])
def test_stay_tier_closed_bounds(spark, nights, label):
    f = lambda c: tiers.tier(c, fixed.STAY_TIERS, fixed.STAY_OTHER, closed=True)
    assert _one(spark, f, nights, "bigint") == label


@pytest.mark.parametrize("price,label", [(49.996, "Budget"), (50.0, "Mid-range"), (149.99, "Mid-range"),
                                         (150.0, "Premium"), (299.9997, "Premium"), (300.0, "Luxury")])
def test_price_tier_open_bounds(spark, price, label):
    f = lambda c: tiers.tier(c, fixed.PRICE_TIERS, fixed.PRICE_OTHER, closed=False)
    assert _one(spark, f, price, "double") == label


def test_label_null_is_no(spark):
    f = lambda c: tiers.label(c, "Superhost", "Regular Host")
    assert _one(spark, f, None, "boolean") == "Regular Host"
    assert _one(spark, f, True, "boolean") == "Superhost"


def test_years_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31), dt.date(2024, 1, 1)),
                                (dt.date(2020, 1, 1), dt.date(2024, 12, 31))], "a date, b date")
    assert [r.y for r in df.select(dates.years_between(F.col("a"), F.col("b")).alias("y")).collect()] == [1, 4]


def test_date_dimension(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 3),), (dt.date(2024, 12, 31),), (dt.date(2025, 1, 1),),
                                (dt.date(2024, 9, 1),)], "d date")
    rows = df.select(*dates.date_dimension(F.col("d"))).collect()
    sunday = rows[0]
    assert (sunday.day_of_week, sunday.month_name, sunday.season, sunday.quarter_number) == (0, "Mar", "Spring", 1)
    assert sunday.review_month == dt.date(2024, 3, 1) and sunday.review_year == dt.date(2024, 1, 1)
    assert rows[1].season == rows[2].season == "Winter"
    assert rows[1].review_month == dt.date(2024, 12, 1) and rows[2].review_month == dt.date(2025, 1, 1)
    assert rows[3].season == "Autumn"


@pytest.mark.parametrize("x,places,expected", [(0.285, 2, 0.29), (1.005, 2, 1.01), (279.99972, 2, 280.0),
                                               (2.25, 1, 2.3), (-0.125, 2, -0.13)])
def test_round_dec_half_away_from_zero(spark, x, places, expected):
    assert _one(spark, lambda c: measures.round_dec(c, places), x, "double") == expected


def test_ratio_rounds_quotient_to_six_places_first(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (0, 5), (5, 0), (1234999, 1000000),
                                (2469999, 2000000)], "n bigint, d bigint")
    got = df.select(measures.ratio(F.col("n"), F.col("d")).alias("pct"),
                    measures.ratio(F.col("n"), F.col("d"), pct=False).alias("plain")).collect()
    assert [r.pct for r in got] == [33.33, 66.67, 0.0, None, 123.5, 123.5]
    # 1.234999 stays 1.23; 1.2349995 becomes 1.235000 at 6 places, then 1.24
    assert [r.plain for r in got] == [0.33, 0.67, 0.0, None, 1.23, 1.24]


def test_avg_nonzero_ignores_sentinel(spark):
    df = spark.createDataFrame([(0.0,), (90.0,), (None,), (80.0,)], "s double")
    assert df.agg(measures.avg_nonzero(F.col("s")).alias("a")).first().a == 85.0


def test_short_digits_take_no_decimal(spark):
    """Whole numbers of up to 18 digits are settled before the decimal; the others read as ever."""
    from stratum.functions.parse import strict_int, try_double, try_number
    texts = ["7", "007", "999999999999999999", "1000000000000000000", " 8 ", "+9", "-3", "3.7", "2.0", "5\n", "\t5",
             "", "1e3", ".5", "5.", ".", "12d", "--1", "1e", "\u0663"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.n, r.d) for r in df.select("t", try_number("t").alias("n"), try_double("t").alias("d")).collect()}
    assert [got[t][0] for t in texts] == [7, 7, 10**18 - 1, 10**18, 8, 9, -3, 4, 2, 5, None, None, 1000, 1, 5,
                                          None, None, None, None, None]
    assert [got[t][1] for t in texts[6:15]] == [-3.0, 3.7, 2.0, 5.0, None, None, 1000.0, 0.5, 5.0]
    plan = df.select(strict_int("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("{1,18}") < plan.index("decimal(38,0)")
