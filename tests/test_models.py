"""Model behaviour on the edge rows listed in FIXTURES.md."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import listing_row, raw_listings_df, raw_reviews_df
from stratum.operators.lookup import city_dimension, lookup_normalise
from stratum.plans.bronze import bronze_listings, bronze_reviews
from stratum.plans.gold import (fct_price_vs_rating, fct_revenue_by_city, fct_seasonal_trends,
                                fct_superhost_performance)
from stratum.plans.silver import silver_listings, silver_reviews

AS_OF = "2024-01-01"

LISTINGS = [
    listing_row(listing_id="1", city="New York", price="49.996"),
    listing_row(listing_id="2", city="Bangkok", price="0.1"),
    listing_row(listing_id="3", city="Bangkok", price="9999.99"),
    listing_row(listing_id="4", price="abc"),
    listing_row(listing_id="5", price="0"),
    listing_row(listing_id="6", price="10000"),
    listing_row(listing_id="7", accommodates=None),
    listing_row(listing_id="8", accommodates="0"),
    listing_row(listing_id="9", bedrooms=None, host_is_superhost=None, host_response_rate="97%",
                review_scores_rating="NA"),
    listing_row(listing_id="10", bedrooms="2.0", host_response_rate=None, minimum_nights="31"),
    listing_row(listing_id="11", city="Atlantis"),
    listing_row(listing_id=None),
    listing_row(listing_id="12", host_since="2023-12-31", minimum_nights=None, district="NULL"),
    listing_row(listing_id="13", city="Paris", price="100", host_id="20", host_is_superhost="f",
                instant_bookable="t"),
]


@pytest.fixture(scope="module")
def models(spark):
    raw = raw_listings_df(spark, LISTINGS)
    bl = bronze_listings(raw)
    sl = silver_listings(bl, city_dimension(spark), AS_OF)
    return {"bronze": bl, "silver": sl}


def _by_id(df):
    return {r.listing_id: r for r in df.collect()}


def test_bronze_drops_null_ids_and_types(models):
    b = _by_id(models["bronze"])
    assert None not in b and len(b) == len(LISTINGS) - 1
    assert b[4].price_raw is None and b[10].bedrooms == 2
    assert b[9].host_is_superhost is False and b[9].host_response_rate_pct == 97.0
    assert b[9].review_scores_rating is None
    assert b[12].district is None and b[12].host_since_date == dt.date(2023, 12, 31)


def test_silver_filters_on_raw_values(models):
    s = _by_id(models["silver"])
    assert sorted(s) == [1, 2, 3, 9, 10, 12, 13]  # abc/0/10000 prices, null/0 accommodates, Atlantis gone


def test_silver_price_rounding_and_tier_use_unrounded_value(models):
    s = _by_id(models["silver"])
    assert (s[1].price_usd, s[1].price_category, s[1].currency) == (50.0, "Budget", "USD")
    assert (s[2].price_usd, s[2].currency) == (0.0, "THB")
    assert (s[3].price_usd, s[3].price_category) == (280.0, "Premium")


def test_silver_defaults_and_labels(models):
    s = _by_id(models["silver"])
    assert s[9].bedrooms == 1 and s[9].host_type == "Regular Host" and s[9].review_scores_rating == 0.0
    assert s[10].host_response_rate_pct == 0.0 and s[10].stay_type == "Long Stay"
    assert s[12].stay_type == "Long Stay" and s[12].district == "Unknown" and s[12].host_years_active == 1
    assert s[1].host_type == "Superhost" and s[1].stay_type == "Weekly"
    assert s[1].host_response_time == "Unknown" and s[1].neighbourhood == "Unknown"


def test_price_vs_rating_drops_zero_price_and_missing_rating(models):
    g = fct_price_vs_rating(models["silver"]).collect()
    assert sum(r.total_listings for r in g) == 5  # 2 rounds to 0.00, 9 has no rating


def test_revenue_by_city(models):
    g = {r.city: r for r in fct_revenue_by_city(models["silver"]).collect()}
    ny = g["New York"]
    assert ny.total_listings == 4 and ny.total_hosts == 1 and ny.superhost_count == 1
    assert ny.superhost_pct == 100.0
    assert ny.avg_rating == 90.0  # the defaulted 0 of listing 9 is ignored
    assert (ny.budget_listings, ny.midrange_listings) == (1, 3)
    paris = g["Paris"]
    assert paris.instant_bookable_count == 1 and paris.instant_bookable_pct == 100.0
    assert [r.city for r in fct_revenue_by_city(models["silver"]).collect()][0] == "New York"


def test_superhost_performance_averages_zero_rates(models):
    g = {(r.city, r.host_type): r for r in fct_superhost_performance(models["silver"]).collect()}
    ny_regular = g[("New York", "Regular Host")]  # listing 9 only: 97% response rate
    assert ny_regular.avg_response_rate_pct == 97.0
    ny_super = g[("New York", "Superhost")]  # listings 1, 10, 12: 0 (missing) rates count
    assert ny_super.total_listings == 3 and ny_super.avg_response_rate_pct == 0.0


def test_median_is_interpolated(spark):
    rows = [listing_row(listing_id=str(i), price=p) for i, p in enumerate(["1", "2", "3", "10"], start=1)]
    s = silver_listings(bronze_listings(raw_listings_df(spark, rows)), city_dimension(spark), AS_OF)
    assert fct_revenue_by_city(s).first().median_price_usd == 2.5


def test_lookup_default_arm(spark):
    df = spark.createDataFrame([("Atlantis", 10.0), (None, 3.0), ("Rome", 10.0)], "city string, price_raw double")
    out = {r.city: r for r in lookup_normalise(df, city_dimension(spark)).collect()}
    assert (out["Atlantis"].currency, out["Atlantis"].price_converted) == ("USD", 10.0)
    assert (out[None].currency, out[None].price_converted) == ("USD", 3.0)
    assert out["Rome"].currency == "EUR" and out["Rome"].price_converted == pytest.approx(10.8)


REVIEWS = [
    ("1", "100", "2024-03-03", "7"),
    ("1", "100", "2024-03-01", "9"),     # duplicate id, earlier date wins
    ("1", "101", "2024-02-30", "7"),     # impossible date: kept in bronze, dropped in silver
    (None, "102", "2024-03-03", "7"),    # no listing: dropped
    ("1", None, "2024-03-03", "7"),      # no id: dropped
    ("4", "103", "2024-12-31", "8"),     # listing 4 never reaches silver
    ("12", "104", "2024-12-31", "8"),
    ("12", "105", "2025-01-01", "8"),
]


def test_bronze_reviews_dedupe_is_deterministic(spark):
    br = {r.review_id: r for r in bronze_reviews(raw_reviews_df(spark, REVIEWS)).collect()}
    assert sorted(br) == [100, 101, 103, 104, 105]
    assert br[100].review_date == dt.date(2024, 3, 1) and br[100].reviewer_id == 9
    assert br[101].review_date is None


def test_bronze_reviews_strict_cast_fails(spark):
    with pytest.raises(Exception, match="listing_id"):
        bronze_reviews(raw_reviews_df(spark, [("x1", "1", "2024-01-01", "1")])).collect()


def test_seasonal_trends_inner_join(spark, models):
    sr = silver_reviews(bronze_reviews(raw_reviews_df(spark, REVIEWS)))
    assert sr.count() == 4
    trends = fct_seasonal_trends(sr, models["silver"]).collect()
    keys = {(r.city, r.year_number, r.month_number, r.season): r.total_reviews for r in trends}
    assert keys == {("New York", 2024, 3, "Spring"): 1, ("New York", 2024, 12, "Winter"): 1,
                    ("New York", 2025, 1, "Winter"): 1}
    assert all(r.avg_reviews_per_listing == 1.0 for r in trends)


def test_one_city_with_a_third_of_the_rows_and_null_groups(spark):
    from stratum.plans.gold import with_median
    rows = [("a", None, float(i % 7)) for i in range(300)] + [(str(i), "r", float(i)) for i in range(600)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "city string, room string, price_usd double")
    got = with_median(df, ["city", "room"], [F.count(F.lit(1)).alias("n")])
    by = {(r.city, r.room): (r.n, r.median) for r in got.collect()}
    assert by[("a", None)] == (300, 3.0) and by[("5", "r")] == (1, 5.0) and by[(None, None)] == (1, None)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_load_stamp_and_defaults(spark):
    from stratum.operators.cleanse import fill_defaults, with_load_time
    df = spark.createDataFrame([(None, None), ("x", 2)], "a string, b bigint")
    stamped = with_load_time(df).select("loaded_at").distinct().collect()
    assert len(stamped) == 1 and stamped[0].loaded_at is not None   # one time for the whole batch
    filled = fill_defaults(df, {"a": "Unknown", "b": 1}).collect()
    assert [tuple(r) for r in filled] == [("Unknown", 1), ("x", 2)]
    assert fill_defaults(df, {"a": "Unknown"}).columns == ["a", "b"]


def test_tests_and_order_read_one_raw_table(spark, monkeypatch):
    """Listings are written as raw text once; no query computes or writes the whole bronze table for them."""
    from stratum.plans import queries as q
    seen = []
    plain = q.materialize
    monkeypatch.setattr(q, "materialize", lambda df, label="materialized": seen.append((label, df.columns)) or plain(df, label))
    q._tested_models(spark, "/root/testdata/sf0.001", ("accepted_values",))
    assert [n for n, _ in seen] == ["raw_listings", "bronze_reviews"]
    seen.clear()
    q.q_presentation_order(spark, "/root/testdata/sf0.001")
    assert [columns[0] for _, columns in seen] == ["listing_id"]
