"""Plan shape and skew: the properties the scale design relies on."""

import os

import pandas as pd
from pyspark.sql import functions as F

from conftest import listing_row, raw_listings_df, raw_reviews_df
from stratum.operators.lookup import city_dimension
from stratum.plans.bronze import bronze_listings, bronze_reviews
from stratum.plans.gold import fct_revenue_by_city
from stratum.plans.silver import silver_listings


def _physical(df) -> str:
    df.collect()  # finalise the adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_before_the_shuffle(spark):
    rows = [("1", "7", "2024-01-01", str(i)) for i in range(300)] + \
           [(str(i), str(1000 + i), "2024-01-02", "5") for i in range(600)]   # one id holds a third
    out = bronze_reviews(raw_reviews_df(spark, rows))
    plan = _physical(out)
    assert plan.count("WindowGroupLimit") >= 2, plan   # partial (map side) + final
    hot = out.where(F.col("review_id") == 7).collect()
    assert len(hot) == 1 and hot[0].reviewer_id == 0
    assert out.count() == 601


def test_silver_filters_reach_the_parquet_scan(spark, scratch):
    raw = raw_listings_df(spark, [listing_row(listing_id=str(i), price=str(10 * i)) for i in range(1, 40)])
    path = os.path.join(scratch, "bronze_listings")
    bronze_listings(raw).write.parquet(path)
    s = silver_listings(spark.read.parquet(path), city_dimension(spark), "2024-01-01")
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = s._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    pushed = plan[plan.index("PushedFilters"):].split("]", 1)[0]
    assert "GreaterThan(price_raw,0.0)" in pushed and "LessThan(price_raw,10000.0)" in pushed
    assert "In(city" in pushed and "GreaterThan(accommodates,0)" in pushed


def test_no_join_is_broadcast_by_a_hint(spark):
    raw = raw_listings_df(spark, [listing_row(listing_id=str(i)) for i in range(1, 5)])
    s = silver_listings(bronze_listings(raw), city_dimension(spark), "2024-01-01")
    hinted = s._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in hinted, hinted


def test_hot_city_matches_brute_force(spark):
    # New York holds a third of the listings; aggregates must stay exact
    rows, prices = [], {}
    for i in range(1, 301):
        city = "New York" if i % 3 == 0 else ("Paris" if i % 3 == 1 else "Rome")
        price = str(20 + (i * 37) % 400)
        rows.append(listing_row(listing_id=str(i), host_id=str(i % 17), city=city, price=price))
        prices.setdefault(city, []).append(float(price) * {"New York": 1.0, "Paris": 1.08, "Rome": 1.08}[city])
    s = silver_listings(bronze_listings(raw_listings_df(spark, rows)), city_dimension(spark), "2024-01-01")
    got = {r.city: r for r in fct_revenue_by_city(s).collect()}
    for city, ps in prices.items():
        cents = pd.Series([round(p + 1e-9, 2) for p in ps])
        assert got[city].total_listings == len(ps)
        assert got[city].median_price_usd == round(cents.median() + 1e-9, 2)
        assert got[city].max_price_usd == cents.max() and got[city].min_price_usd == cents.min()
