"""Silver as views kept with their version, the catalog's layers, and positions of sorted rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, listing_row, raw_listings_df, raw_reviews_df
from stratum.operators.lookup import city_dimension
from stratum.operators.numbering import with_positions
from stratum.plans import queries as Q
from stratum.plans.bronze import bronze_listings, bronze_reviews
from stratum.plans.silver import silver_listings, silver_reviews
from stratum.plans.views import silver_views
from stratum.sources.snapshots import Snapshots, View
from stratum.sources.tables import read_table


def _store(spark, root, listings, reviews, as_of=Q.AS_OF):
    store = Snapshots(spark, root)
    bl, br = store.write(listings, "bronze", "bronze_listings"), store.write(reviews, "bronze", "bronze_reviews")
    store.publish({("bronze", "bronze_listings"): bl, ("bronze", "bronze_reviews"): br}, silver_views(as_of))
    return store


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("as_of", [Q.AS_OF, None])
def test_views_equal_the_models(spark, scratch, as_of):
    odd = [listing_row(), listing_row(listing_id="2", price="49.999", minimum_nights=None, host_is_superhost=None),
           listing_row(listing_id="3", city="Paris", price="0.285", accommodates="0"), listing_row(listing_id="4", city="Oslo"),
           listing_row(listing_id="5", city="Rome", price="10000"), listing_row(listing_id="6", city="Hong Kong", price="9999.99",
           host_since="2024-02-30", bedrooms=None, neighbourhood="O'Hara \\ {x}", minimum_nights="31"),
           listing_row(listing_id="7", city=None), listing_row(listing_id="8", price=None)]
    bl = bronze_listings(raw_listings_df(spark, odd).unionByName(Q.raw_listings(spark, SF_SMALL)))
    br = bronze_reviews(raw_reviews_df(spark, [("1", "-1", "2024-02-29", "3"), ("1", "-2", None, "3")])
                        .unionByName(Q.raw_reviews(spark, SF_SMALL)))
    _store(spark, scratch, bl, br, as_of)
    later = spark.newSession()
    for name, model in (("silver_listings", silver_listings(bl, city_dimension(spark), as_of)), ("silver_reviews", silver_reviews(br))):
        view = read_table(later, scratch, "silver", name)
        assert view.dtypes == model.dtypes
        assert _rows(view) == _rows(model)
        assert view.count() > 100


def test_catalog_layers(spark, scratch):
    def listings(*rows):
        return bronze_listings(raw_listings_df(spark, [listing_row(listing_id=i) for i in rows]))
    reviews = bronze_reviews(raw_reviews_df(spark, [("1", "5", "2024-01-01", "3")]))
    store = _store(spark, scratch, listings("1", "2"), reviews)
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    assert store.attach(prefix=prefix) == [f"{prefix}bronze.bronze_listings", f"{prefix}bronze.bronze_reviews",
                                           f"{prefix}silver.silver_listings", f"{prefix}silver.silver_reviews"]
    later = spark.newSession()
    later.conf.set("spark.sql.maxMetadataStringLength", 10_000)  # the plan's text in full
    silver = later.table(f"{prefix}silver.silver_listings")
    assert silver.count() == 2
    plan = silver._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThan(price_raw,0.0)" in pushed and "GreaterThan(accommodates,0)" in pushed and "In(city" in pushed
    # a later version takes the names over in whole; the earlier one can be named again
    _store(spark, scratch, listings("1", "2", "3"), reviews)
    assert later.table(f"{prefix}silver.silver_listings").count() == 2
    store.attach(prefix=prefix)
    assert later.table(f"{prefix}silver.silver_listings").count() == 3 == later.table(f"{prefix}bronze.bronze_listings").count()
    store.attach(1, prefix)
    assert later.table(f"{prefix}silver.silver_listings").count() == 2
    assert store.read("silver", "silver_listings", 1).count() == 2 and store.read("silver", "silver_listings").count() == 3


def test_views_need_their_tables(spark, scratch):
    store = Snapshots(spark, scratch)
    with pytest.raises(LookupError):
        store.publish({}, {("silver", "v"): View("SELECT * FROM {t}", {"t": ("bronze", "t")})})
    with pytest.raises(LookupError):
        store.attach()
    assert store.versions() == []


def test_positions_of_sorted_rows(spark):
    df = spark.range(5000, numPartitions=7).select(((F.col("id") * 7919) % 5000).alias("v"), F.lit("x").alias("position_of"))
    got = with_positions(df.orderBy(F.col("v").desc()))
    assert [(r.v, r.position) for r in got.orderBy("position").collect()] == [(4999 - i, i + 1) for i in range(5000)]
    hot = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("v"))
    places = with_positions(hot.orderBy("v"), "at").orderBy("at").collect()
    assert [r["at"] for r in places] == list(range(1, 3001)) and [r.v for r in places] == sorted(r.v for r in places)
    both = df.select("v").orderBy("v").withColumn("t", F.lit("a")).union(hot.orderBy(F.col("v").desc()).withColumn("t", F.lit("b")))
    two = {(r.t, r.position): r.v for r in with_positions(both, groups=("t",)).collect()}
    assert [two["a", i + 1] for i in range(5000)] == list(range(5000))
    assert [two["b", i + 1] for i in range(3000)] == [r.v for r in places][::-1] and len(two) == 8000
    assert with_positions(df.limit(0).orderBy("v")).count() == 0
    # the only window without keys runs over a row per partition: its input is already grouped
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate") and plan.count("Window [") == 1
