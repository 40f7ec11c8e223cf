"""Raw-shaped inputs derived from the driver's TPC-H style tables.

There is no listings/reviews data in the test environment, so this module
derives all-text ``raw_listings`` / ``raw_reviews`` extracts from
``orders ⋈ customer ⋈ nation ⋈ region`` and ``lineitem``. The derivation
is deterministic and injects the dirty values the pipeline must cope with:
null tokens, unparseable prices and dates, ``'2.0'`` integers, unmapped
cities, and the natural key duplicates of ``lineitem``.

Everything is plain column arithmetic on the scans plus equi-joins, so the
extract scales with the tables. The joins run in star order: ``orders ⋈
customer`` on the customer key (a sort-merge join: both sides grow, and its
shuffle spreads the parsing of the rows over all tasks), then the 25-row
``nation`` and 5-row ``region``, which the planner broadcasts by their
measured size. The plan is the same at every input size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import fixed
from stratum.sources.csv import write_csv

# When the extract is staged as CSV, orders whose key is divisible by these
# also get a damaged copy: one field too many / three fields too few.
EXTRA_FIELD_EVERY = 199
MISSING_FIELDS_EVERY = 211

SCORE_COLUMNS = fixed.SCORE_COLUMNS

# In the flawed extracts, keys divisible by these come twice.
REPEATED_LISTING_EVERY = 9
REPEATED_REVIEW_EVERY = 7


# Declared schemas of the columns read from each driver table: no schema
# inference job per read, and only these columns are scanned.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _listing_exprs() -> tuple[Column, ...]:
    """The 33 text columns of the extract, over the joined order/customer/nation/region row."""
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    city_names = F.array(*[F.lit(x) for x in fixed.CITIES])
    city = F.when(F.col("c_nationkey") < len(fixed.CITIES),
                  F.element_at(city_names, F.col("c_nationkey") + 1)).otherwise(F.col("n_name"))
    nullif = lambda cond, v: F.when(cond, F.lit(None).cast("string")).otherwise(v)
    cols = {
        "listing_id": _s(k),
        "name": F.concat(F.lit("order-"), _s(k)),
        "host_id": _s(cust),
        "host_since": F.when(k % 89 == 0, F.lit("bad-date"))
                       .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        "host_location": F.when(k % 11 == 0, F.lit("NA"))
                          .otherwise(F.concat(F.col("n_name"), F.lit(", "), F.col("r_name"))),
        "host_response_time": F.element_at(
            F.array(F.lit("NULL"), F.lit("within an hour"), F.lit("within a few hours"),
                    F.lit("within a day"), F.lit("a few days or more")), (k % 5 + 1).cast("int")),
        "host_response_rate": nullif(k % 2 == 0, F.concat(_s(k % 101), F.lit("%"))),
        "host_acceptance_rate": F.when(k % 3 == 1, F.lit("null"))
                                 .otherwise(F.concat(_s((k * 7) % 101), F.lit("%"))),
        "host_is_superhost": F.when(F.col("o_orderstatus") == "F", F.lit("t"))
                              .when(F.col("o_orderstatus") == "O", F.lit("f")).otherwise(F.lit("")),
        "host_listings_count": _s(cust % 7 + 1),
        "host_identity_verified": F.when(cust % 3 == 0, F.lit("f")).otherwise(F.lit("t")),
        "host_has_profile_pic": F.when(cust % 10 == 0, F.lit("f")).otherwise(F.lit("t")),
        "neighbourhood": nullif(k % 4 == 0, F.col("r_name")),
        "district": F.when((k % 4 == 0) | (k % 7 == 0), F.lit("NA"))
                     .otherwise(F.concat(F.col("r_name"), F.lit("-"), _s(k % 3))),
        "city": city,
        "latitude": F.concat(_s(k % 90), F.lit("."), _s(k % 10)),
        "longitude": F.concat(F.when(cust % 2 == 0, F.lit("-")).otherwise(F.lit("")),
                              _s(cust % 180), F.lit("."), _s(cust % 100)),
        "property_type": F.col("c_mktsegment"),
        "room_type": F.col("o_orderpriority"),
        "accommodates": _s(k % 17),
        "bedrooms": F.when(k % 10 == 0, F.lit(None).cast("string"))
                     .when(k % 10 == 3, F.concat(_s(k % 5 + 1), F.lit(".0")))
                     .otherwise(_s(k % 5 + 1)),
        "amenities": F.element_at(F.array(F.lit('["Wifi"]'), F.lit('["Wifi", "Kitchen"]'), F.lit("[]")),
                                  (k % 3 + 1).cast("int")),
        "price": F.when(k % 97 == 0, F.lit("abc")).otherwise(_s(F.col("o_totalprice") / 40)),
        "minimum_nights": _s(k % 40 + 1),
        "maximum_nights": F.when(k % 50 == 0, F.lit("2147483647")).otherwise(_s(k % 1000 + 30)),
        **{name: nullif(k % 3 == 0, _s((k + i) % 81 + 20)) for i, name in enumerate(SCORE_COLUMNS)},
        "instant_bookable": F.when(k % 5 < 2, F.lit("t")).otherwise(F.lit("f")),
    }
    assert tuple(cols) == fixed.RAW_LISTING_COLUMNS
    return tuple(v.alias(name) for name, v in cols.items())


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """33 text columns in loader order, one row per order."""
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # two sides that grow: a sort-merge join at every size, whose shuffle also deals the rows out
    j = (o.join(c.hint("merge"), o.o_custkey == c.c_custkey)
         .join(n, F.col("c_nationkey") == n.n_nationkey)
         .join(r, F.col("n_regionkey") == r.r_regionkey))
    return j.select(*_listing_exprs())


def _review_exprs() -> tuple[Column, ...]:
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return (
        _s(k).alias("listing_id"),
        _s(k * 10 + ln).alias("review_id"),
        F.when((k + ln) % 211 == 0, F.lit("2024-02-30"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        _s(F.col("l_suppkey")).alias("reviewer_id"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4 text columns in loader order, one row per lineitem (key duplicates kept)."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return li.select(*_review_exprs())


def stage_listings_csv(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """Stage the listings extract as CSV landing files plus malformed lines.

    Every row of the extract is written well-formed to ``good/``. On top of
    that, a damaged copy of some rows lands in ``extra/`` (one field too
    many) or ``short/`` (three fields too few), so the load has lines to
    quarantine without losing any row. Every part file carries a header
    line. Returns ``out_dir``.
    """
    raw = raw_listings(spark, sf_dir)
    k = F.col("listing_id").cast("bigint")
    write_csv(raw, f"{out_dir}/good")
    write_csv(raw.where(k % EXTRA_FIELD_EVERY == 0).withColumn("unexpected", F.lit("x")), f"{out_dir}/extra")
    write_csv(raw.where(k % MISSING_FIELDS_EVERY == 0).select(*fixed.RAW_LISTING_COLUMNS[:-3]),
              f"{out_dir}/short")
    return out_dir


def stage_reviews_csv(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """Stage the reviews extract as CSV like the listings: all of it, plus damaged copies of some lines."""
    raw = raw_reviews(spark, sf_dir)
    k = F.col("listing_id").cast("bigint")
    write_csv(raw, f"{out_dir}/good")
    write_csv(raw.where(k % EXTRA_FIELD_EVERY == 0).withColumn("unexpected", F.lit("x")), f"{out_dir}/extra")
    write_csv(raw.where(k % MISSING_FIELDS_EVERY == 0).select(*fixed.RAW_REVIEW_COLUMNS[:-1]), f"{out_dir}/short")
    return out_dir


def quoted_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(listing_id, name, amenities) with accents, quotes, commas and line breaks inside the names."""
    k = F.col("listing_id").cast("bigint")
    name = (F.when(k % 5 == 0, F.concat(F.lit('Caf\u00e9 "'), F.col("name"), F.lit('"\nfirst, second')))
            .when(k % 5 == 1, F.concat(F.lit("Stra\u00dfe "), F.col("name"))).otherwise(F.col("name")))
    return raw_listings(spark, sf_dir).select("listing_id", name.alias("name"), "amenities")


def with_repeats(df: DataFrame, key: str, every: int) -> DataFrame:
    """``df`` with a second, fully equal row wherever ``key`` is divisible by ``every``."""
    return df.unionByName(df.where(F.col(key).cast("bigint") % every == 0))


def flawed_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables in the shape of some models with what the data tests look for: missing and
    repeated keys, and values outside the accepted lists. Nothing has filtered them before."""
    listings = with_repeats(raw_listings(spark, sf_dir), "listing_id", REPEATED_LISTING_EVERY)
    known = lambda c: F.when(F.col(c).isin("NA", "NULL", "null", ""), None).otherwise(F.col(c))
    return {
        "bronze_listings": listings.select(
            known("neighbourhood").alias("listing_id"),
            F.col("price").try_cast("double").alias("price_raw")),
        "silver_listings": listings.select(
            "listing_id", "city", F.col("price").try_cast("double").alias("price_usd"),
            known("district").alias("price_category"), known("host_response_time").alias("host_type"),
            F.col("room_type").alias("stay_type"), F.substring("city", 1, 3).alias("currency")),
        "fct_revenue_by_city": listings.groupBy("city", "room_type").agg(
            F.count(F.lit(1)).alias("total_listings"),
            F.avg(F.col("price").try_cast("double")).alias("avg_price_usd")),
    }
