"""Gold models: the four fact tables.

The three over listings are one pass of mergeable states each (see
:mod:`stratum.operators.states`): medians, distinct counts, averages and
extremes come out of the same two-level aggregate, and silver is read once.
``updated_at`` is the build time; ordering is the presentation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import fixed
from stratum.functions.dates import month_name, month_quarter, season
from stratum.functions.measures import ratio, round_dec
from stratum.operators.states import grouped_states

c = F.col


def with_median(df: DataFrame, keys: list[str], aggs, value: str = "price_usd") -> DataFrame:
    """``df`` grouped by ``keys`` with ``aggs`` and the exact ``median`` of ``value`` (2 places).

    The median is taken over the counts of each value per group, so a group
    that holds a third of all rows is split by its values before anything
    meets in one task; the other aggregates stay a plain hash aggregate.
    """
    base = df.groupBy(*keys).agg(*aggs)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    middle = (counts.groupBy(*[c(k).alias(f"__{k}") for k in keys])
              .agg(round_dec(F.percentile(value, 0.5, c("__n")), 2).alias("median")))
    same = F.lit(True)
    for k in keys:
        same = same & base[k].eqNullSafe(middle[f"__{k}"])
    return base.join(middle, same).drop(*[f"__{k}" for k in keys])


def nonzero(column: str) -> Column:
    """Values that an average takes: neither missing nor the sentinel 0."""
    return F.nullif(c(column), F.lit(0))


def _tiers(suffix: str) -> dict[str, Column]:
    names = ("budget", "midrange", "premium", "luxury")
    return {f"{n}_{suffix}": c("price_category") == F.lit(cat) for n, cat in zip(names, fixed.PRICE_CATEGORIES)}


def _rounded(name: str, places: int = 2) -> Column:
    return round_dec(c(name), places).alias(name)


def fct_revenue_by_city(listings: DataFrame, order: bool = True) -> DataFrame:
    superhost, instant = c("host_is_superhost"), c("instant_bookable")
    tiers = _tiers("listings")
    g = grouped_states(
        listings, ["city", "currency"], "price_usd",
        averages={"avg_price_usd": c("price_usd"), "avg_rating": nonzero("review_scores_rating"),
                  "avg_cleanliness_score": nonzero("review_scores_cleanliness"),
                  "avg_location_score": nonzero("review_scores_location"), "avg_minimum_nights": c("minimum_nights")},
        counts=tiers,
        distinct={"listing_id": {"total_listings": None, "instant_bookable_count": instant},
                  "host_id": {"total_hosts": None, "superhost_count": superhost}})
    out = g.select(
        "city", "currency", "total_listings", "total_hosts", "superhost_count",
        ratio(c("superhost_count"), c("total_hosts")).alias("superhost_pct"),
        _rounded("avg_price_usd"), round_dec(c("low"), 2).alias("min_price_usd"), round_dec(c("high"), 2).alias("max_price_usd"),
        round_dec(c("median"), 2).alias("median_price_usd"),
        _rounded("avg_rating"), _rounded("avg_cleanliness_score"), _rounded("avg_location_score"),
        _rounded("avg_minimum_nights", 1), "instant_bookable_count",
        ratio(c("instant_bookable_count"), c("total_listings")).alias("instant_bookable_pct"),
        *tiers).withColumn("updated_at", F.current_timestamp())
    return out.orderBy(F.desc("total_listings"), "city") if order else out


def fct_superhost_performance(listings: DataFrame, order: bool = True) -> DataFrame:
    tiers = _tiers("count")
    g = grouped_states(
        listings, ["city", "host_type", "host_is_superhost"], "price_usd",
        averages={"avg_price_usd": c("price_usd"), "avg_rating": nonzero("review_scores_rating"),
                  "avg_cleanliness": nonzero("review_scores_cleanliness"), "avg_value_score": nonzero("review_scores_value"),
                  "avg_location_score": nonzero("review_scores_location"),
                  "avg_communication_score": nonzero("review_scores_communication"),
                  "avg_response_rate_pct": c("host_response_rate_pct"),
                  "avg_acceptance_rate_pct": c("host_acceptance_rate_pct"),
                  "avg_host_years_active": c("host_years_active"), "avg_listings_per_host": c("host_listings_count"),
                  "avg_minimum_nights": c("minimum_nights")},
        counts={"instant": c("instant_bookable"), **tiers},
        distinct={"host_id": {"total_hosts": None}, "listing_id": {"total_listings": None}})
    out = g.select(
        "city", "host_type", "host_is_superhost", "total_hosts", "total_listings", _rounded("avg_price_usd"),
        round_dec(c("median"), 2).alias("median_price_usd"),
        round_dec(c("low"), 2).alias("min_price_usd"), round_dec(c("high"), 2).alias("max_price_usd"),
        _rounded("avg_rating"), _rounded("avg_cleanliness"), _rounded("avg_value_score"), _rounded("avg_location_score"),
        _rounded("avg_communication_score"), _rounded("avg_response_rate_pct"), _rounded("avg_acceptance_rate_pct"),
        _rounded("avg_host_years_active", 1), _rounded("avg_listings_per_host", 1), _rounded("avg_minimum_nights", 1),
        ratio(c("instant"), c("rows")).alias("instant_bookable_pct"), *tiers).withColumn("updated_at", F.current_timestamp())
    return out.orderBy("city", F.desc("host_is_superhost"), "host_type") if order else out


def _fct_seasonal_trends_aggs() -> tuple[Column, ...]:
    return (
        F.count("review_id").alias("total_reviews"),
        F.count_distinct("listing_id").alias("active_listings"),
        F.count_distinct("reviewer_id").alias("unique_reviewers"),
        ratio(F.count("review_id"), F.count_distinct("listing_id"), pct=False)
        .alias("avg_reviews_per_listing"),
    )


def fct_seasonal_trends(reviews: DataFrame, listings: DataFrame, order: bool = True) -> DataFrame:
    """Reviews of surviving listings by month, room type and price tier.

    Only the columns that are grouped or counted cross the join. What
    depends on the month alone is derived after the aggregate. The join is
    left to the planner: AQE turns it into a broadcast when the measured
    listings side is under the broadcast threshold, otherwise it stays a
    sort-merge join with skew splitting for hot listing ids.
    """
    r = reviews.select("review_id", "listing_id", "reviewer_id", "year_number", "month_number")
    lst = listings.select("listing_id", "city", "room_type", "price_category")
    joined = r.join(lst, "listing_id", "inner")
    keys = ["city", "year_number", "month_number", "room_type", "price_category"]
    month = c("month_number")
    grouped = joined.groupBy(*keys).agg(*_fct_seasonal_trends_aggs())
    counted = [x for x in grouped.columns if x not in keys]
    out = (grouped.select("city", "year_number", "month_number", month_name(month).alias("month_name"),
                          month_quarter(month).alias("quarter_number"), season(month).alias("season"),
                          "room_type", "price_category", *counted)
           .withColumn("updated_at", F.current_timestamp()))
    return out.orderBy("city", "year_number", "month_number", "room_type", "price_category") if order else out


def fct_price_vs_rating(listings: DataFrame, order: bool = True) -> DataFrame:
    rated = listings.where((c("price_usd") > 0) & (c("review_scores_rating") > 0))
    keys = ["city", "room_type", "property_type", "price_category"]
    g = grouped_states(
        rated, keys, "price_usd",
        averages={"avg_price_usd": c("price_usd"), "avg_rating": nonzero("review_scores_rating"),
                  "avg_cleanliness": nonzero("review_scores_cleanliness"), "avg_value_score": nonzero("review_scores_value"),
                  "avg_location_score": nonzero("review_scores_location"), "avg_accommodates": c("accommodates"),
                  "avg_bedrooms": c("bedrooms"), "avg_minimum_nights": c("minimum_nights"),
                  "avg_response_rate": c("host_response_rate_pct")},
        counts={"superhosts": c("host_is_superhost"), "instant": c("instant_bookable")},
        distinct={"listing_id": {"total_listings": None}, "host_id": {"total_hosts": None}})
    out = g.select(
        *keys, "total_listings", "total_hosts", _rounded("avg_price_usd"), round_dec(c("median"), 2).alias("median_price_usd"),
        round_dec(c("low"), 2).alias("min_price_usd"), round_dec(c("high"), 2).alias("max_price_usd"),
        _rounded("avg_rating"), _rounded("avg_cleanliness"), _rounded("avg_value_score"), _rounded("avg_location_score"),
        _rounded("avg_accommodates", 1), _rounded("avg_bedrooms", 1), _rounded("avg_minimum_nights", 1),
        ratio(c("superhosts"), c("rows")).alias("superhost_pct"), _rounded("avg_response_rate"),
        ratio(c("instant"), c("rows")).alias("instant_bookable_pct")).withColumn("updated_at", F.current_timestamp())
    return out.orderBy("city", "price_category", "room_type", "property_type") if order else out
