"""Silver models: normalised, defaulted, tiered listings and the review date dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import fixed
from stratum.functions.dates import as_date, date_dimension, years_between
from stratum.functions.measures import round_dec
from stratum.functions.tiers import label, tier
from stratum.operators.cleanse import defaulted
from stratum.operators.lookup import in_dimension, lookup_normalise
from stratum.plans.bronze import LISTING_SCORE_COLUMNS

LISTING_DEFAULTS = {
    "host_response_time": fixed.UNKNOWN,
    "host_response_rate_pct": 0.0,
    "host_acceptance_rate_pct": 0.0,
    "neighbourhood": fixed.UNKNOWN,
    "district": fixed.UNKNOWN,
    "accommodates": 1,
    "bedrooms": 1,
    **{s: 0.0 for s in LISTING_SCORE_COLUMNS},
}


def silver_listings(bronze: DataFrame, dim: DataFrame,
                    as_of: _dt.date | str | Column | None = None) -> DataFrame:
    """Cleaned listings (40 columns).

    Filters use the *raw* values: the price bounds apply to the local
    price, ``accommodates > 0`` to the un-defaulted count. The price tier
    is cut on the unrounded USD price, the output ``price_usd`` is rounded
    to cents; that is why everything after the lookup is one projection.
    The IN-list filter reaches the Parquet scan when bronze is a table.
    """
    c = F.col
    base = bronze.where(
        c("listing_id").isNotNull()
        & (c("price_raw") > fixed.PRICE_RAW_MIN_EXCLUSIVE)
        & (c("price_raw") < fixed.PRICE_RAW_MAX_EXCLUSIVE)
        & (c("accommodates") > 0)
        & in_dimension(c("city")))
    mapped = lookup_normalise(base, dim, key="city", amount="price_raw", code_out="currency",
                              amount_out="__price_usd")
    return mapped.select(*_listing_exprs(as_of))


def _listing_exprs(as_of) -> tuple[Column, ...]:
    c = F.col
    d = defaulted(LISTING_DEFAULTS)
    keep = lambda name: d.get(name, c(name))
    return (
        c("listing_id"), c("listing_name"), c("host_id"), c("host_since_date"), c("host_location"),
        c("host_listings_count"), c("host_is_superhost"), c("host_identity_verified"),
        c("host_has_profile_pic"), c("instant_bookable"),
        keep("host_response_time"), keep("host_response_rate_pct"), keep("host_acceptance_rate_pct"),
        c("city"), keep("neighbourhood"), keep("district"), c("latitude"), c("longitude"),
        c("property_type"), c("room_type"), keep("accommodates"), keep("bedrooms"), c("amenities"),
        c("currency"), c("price_raw"),
        round_dec(c("__price_usd"), 2).alias("price_usd"),
        c("minimum_nights"), c("maximum_nights"),
        *[keep(s) for s in LISTING_SCORE_COLUMNS],
        years_between(c("host_since_date"), as_date(as_of)).alias("host_years_active"),
        tier(c("minimum_nights"), fixed.STAY_TIERS, fixed.STAY_OTHER, closed=True).alias("stay_type"),
        tier(c("__price_usd"), fixed.PRICE_TIERS, fixed.PRICE_OTHER, closed=False).alias("price_category"),
        label(c("host_is_superhost"), fixed.SUPERHOST, fixed.REGULAR_HOST).alias("host_type"),
        c("loaded_at"),
    )


def silver_reviews(bronze: DataFrame) -> DataFrame:
    """Reviews with a date, plus calendar attributes (13 columns)."""
    d = F.col("review_date")
    return bronze.where(d.isNotNull()).select(
        "review_id", "listing_id", "reviewer_id", "review_date", *date_dimension(d), "loaded_at")
