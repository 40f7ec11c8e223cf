"""Bronze models: typed copies of the raw loads.

Each model is one projection over its input (plus a key filter), so the
whole model is a single code-generated stage; only the review
deduplication shuffles (by ``review_id``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import fixed
from stratum.functions.parse import flag, percent, strict_int, try_date, try_double, try_number
from stratum.operators.dedupe import keep_first

LISTING_SCORE_COLUMNS = fixed.SCORE_COLUMNS


def bronze_listings(raw: DataFrame) -> DataFrame:
    """raw_listings (text + loaded_at) -> 35 typed columns; rows without a raw id dropped."""
    return raw.where(F.col("listing_id").isNotNull()).select(*_listing_exprs())


def _listing_exprs() -> tuple[Column, ...]:
    c = F.col
    return (
        try_number("listing_id").alias("listing_id"),
        try_number("host_id").alias("host_id"),
        c("name").alias("listing_name"),
        c("host_since").alias("host_since_raw"),
        try_date("host_since").alias("host_since_date"),
        c("host_location"),
        try_number("host_listings_count").alias("host_listings_count"),
        flag("host_is_superhost").alias("host_is_superhost"),
        flag("host_identity_verified").alias("host_identity_verified"),
        flag("host_has_profile_pic").alias("host_has_profile_pic"),
        flag("instant_bookable").alias("instant_bookable"),
        c("host_response_time"),
        percent("host_response_rate").alias("host_response_rate_pct"),
        percent("host_acceptance_rate").alias("host_acceptance_rate_pct"),
        c("city"),
        c("neighbourhood"),
        c("district"),
        try_double("latitude").alias("latitude"),
        try_double("longitude").alias("longitude"),
        c("property_type"),
        c("room_type"),
        try_number("accommodates").alias("accommodates"),
        try_number("bedrooms").alias("bedrooms"),
        c("amenities"),
        try_double("price").alias("price_raw"),
        try_number("minimum_nights").alias("minimum_nights"),
        try_number("maximum_nights").alias("maximum_nights"),
        *[try_double(s).alias(s) for s in LISTING_SCORE_COLUMNS],
        c("loaded_at"),
    )


def _review_exprs() -> tuple[Column, ...]:
    return (strict_int("listing_id", "listing_id").alias("listing_id"),
            strict_int("review_id", "review_id").alias("review_id"),
            try_date("date").alias("review_date"),
            strict_int("reviewer_id", "reviewer_id").alias("reviewer_id"),
            F.col("loaded_at"))


def bronze_reviews(raw: DataFrame) -> DataFrame:
    """raw_reviews -> typed, one row per review_id.

    Ids are hard-cast (bad text fails the run). Among duplicates the first
    load wins; inside one load the earliest review date, then the smallest
    reviewer and listing id, so the survivor is deterministic.
    """
    c = F.col
    typed = (raw.where(c("listing_id").isNotNull() & c("review_id").isNotNull())
             .select(*_review_exprs()))
    order = [c("loaded_at").asc_nulls_last(), c("review_date").asc_nulls_last(),
             c("reviewer_id").asc_nulls_last(), c("listing_id").asc_nulls_last()]
    return keep_first(typed, ["review_id"], order).select(
        "listing_id", "review_id", "review_date", "reviewer_id", "loaded_at")
