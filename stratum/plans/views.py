"""The silver models as SQL text, so that they can be kept as views and outlive the session that made them.

``{bronze_listings}`` and ``{bronze_reviews}`` stand for the tables the views read. The texts
give the rows of :mod:`stratum.plans.silver`; without a run date a view takes the day on which
it is read.
"""

from __future__ import annotations

import datetime as _dt

from stratum import fixed
from stratum.plans.silver import LISTING_DEFAULTS
from stratum.sources.snapshots import View


def _lit(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def _tier(column: str, bounds, otherwise: str, op: str) -> str:
    arms = " ".join(f"WHEN {column} {op} {_lit(bound)} THEN {_lit(name)}" for bound, name in bounds)
    return f"CASE {arms} ELSE {_lit(otherwise)} END"


def silver_listings_sql(as_of: _dt.date | str | None = None) -> str:
    day = "current_date()" if as_of is None else f"DATE {_lit(str(as_of))}"
    kept = {c: f"COALESCE({c}, {_lit(v)}) AS {c}" for c, v in LISTING_DEFAULTS.items()}
    columns = ", ".join(kept.get(c, c) for c in (
        "listing_id", "listing_name", "host_id", "host_since_date", "host_location", "host_listings_count",
        "host_is_superhost", "host_identity_verified", "host_has_profile_pic", "instant_bookable",
        "host_response_time", "host_response_rate_pct", "host_acceptance_rate_pct", "city", "neighbourhood",
        "district", "latitude", "longitude", "property_type", "room_type", "accommodates", "bedrooms", "amenities",
        "currency", "price_raw"))
    cities = ", ".join(f"({_lit(c)}, {_lit(code)}, {_lit(float(rate))})" for c, code, rate in fixed.CITY_CURRENCY_RATES)
    return f"""
SELECT {columns},
  COALESCE(CAST(round(try_cast(usd AS DECIMAL(28,10)), 2) AS DOUBLE), round(usd, 2)) AS price_usd,
  minimum_nights, maximum_nights, {", ".join(kept[c] for c in fixed.SCORE_COLUMNS)},
  year({day}) - year(host_since_date) AS host_years_active,
  {_tier("minimum_nights", fixed.STAY_TIERS, fixed.STAY_OTHER, "<=")} AS stay_type,
  {_tier("usd", fixed.PRICE_TIERS, fixed.PRICE_OTHER, "<")} AS price_category,
  CASE WHEN host_is_superhost THEN {_lit(fixed.SUPERHOST)} ELSE {_lit(fixed.REGULAR_HOST)} END AS host_type,
  loaded_at
FROM (
  SELECT b.*, COALESCE(d.code, {_lit(fixed.DEFAULT_CURRENCY)}) AS currency,
         b.price_raw * COALESCE(d.rate, {_lit(fixed.DEFAULT_RATE)}) AS usd
  FROM {{bronze_listings}} b LEFT JOIN (VALUES {cities}) AS d(town, code, rate) ON b.city = d.town
  WHERE b.listing_id IS NOT NULL AND b.price_raw > {fixed.PRICE_RAW_MIN_EXCLUSIVE}
    AND b.price_raw < {fixed.PRICE_RAW_MAX_EXCLUSIVE} AND b.accommodates > 0
    AND b.city IN ({", ".join(map(_lit, fixed.CITIES))}))"""


def silver_reviews_sql() -> str:
    seasons = " ".join(f"WHEN month(review_date) IN ({', '.join(map(str, months))}) THEN {_lit(name)}"
                       for months, name in fixed.SEASONS)
    return f"""
SELECT review_id, listing_id, reviewer_id, review_date,
  trunc(review_date, 'month') AS review_month, trunc(review_date, 'year') AS review_year,
  dayofweek(review_date) - 1 AS day_of_week, date_format(review_date, 'MMM') AS month_name,
  month(review_date) AS month_number, year(review_date) AS year_number, quarter(review_date) AS quarter_number,
  CASE {seasons} ELSE {_lit(fixed.SEASON_OTHER)} END AS season, loaded_at
FROM {{bronze_reviews}} WHERE review_date IS NOT NULL"""


def silver_views(as_of: _dt.date | str | None = None) -> dict[tuple[str, str], View]:
    """(layer, name) -> view of the silver models over the bronze tables of the same version."""
    return {("silver", "silver_listings"): View(silver_listings_sql(as_of), {"bronze_listings": ("bronze", "bronze_listings")}),
            ("silver", "silver_reviews"): View(silver_reviews_sql(), {"bronze_reviews": ("bronze", "bronze_reviews")})}
