"""Fixed values.

Everything in this module must equal the values the original pipeline
uses, otherwise results differ. They are kept together, in their natural
order, so they can be checked against the source at a glance.
"""

from __future__ import annotations

# --- fixed values: loader ---------------------------------------------------

# Tokens read as NULL by the bulk loader (empty fields are NULL as well).
NULL_TOKENS = ("", "NULL", "null", "NA")

# Source files that must be present in the landing area before a load.
REQUIRED_SOURCES = ("Listings_utf8.csv", "Reviews_utf8.csv")

# Raw listings columns, in file order (the load is positional).
RAW_LISTING_COLUMNS = (
    "listing_id", "name", "host_id", "host_since", "host_location",
    "host_response_time", "host_response_rate", "host_acceptance_rate",
    "host_is_superhost", "host_listings_count", "host_identity_verified",
    "host_has_profile_pic", "neighbourhood", "district", "city",
    "latitude", "longitude", "property_type", "room_type",
    "accommodates", "bedrooms", "amenities", "price",
    "minimum_nights", "maximum_nights",
    "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_communication", "review_scores_location",
    "review_scores_value", "instant_bookable",
)

# Raw reviews columns, in file order.
RAW_REVIEW_COLUMNS = ("listing_id", "review_id", "date", "reviewer_id")

# --- fixed values: city dimension --------------------------------------------

# (city, currency, USD rate). Unmapped cities fall back to the defaults.
CITY_CURRENCY_RATES = (
    ("New York", "USD", 1.00),
    ("Paris", "EUR", 1.08),
    ("Rome", "EUR", 1.08),
    ("Sydney", "AUD", 0.65),
    ("Bangkok", "THB", 0.028),
    ("Cape Town", "ZAR", 0.054),
    ("Mexico City", "MXN", 0.058),
    ("Istanbul", "TRY", 0.031),
    ("Hong Kong", "HKD", 0.128),
    ("Rio de Janeiro", "BRL", 0.20),
)
DEFAULT_CURRENCY = "USD"
DEFAULT_RATE = 1.0

CITIES = tuple(c for c, _, _ in CITY_CURRENCY_RATES)
CURRENCIES = ("USD", "EUR", "AUD", "THB", "ZAR", "MXN", "TRY", "HKD", "BRL")

# --- fixed values: cleansing rules -------------------------------------------

# Raw local-currency price must lie strictly inside these bounds.
PRICE_RAW_MIN_EXCLUSIVE = 0
PRICE_RAW_MAX_EXCLUSIVE = 10000

UNKNOWN = "Unknown"

# Minimum nights tiers: value <= bound gets the label; otherwise the last one.
STAY_TIERS = ((1, "Flexible"), (7, "Weekly"), (30, "Monthly"))
STAY_OTHER = "Long Stay"

# Price tiers on the USD price: value < bound gets the label.
PRICE_TIERS = ((50, "Budget"), (150, "Mid-range"), (300, "Premium"))
PRICE_OTHER = "Luxury"

SUPERHOST = "Superhost"
REGULAR_HOST = "Regular Host"

# The review score columns, in loader order.
SCORE_COLUMNS = ("review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
                 "review_scores_checkin", "review_scores_communication", "review_scores_location",
                 "review_scores_value")

# Months of each season (northern hemisphere for every city).
SEASONS = (((12, 1, 2), "Winter"), ((3, 4, 5), "Spring"), ((6, 7, 8), "Summer"))
SEASON_OTHER = "Autumn"

STAY_TYPES = tuple(label for _, label in STAY_TIERS) + (STAY_OTHER,)
PRICE_CATEGORIES = tuple(label for _, label in PRICE_TIERS) + (PRICE_OTHER,)
HOST_TYPES = (SUPERHOST, REGULAR_HOST)
SEASON_NAMES = ("Winter", "Spring", "Summer", "Autumn")

# --- fixed values: gates ------------------------------------------------------

# Minimum row count of each gold table.
GOLD_MIN_ROWS = (
    ("fct_revenue_by_city", 10),
    ("fct_superhost_performance", 20),
    ("fct_seasonal_trends", 100),
    ("fct_price_vs_rating", 100),
)

# Columns whose null rate above this percentage is reported (informational).
NULL_RATE_REPORT_PCT = 5.0

# --- fixed values: profiler ---------------------------------------------------

PROFILE_CATEGORICAL = ("city", "host_is_superhost", "room_type", "property_type", "instant_bookable")
PROFILE_NUMERIC = ("price", "accommodates", "bedrooms", "minimum_nights", "maximum_nights")

# --- fixed values: declarative data tests (28 not_null, 3 unique, 9 accepted) --

DATA_TESTS = (
    ("bronze_listings", "listing_id", "not_null", None),
    ("bronze_listings", "listing_id", "unique", None),
    ("bronze_listings", "price_raw", "not_null", None),
    ("bronze_reviews", "review_id", "not_null", None),
    ("bronze_reviews", "listing_id", "not_null", None),
    ("bronze_reviews", "review_date", "not_null", None),
    ("silver_listings", "listing_id", "not_null", None),
    ("silver_listings", "listing_id", "unique", None),
    ("silver_listings", "city", "not_null", None),
    ("silver_listings", "city", "accepted_values", CITIES),
    ("silver_listings", "price_usd", "not_null", None),
    ("silver_listings", "price_category", "not_null", None),
    ("silver_listings", "price_category", "accepted_values", PRICE_CATEGORIES),
    ("silver_listings", "host_type", "not_null", None),
    ("silver_listings", "host_type", "accepted_values", HOST_TYPES),
    ("silver_listings", "stay_type", "not_null", None),
    ("silver_listings", "stay_type", "accepted_values", STAY_TYPES),
    ("silver_listings", "currency", "not_null", None),
    ("silver_listings", "currency", "accepted_values", CURRENCIES),
    ("silver_reviews", "review_id", "not_null", None),
    ("silver_reviews", "listing_id", "not_null", None),
    ("silver_reviews", "season", "not_null", None),
    ("silver_reviews", "season", "accepted_values", SEASON_NAMES),
    ("silver_reviews", "review_date", "not_null", None),
    ("fct_revenue_by_city", "city", "not_null", None),
    ("fct_revenue_by_city", "city", "unique", None),
    ("fct_revenue_by_city", "total_listings", "not_null", None),
    ("fct_revenue_by_city", "avg_price_usd", "not_null", None),
    ("fct_superhost_performance", "city", "not_null", None),
    ("fct_superhost_performance", "host_type", "not_null", None),
    ("fct_superhost_performance", "host_type", "accepted_values", HOST_TYPES),
    ("fct_superhost_performance", "total_listings", "not_null", None),
    ("fct_seasonal_trends", "city", "not_null", None),
    ("fct_seasonal_trends", "season", "not_null", None),
    ("fct_seasonal_trends", "season", "accepted_values", SEASON_NAMES),
    ("fct_seasonal_trends", "total_reviews", "not_null", None),
    ("fct_price_vs_rating", "city", "not_null", None),
    ("fct_price_vs_rating", "price_category", "not_null", None),
    ("fct_price_vs_rating", "price_category", "accepted_values", PRICE_CATEGORIES),
    ("fct_price_vs_rating", "total_listings", "not_null", None),
)
