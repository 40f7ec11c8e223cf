from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]").appName("stratum-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratum-test-ckpt-"))
    yield spark


@pytest.fixture()
def scratch():
    """A fresh folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="stratum-test-")


def listing_row(**over):
    """One raw listings row (all text) with sane defaults; override fields by name."""
    from stratum import fixed
    base = {c: None for c in fixed.RAW_LISTING_COLUMNS}
    base.update(listing_id="1", name="flat", host_id="10", host_since="2020-05-01",
                host_is_superhost="t", host_listings_count="2", instant_bookable="f",
                city="New York", property_type="Apartment", room_type="Entire place",
                accommodates="2", bedrooms="1", price="100", minimum_nights="2",
                maximum_nights="30", review_scores_rating="90", review_scores_cleanliness="80",
                review_scores_value="85", review_scores_location="95",
                review_scores_communication="88")
    base.update(over)
    return tuple(base[c] for c in fixed.RAW_LISTING_COLUMNS)


def raw_listings_df(spark, rows, batch_ts="2025-01-01 06:00:00"):
    from stratum import fixed
    from stratum.operators.cleanse import null_tokens, with_load_time
    schema = ", ".join(f"{c} string" for c in fixed.RAW_LISTING_COLUMNS)
    return with_load_time(null_tokens(spark.createDataFrame(rows, schema)), batch_ts)


def raw_reviews_df(spark, rows, batch_ts="2025-01-01 06:00:00"):
    from stratum.operators.cleanse import null_tokens, with_load_time
    df = spark.createDataFrame(rows, "listing_id string, review_id string, date string, reviewer_id string")
    return with_load_time(null_tokens(df), batch_ts)
