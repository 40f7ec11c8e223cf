"""Profiler against a pandas brute force; data tests and gates."""

import pytest
from pyspark.sql import functions as F

from stratum import fixed
from stratum.operators import profile
from stratum.operators.coverage import uncovered
from stratum.operators.lookup import city_dimension
from stratum.operators.quality import (GateError, accepted_values, gate_coverage, gate_min_rows,
                                       gate_non_empty, not_null, raise_on_failures, run_data_tests,
                                       unique)

ROWS = [
    ("Paris", "t", "Entire place", "$1,200", "2", "2024-01-01"),
    ("Paris", "f", "Private room", "80", None, "x"),
    ("Rome", None, "Entire place", "abc", "3", "7"),
    ("Paris", "t", "Entire place", "$1,200", "2", "2024-01-01"),
    (None, "t", None, "15.5", "1.5", None),
]
COLS = ["city", "host_is_superhost", "room_type", "price", "bedrooms", "misc"]


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame(ROWS, ", ".join(f"{c} string" for c in COLS))


def test_null_summary(frames):
    got = {r.column_name: (r.nulls, r.null_pct) for r in profile.null_summary(frames).collect()}
    assert got == {c: (1, 20.0) for c in ("city", "host_is_superhost", "room_type", "bedrooms", "misc")}
    assert profile.null_summary(frames, 20.0).count() == 0  # 20% is not > 20%


def test_value_and_distinct_counts(frames):
    counts = profile.value_counts(frames)
    got = {(r.column_name, r.value): r.n for r in counts.collect() if r.column_name in ("city", "room_type")}
    assert got == {("city", "Paris"): 3, ("city", "Rome"): 1, ("city", None): 1,
                   ("room_type", "Entire place"): 3, ("room_type", "Private room"): 1, ("room_type", None): 1}
    distinct = {r.column_name: r.distinct_values for r in profile.distinct_counts(counts).collect()}
    assert (distinct["city"], distinct["room_type"]) == (2, 2)


def test_duplicate_rows_is_one_combined_grouping(frames):
    got = profile.duplicate_rows(frames)
    assert got.first().duplicate_rows == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("hashpartitioning") == 1 and "partial_count" in plan


def test_numeric_ranges(frames):
    got = {r.column_name: tuple(r)[1:] for r in profile.numeric_ranges(frames).collect()}
    # prices 1200, 80, 1200, 15.5 (one is no number); bedrooms 2, 3, 2, 1.5 (one is missing)
    assert got["price"] == (15.5, 1200.0, 623.88, 1) and got["bedrooms"] == (1.5, 3.0, 2.13, 1)


def test_large_values_are_neither_lost_nor_fatal(spark):
    df = spark.createDataFrame([("1e30",), ("1e999",), ("12345678901234567890",), ("5",)], "price string")
    r = profile.numeric_ranges(df, ["price"]).first()
    assert (r.min_value, r.max_value, r.nulls) == (5.0, float("inf"), 0)
    from stratum.functions.parse import try_number
    with pytest.raises(Exception, match="beyond 64 bits"):
        df.select(try_number("price")).collect()


def test_type_census(frames):
    df = frames
    got = {r.column_name: r for r in profile.type_census(df).collect()}
    assert got["misc"].mixed and (got["misc"].date_values, got["misc"].integer_values, got["misc"].text_values) == (2, 1, 1)
    assert got["bedrooms"].mixed and got["bedrooms"].decimal_values == 1
    assert not got["city"].mixed and got["city"].text_values == 4


def test_profile_report_sections(frames):
    df = frames
    sections = {r.section for r in profile.profile_report(df, "t").collect()}
    assert sections == {"shape", "duplicates", "nulls", "values", "distinct", "ranges", "types"}


def test_profile_report_coverage_section(spark):
    df = spark.createDataFrame([("Atlantis",), ("Atlantis",), ("Paris",)], "city string")
    rows = [r for r in profile.profile_report(df, "t", dim=city_dimension(spark)).collect()
            if r.section == "coverage"]
    assert [(r.column_name, r.value, r.metric, r.amount) for r in rows] == [("city", "Atlantis", "rows", 2.0)]


def test_coverage(spark, frames):
    df = frames
    assert uncovered(df, "city", city_dimension(spark)).count() == 0
    atl = spark.createDataFrame([("Atlantis",), ("Atlantis",), ("Paris",), (None,)], "city string")
    assert [(r.city, r.rows) for r in uncovered(atl, "city", city_dimension(spark)).collect()] == [("Atlantis", 2)]
    with pytest.raises(GateError, match="Atlantis"):
        gate_coverage(atl, "city", city_dimension(spark))


def test_column_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "zz"), (3, "zz")], "k bigint, v string")
    nn = {r.column_name: r.failures for r in not_null(df, "t", [(1, "k"), (2, "v")]).collect()}
    assert nn == {"k": 1, "v": 1}
    assert unique(df, "t", "k").first().failures == 1          # value 1 twice; NULL ignored
    assert accepted_values(df, "t", "v", ["a", "b"]).first().failures == 1   # 'zz' once, NULL passes


def test_run_data_tests_numbering_and_raise(spark):
    df = spark.createDataFrame([(None,)], "city string")
    res = run_data_tests({"fct_revenue_by_city": df.withColumn("total_listings", F.lit(1))
                          .withColumn("avg_price_usd", F.lit(1.0))})
    got = {(r.column_name, r.test_name): (r.test_id, r.failures) for r in res.collect()}
    assert got[("city", "not_null")] == (25, 1) and got[("city", "unique")] == (26, 0)
    with pytest.raises(GateError, match="fct_revenue_by_city.city not_null"):
        raise_on_failures(res)


def test_gates(spark):
    assert gate_min_rows({"a": (spark.range(3), 3)}) == {"a": 3}
    with pytest.raises(GateError, match="only 2 rows"):
        gate_min_rows({"a": (spark.range(2), 3)})
    with pytest.raises(GateError, match="empty"):
        gate_non_empty({"raw_reviews": spark.range(0)})
    assert len(fixed.DATA_TESTS) == 40
    kinds = [t[2] for t in fixed.DATA_TESTS]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (28, 3, 9)


def test_presentation_order(frames):
    df = frames
    nulls = [r.column_name for r in profile.ordered_nulls(profile.null_summary(df)).collect()]
    assert nulls == ["bedrooms", "city", "host_is_superhost", "misc", "room_type"]  # all 1 null: by name
    counts = [r.n for r in profile.ordered_values(profile.value_counts(df)).collect()
              if r.column_name == "room_type"]
    assert counts == sorted(counts, reverse=True)


def test_duplicate_rows_survive_hash_collisions(spark):
    # Spark's row hashes skip NULLs, so (a, NULL) and (NULL, a) collide; they are not duplicates
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), ("b", "c")], "x string, y string")
    assert df.select(F.xxhash64("x", "y")).distinct().count() == 2   # the collision is real
    assert profile.duplicate_rows(df).first().duplicate_rows == 1
