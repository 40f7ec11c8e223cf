"""Reports from merged states against the report over all rows."""

import pytest
from pyspark.sql import functions as F

from stratum.operators.lookup import city_dimension
from stratum.operators.profile import profile_report
from stratum.operators.profile_states import profile_states, report_from_states, stored_states
from stratum.sources.snapshots import Snapshots

COLS = ["city", "room_type", "price", "bedrooms", "misc"]
ROWS = [("Paris", "Entire place", "$1,200", "2", "2024-01-01"), ("Paris", "Private room", "80", None, "x"),
        ("Atlantis", "Entire place", "abc", "3", "7"), ("Paris", "Entire place", "$1,200", "2", "2024-01-01"),
        (None, None, "15.5", "1.5", None), ("Atlantis", "", "0.1", "", "n" * 50_000), (None, None, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS))


def report(df):
    return sorted(df.collect(), key=repr)


@pytest.mark.parametrize("cuts", [(0, 7), (0, 3, 7), (0, 1, 1, 4, 7)])
def test_report_from_states_equals_the_full_report(spark, cuts):
    """However the rows are dealt over files (one of them empty), copies across files included."""
    states = None
    for a, b in zip(cuts, cuts[1:]):
        part = profile_states(frame(spark, ROWS[a:b]))
        states = part if states is None else states.unionByName(part)
    dim = city_dimension(spark)
    got = report_from_states(states, COLS, dim=dim)
    want = profile_report(frame(spark, ROWS), "x", dim=dim)
    assert got.columns == want.columns and report(got) == report(want)


def test_no_rows(spark):
    got = {(r.section, r.column_name, r.metric): r.amount
           for r in report_from_states(profile_states(frame(spark, [])), COLS).collect()}
    assert got[("shape", None, "rows")] == 0 and got[("duplicates", None, "duplicate_rows")] == 0
    assert got[("ranges", "price", "min_value")] is None and got[("ranges", "price", "nulls")] == 0


def test_only_a_new_file_is_scanned(spark, scratch):
    store = Snapshots(spark, f"{scratch}/store")
    first = {"jan": frame(spark, ROWS[:3]), "feb": frame(spark, ROWS[3:5])}
    _, tables = stored_states(store, first, {"jan": "k1", "feb": "k2"}, "listings")
    assert not any(t.reused for t in tables.values())
    # reading an old file again would fail
    gone = frame(spark, ROWS[:1]).withColumn("city", F.raise_error(F.lit("scanned")).cast("string"))
    later = {"jan": gone, "feb": gone, "mar": frame(spark, ROWS[5:])}
    states, tables = stored_states(store, later, {"jan": "k1", "feb": "k2", "mar": "k3"}, "listings")
    assert {f: t.reused for f, t in tables.items()} == {"jan": True, "feb": True, "mar": False}
    assert report(report_from_states(states, COLS)) == report(profile_report(frame(spark, ROWS), "x"))
    with pytest.raises(Exception, match="scanned"):  # a changed file has another key
        stored_states(store, later, {"jan": "k9", "feb": "k2", "mar": "k3"}, "listings")


def test_coverage_needs_the_values_of_its_key(spark):
    with pytest.raises(ValueError, match="city"):
        report_from_states(profile_states(frame(spark, ROWS), ()), COLS, categorical=(), dim=city_dimension(spark))


def test_states_classify_cells_after_the_unpivot(spark):
    """The plan has the patterns once, however many columns there are, and digests are grouped apart."""
    got = profile_states(frame(spark, ROWS))
    plan = got._jdf.queryExecution().optimizedPlan()
    assert plan.toString().startswith("Union") and 0 < plan.toString().count("RLIKE") < len(COLS)
