"""Snapshots: versions that change in one step, the ledger, and the daily run on both."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum import fixed
from stratum.operators.quality import GateError
from stratum.plans import queries as Q
from stratum.plans import run as R
from stratum.sources import binding
from stratum.sources.snapshots import Snapshots, digest_of, files_digest
from stratum.sources.tables import read_table


def test_versions_and_reads(spark, scratch):
    store = Snapshots(spark, scratch)
    assert store.versions() == []
    with pytest.raises(LookupError):
        store.read("gold", "t")
    a, b = store.write(spark.range(3), "gold", "t"), store.write(spark.range(7), "bronze", "u")
    assert store.versions() == []  # written, not published
    assert store.publish({("gold", "t"): a, ("bronze", "u"): b}) == 1
    later = store.write(spark.range(5), " Gold ", "t")
    assert store.read("gold", "t").count() == 3
    assert store.publish({("gold", "t"): later}) == 2
    assert store.read("gold", "t").count() == 5 and store.read("gold", "t", 1).count() == 3
    assert read_table(spark, scratch, "gold", "t").count() == 5 and read_table(spark, scratch, "gold", "t", 1).count() == 3
    with pytest.raises(LookupError):
        store.read("bronze", "u")  # a version holds its own tables only
    assert Snapshots(spark, scratch).versions() == [1, 2]


def test_published_numbers_are_never_replaced(spark, scratch, monkeypatch):
    store, other = Snapshots(spark, scratch), Snapshots(spark, scratch)
    t = store.write(spark.range(1), "gold", "t")
    assert other.publish({("gold", "t"): t}) == 1
    stale = iter([[], [1]])
    monkeypatch.setattr(store, "versions", lambda: next(stale))  # it looked before the other had published
    assert store.publish({("gold", "t"): t}) == 2


def test_ledger_takes_finished_writes(spark, scratch):
    store = Snapshots(spark, scratch)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(10).mapInArrow(counted, "id long")
    first = store.write(df, "bronze", "t", key=digest_of("t", 1), metrics={"top": F.max("id")})
    again = store.write(df, "bronze", "t", key=digest_of("t", 1))
    assert seen.value == 10 and again.reused and not first.reused
    assert again.path == first.path and again.metrics == first.metrics == {"rows": 10, "top": 9}
    assert store.write(df, "bronze", "t", key=digest_of("t", 2)).path != first.path


def test_files_digest_follows_the_files(spark, scratch):
    with open(f"{scratch}/a.csv", "w") as f:
        f.write("x\n")
    before = files_digest(spark, [scratch])
    assert files_digest(spark, [scratch]) == before
    with open(f"{scratch}/b.csv", "w") as f:
        f.write("y\n")
    assert files_digest(spark, [scratch]) != before


def _inputs(spark):
    listings = binding.raw_listings(spark, SF_SMALL).where(F.col("city").isin(*fixed.CITIES) & (F.col("price") != "abc"))
    return listings, binding.raw_reviews(spark, SF_SMALL).where(F.col("date") != "2024-02-30")


def _run(spark, root, log, **options):
    return R.run_daily(spark, *_inputs(spark), root, as_of=Q.AS_OF, batch_ts=Q.BATCH_TS, log=log.append, **options)


def test_failing_and_killed_runs_leave_the_earlier_version(spark, scratch, monkeypatch):
    log = []
    _run(spark, scratch, log, input_key="one")
    wanted = sorted(map(tuple, read_table(spark, scratch, "gold", "fct_revenue_by_city").collect()))
    assert "published version 1" in log

    with pytest.raises(GateError):  # all tables written, the last gate fails
        _run(spark, scratch, [], input_key="two", min_rows=(("fct_seasonal_trends", 10 ** 9),))
    with monkeypatch.context() as m:  # dies between two gold tables
        m.setattr(R, "fct_seasonal_trends", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            _run(spark, scratch, [], input_key="three")
    assert Snapshots(spark, scratch).versions() == [1]
    assert sorted(map(tuple, read_table(spark, scratch, "gold", "fct_revenue_by_city").collect())) == wanted

    # the rerun begins with the first table that is missing
    log = []
    _run(spark, scratch, log, input_key="three")
    done = [line.split(":")[0] for line in log if line.startswith(("kept", "wrote"))]
    assert done == ["kept raw_listings", "kept raw_reviews", "kept bronze_listings", "kept bronze_reviews",
                    "kept fct_revenue_by_city", "kept fct_superhost_performance", "wrote fct_seasonal_trends",
                    "wrote fct_price_vs_rating"]
    assert Snapshots(spark, scratch).versions() == [1, 2]


def test_gates_start_no_count_job(spark, scratch, monkeypatch):
    from stratum.operators import quality
    for name in ("row_counts", "gate_min_rows", "gate_non_empty"):
        monkeypatch.setattr(quality, name, lambda *a, **k: pytest.fail("a table was counted anew"))
    log = []
    models = _run(spark, scratch, log)
    rows = {line.split()[1].rstrip(":"): int(line.split()[2]) for line in log if line.startswith("wrote")}
    for name in ("bronze_listings", "bronze_reviews", "fct_price_vs_rating"):
        assert rows[name] == models[name].count()
