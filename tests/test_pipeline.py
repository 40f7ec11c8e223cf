"""End-to-end gated run, the driver contract, and the oracle comparison."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum import fixed
from stratum.operators.quality import GateError
from stratum.plans import queries as Q
from stratum.plans.run import run_daily
from stratum.sources import binding


def _clean_inputs(spark):
    listings = (binding.raw_listings(spark, SF_SMALL)
                .where(F.col("city").isin(*fixed.CITIES) & (F.col("price") != "abc")))
    reviews = binding.raw_reviews(spark, SF_SMALL).where(F.col("date") != "2024-02-30")
    return listings, reviews


def test_daily_run_passes_on_clean_input(spark, scratch):
    listings, reviews = _clean_inputs(spark)
    models = run_daily(spark, listings, reviews, scratch, as_of=Q.AS_OF, batch_ts=Q.BATCH_TS,
                       log=lambda *_: None)
    gold = models["fct_revenue_by_city"].drop("updated_at")
    assert gold.count() == 10
    # the materialised gold table equals the lazily computed model over the same input
    from stratum.operators.cleanse import null_tokens, with_load_time
    from stratum.operators.lookup import city_dimension
    from stratum.plans.bronze import bronze_listings
    from stratum.plans.gold import fct_revenue_by_city
    from stratum.plans.silver import silver_listings
    lazy = fct_revenue_by_city(silver_listings(bronze_listings(with_load_time(null_tokens(listings), Q.BATCH_TS)),
                                               city_dimension(spark), Q.AS_OF)).drop("updated_at")
    assert sorted(map(tuple, gold.collect())) == sorted(map(tuple, lazy.collect()))


def test_daily_run_stops_at_coverage_gate(spark, scratch):
    with pytest.raises(GateError, match="NATION_1"):
        run_daily(spark, binding.raw_listings(spark, SF_SMALL), binding.raw_reviews(spark, SF_SMALL),
                  scratch, log=lambda *_: None)


def test_daily_run_stops_at_data_tests(spark, scratch):
    listings = binding.raw_listings(spark, SF_SMALL).where(F.col("city").isin(*fixed.CITIES))
    _, reviews = _clean_inputs(spark)
    with pytest.raises(GateError, match="bronze_listings.price_raw not_null"):
        run_daily(spark, listings, reviews, scratch, log=lambda *_: None)


def test_daily_run_stops_at_min_rows(spark, scratch):
    listings, reviews = _clean_inputs(spark)
    with pytest.raises(GateError, match="fct_seasonal_trends has only"):
        run_daily(spark, listings, reviews, scratch, min_rows=(("fct_seasonal_trends", 10 ** 9),),
                  log=lambda *_: None)


def test_entry_contract(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    df = entry(spark)
    assert df.count() == 10 and "updated_at" not in df.columns
    assert set(oracle_sql()) <= set(queries())


def test_every_query_matches_oracle_at_small_scale(spark):
    import oracle_check
    res = oracle_check.compare(spark, SF_SMALL, verbose=False)
    bad = {k: v for k, v in res.items() if v not in ("ok", "no-oracle")}
    assert not bad, bad
    assert sum(v == "ok" for v in res.values()) >= 27


def test_run_from_landing_csv(spark, scratch):
    import os
    from stratum.plans.run import run_from_landing
    from stratum.sources.csv import write_csv
    listings, reviews = _clean_inputs(spark)
    landing = os.path.join(scratch, "landing")
    write_csv(listings, os.path.join(landing, "Listings_utf8.csv"))
    write_csv(reviews, os.path.join(landing, "Reviews_utf8.csv"))
    with open(os.path.join(landing, "Listings_utf8.csv", "part-late.csv"), "w") as f:
        f.write("header,line\n999999,too,few,fields\n")   # quarantined, the load continues
    logs = []
    models = run_from_landing(spark, landing, os.path.join(scratch, "out"), as_of=Q.AS_OF,
                              batch_ts=Q.BATCH_TS, log=logs.append)
    direct = run_daily(spark, listings, reviews, os.path.join(scratch, "direct"), as_of=Q.AS_OF,
                       batch_ts=Q.BATCH_TS, log=lambda *_: None)
    for name in ("fct_revenue_by_city", "fct_seasonal_trends"):
        a = sorted(map(tuple, models[name].drop("updated_at").collect()))
        b = sorted(map(tuple, direct[name].drop("updated_at").collect()))
        assert a == b
    assert any("listings: 1 malformed lines skipped" in m for m in logs), logs
    with pytest.raises(GateError, match="Reviews_utf8.csv"):
        run_from_landing(spark, os.path.join(landing, "Listings_utf8.csv"), os.path.join(scratch, "x"))


def test_results_do_not_depend_on_session_settings(spark):
    import oracle_check
    keys = {"spark.sql.ansi.enabled": "false", "spark.sql.session.timeZone": "America/Los_Angeles"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        res = oracle_check.compare(spark, SF_SMALL, ["bronze_listings", "silver_reviews",
                                                     "fct_revenue_by_city", "years_active"], verbose=False)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert set(res.values()) == {"ok"}, res


def test_command_line_daily(spark, scratch):
    import os
    from stratum.__main__ import main
    from stratum.sources.csv import write_csv
    from stratum.sources.tables import read_table
    listings, reviews = _clean_inputs(spark)
    landing = os.path.join(scratch, "landing")
    write_csv(listings, os.path.join(landing, "Listings_utf8.csv"))
    write_csv(reviews, os.path.join(landing, "Reviews_utf8.csv"))
    out = os.path.join(scratch, "out")
    assert main(["daily", landing, out, "--as-of", Q.AS_OF]) == 0
    assert read_table(spark, out, "gold", "fct_revenue_by_city").count() == 10
    assert read_table(spark, out, "bronze", "bronze_reviews").count() > 0
