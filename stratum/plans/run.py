"""The daily run: ordered stages with gates between them.

Stages stay lazy until a gate or a table write. Raw, bronze and gold are written as Parquet
tables and read back, so every later stage starts from files (lineage is cut, a lost executor
re-reads instead of recomputing); silver stays a lazy view, as in the original layering, and is
published as SQL text, so that later sessions read it by name.

Write, audit, publish: each table goes to a folder of its own, the tests and gates look at
those folders, and only a run that passes them all makes its tables the newest version, in one
step (:mod:`stratum.sources.snapshots`). Readers keep the earlier version until then, and a run
that fails or dies changes nothing for them. Row counts are seen by the writes themselves; no
gate counts a table anew. A run over the same input with the same parameters takes the tables
that an earlier, unfinished one has written, and begins with the first that is missing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from stratum import fixed
from stratum.operators.cleanse import null_tokens, with_load_time
from stratum.operators.lookup import city_dimension
from stratum.operators.profile import null_summary
from stratum.operators.quality import GateError, gate_counts, gate_coverage, raise_on_failures, run_data_tests
from stratum.plans.bronze import bronze_listings, bronze_reviews
from stratum.plans.gold import (fct_price_vs_rating, fct_revenue_by_city, fct_seasonal_trends,
                                fct_superhost_performance)
from stratum.plans.silver import silver_listings, silver_reviews
from stratum.plans.views import silver_views
from stratum.sources.csv import read_csv_positional
from stratum.sources.presence import require_sources
from stratum.sources.snapshots import Snapshots, Table, digest_of, files_digest
from stratum.sources.tables import layer_path, register_view


def build_models(raw_listings: DataFrame, raw_reviews: DataFrame, dim: DataFrame,
                 as_of=None) -> dict[str, DataFrame]:
    """The eight models as lazy DataFrames over the given raw inputs."""
    return models_over(bronze_listings(raw_listings), bronze_reviews(raw_reviews), dim, as_of)


def models_over(bl: DataFrame, br: DataFrame, dim: DataFrame, as_of=None) -> dict[str, DataFrame]:
    """The eight models over the bronze tables."""
    sl = silver_listings(bl, dim, as_of)
    sr = silver_reviews(br)
    return {
        "bronze_listings": bl, "bronze_reviews": br,
        "silver_listings": sl, "silver_reviews": sr,
        "fct_revenue_by_city": fct_revenue_by_city(sl),
        "fct_superhost_performance": fct_superhost_performance(sl),
        "fct_seasonal_trends": fct_seasonal_trends(sr, sl),
        "fct_price_vs_rating": fct_price_vs_rating(sl),
    }


def run_daily(spark: SparkSession, raw_listings: DataFrame, raw_reviews: DataFrame, root: str,
              as_of: _dt.date | str | None = None, batch_ts: _dt.datetime | str | None = None,
              min_rows=fixed.GOLD_MIN_ROWS, log=print, input_key: str | None = None) -> dict[str, DataFrame]:
    """Profile gate -> raw load -> non-empty gate -> bronze -> silver -> gold -> tests -> row gates -> publish.

    ``raw_*`` are all-text extracts (e.g. from :func:`read_csv_positional`). ``input_key``
    stands for their content: with one, finished tables of an earlier run with the same key,
    run date and batch time are taken over.
    Raises :class:`~stratum.operators.quality.GateError` at the first failing gate.
    Returns the models, gold and bronze read back from their tables. They are published only
    after the last gate: until then, and after a failure, readers see the version before.
    """
    dim = city_dimension(spark)

    store = Snapshots(spark, root)

    def stage(name: str, df: DataFrame, layer: str, after: tuple = ()) -> Table:
        """Writes a table, or takes it from an earlier run that had the same input."""
        key = None if input_key is None else digest_of(name, input_key, str(as_of), str(batch_ts), [t.path for t in after])
        table = store.write(df, layer, name, key)
        log(f"{'kept' if table.reused else 'wrote'} {name}: {table.metrics['rows']} rows")
        return table

    # profile gate: informational null rates, then hard lookup coverage
    listings_text = null_tokens(raw_listings)
    for r in null_summary(listings_text, fixed.NULL_RATE_REPORT_PCT).orderBy("null_pct").collect():
        log(f"null rate above {fixed.NULL_RATE_REPORT_PCT}%: {r.column_name} {r.null_pct}%")
    gate_coverage(listings_text, "city", dim, layer_path(root, "quarantine", "uncovered_city"))

    # full-refresh raw load, stamped with one batch time
    raw_l = stage("raw_listings", with_load_time(listings_text, batch_ts), "bronze")
    raw_r = stage("raw_reviews", with_load_time(null_tokens(raw_reviews), batch_ts), "bronze")
    raw = {"raw_listings": raw_l, "raw_reviews": raw_r}
    empty = [name for name, t in raw.items() if not t.metrics["rows"]]
    if empty:
        raise GateError(f"empty after load: {', '.join(empty)}")

    bl = stage("bronze_listings", bronze_listings(raw_l.read()), "bronze", (raw_l,))
    br = stage("bronze_reviews", bronze_reviews(raw_r.read()), "bronze", (raw_r,))
    sl = register_view(silver_listings(bl.read(), dim, as_of), "silver_listings")
    sr = register_view(silver_reviews(br.read()), "silver_reviews")
    gold = {
        "fct_revenue_by_city": stage("fct_revenue_by_city", fct_revenue_by_city(sl, order=False), "gold", (bl,)),
        "fct_superhost_performance": stage("fct_superhost_performance", fct_superhost_performance(sl, order=False),
                                           "gold", (bl,)),
        "fct_seasonal_trends": stage("fct_seasonal_trends", fct_seasonal_trends(sr, sl, order=False), "gold", (bl, br)),
        "fct_price_vs_rating": stage("fct_price_vs_rating", fct_price_vs_rating(sl, order=False), "gold", (bl,)),
    }
    models = {"bronze_listings": bl.read(), "bronze_reviews": br.read(), "silver_listings": sl, "silver_reviews": sr,
              **{name: t.read() for name, t in gold.items()}}

    raise_on_failures(run_data_tests(models))
    counts = gate_counts({name: t.metrics["rows"] for name, t in {**raw, **gold}.items()}, min_rows)
    log(f"gold row counts: {counts}")
    version = store.publish({("bronze", name): t for name, t in (*raw.items(), ("bronze_listings", bl), ("bronze_reviews", br))}
                            | {("gold", name): t for name, t in gold.items()}, silver_views(as_of))
    log(f"published version {version}")
    return models


def run_from_landing(spark: SparkSession, landing_dir: str, root: str,
                     as_of: _dt.date | str | None = None, batch_ts: _dt.datetime | str | None = None,
                     sources: tuple[str, str] = fixed.REQUIRED_SOURCES, encoding: str = "UTF-8",
                     min_rows=fixed.GOLD_MIN_ROWS, log=print, multiline: bool = True) -> dict[str, DataFrame]:
    """The whole daily run from a landing folder of CSV files.

    Presence gate on ``sources`` (listings, reviews) -> positional CSV loads
    with quarantine -> :func:`run_daily`. Malformed lines are logged as a
    count and kept under ``root``/QUARANTINE; they do not stop the load.
    """
    require_sources(spark, landing_dir, sources)
    base = landing_dir.rstrip("/")
    key = digest_of(files_digest(spark, [f"{base}/{s}" for s in sources]), encoding, multiline)
    listings, listing_rejects = read_csv_positional(
        spark, f"{base}/{sources[0]}", fixed.RAW_LISTING_COLUMNS, encoding=encoding, multiline=multiline,
        stage_to=layer_path(root, "quarantine", "listings_parsed"))
    reviews, review_rejects = read_csv_positional(
        spark, f"{base}/{sources[1]}", fixed.RAW_REVIEW_COLUMNS, encoding=encoding, multiline=multiline,
        stage_to=layer_path(root, "quarantine", "reviews_parsed"))
    for name, rejects in (("listings", listing_rejects), ("reviews", review_rejects)):
        n = rejects.count()
        if n:
            log(f"{name}: {n} malformed lines skipped")
    return run_daily(spark, listings, reviews, root, as_of=as_of, batch_ts=batch_ts,
                     min_rows=min_rows, log=log, input_key=key)
