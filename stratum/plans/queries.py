"""Registered queries over the driver tables: one per operator / model.

Every query reads the given tables (through the binding) and runs over
all of their rows. Non-deterministic audit columns (``loaded_at``,
``updated_at``) are dropped, and the run date / batch time are fixed so
results are comparable across engines.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import fixed
from stratum.functions.dates import as_date, years_between
from stratum.functions.measures import avg_nonzero, count_when, distinct_if, ratio, round_dec
from stratum.operators.cleanse import null_tokens, with_load_time
from stratum.operators.coverage import uncovered
from stratum.operators.lookup import city_dimension
from stratum.operators import profile
from stratum.operators.numbering import with_positions
from stratum.operators.profile_states import report_from_states, stored_states
from stratum.operators.quality import row_counts, run_data_tests
from stratum.operators.states import grouped_states
from stratum.plans.bronze import bronze_listings, bronze_reviews
from stratum.plans.gold import (fct_price_vs_rating, fct_revenue_by_city, fct_seasonal_trends,
                                fct_superhost_performance)
from stratum.plans.run import build_models, models_over
from stratum.plans.silver import silver_listings, silver_reviews
from stratum.plans.views import silver_views
from stratum.session import shared_dir
from stratum.sources import binding
from stratum.sources.csv import read_csv_named, read_csv_positional, write_csv
from stratum.sources.snapshots import Snapshots
from stratum.sources.tables import materialize, read_table, write_table

AS_OF = "2025-01-01"
BATCH_TS = "2025-01-01 06:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings extract as loaded: null tokens removed, batch time stamped."""
    return with_load_time(null_tokens(binding.raw_listings(spark, sf_dir)), BATCH_TS)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_load_time(null_tokens(binding.raw_reviews(spark, sf_dir)), BATCH_TS)


def models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight models as lazy DataFrames over the extracts (the gated run materialises bronze)."""
    return build_models(raw_listings(spark, sf_dir), raw_reviews(spark, sf_dir),
                        city_dimension(spark), AS_OF)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_listings(bronze_listings(raw_listings(spark, sf_dir)), city_dimension(spark), AS_OF)


def _silver_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_reviews(bronze_reviews(raw_reviews(spark, sf_dir)))


# --- models -----------------------------------------------------------------------

def q_bronze_listings(spark, sf_dir):
    return bronze_listings(raw_listings(spark, sf_dir)).drop("loaded_at")


def q_bronze_reviews_dedupe(spark, sf_dir):
    return bronze_reviews(raw_reviews(spark, sf_dir)).drop("loaded_at")


def q_silver_listings(spark, sf_dir):
    return _silver(spark, sf_dir).drop("loaded_at")


def q_silver_reviews(spark, sf_dir):
    return _silver_reviews(spark, sf_dir).drop("loaded_at")


def q_fct_revenue_by_city(spark, sf_dir):
    return fct_revenue_by_city(_silver(spark, sf_dir)).drop("updated_at")


def q_fct_superhost_performance(spark, sf_dir):
    return fct_superhost_performance(_silver(spark, sf_dir)).drop("updated_at")


def q_fct_seasonal_trends(spark, sf_dir):
    return fct_seasonal_trends(_silver_reviews(spark, sf_dir), _silver(spark, sf_dir)).drop("updated_at")


def q_fct_price_vs_rating(spark, sf_dir):
    return fct_price_vs_rating(_silver(spark, sf_dir)).drop("updated_at")


# --- single operators -------------------------------------------------------------

def q_bronze_reviews_table(spark, sf_dir):
    """Full-refresh materialisation, read back."""
    root = shared_dir(spark, "tables")
    return write_table(bronze_reviews(raw_reviews(spark, sf_dir)), root, " bronze ", "bronze_reviews").drop("loaded_at")


def q_years_active(spark, sf_dir):
    b = bronze_listings(raw_listings(spark, sf_dir))
    return b.select("listing_id", "host_since_date",
                    years_between(F.col("host_since_date"), as_date(AS_OF)).alias("host_years_active"))


def q_null_tokens(spark, sf_dir):
    return null_tokens(binding.raw_listings(spark, sf_dir))


def _staged_csv(spark, sf_dir):
    out = binding.stage_listings_csv(spark, sf_dir, shared_dir(spark, "stage", "listings"))
    return read_csv_positional(spark, [f"{out}/good", f"{out}/extra", f"{out}/short"],
                               fixed.RAW_LISTING_COLUMNS, stage_to=f"{out}/parsed")


def q_csv_load_good(spark, sf_dir):
    return _staged_csv(spark, sf_dir)[0]


def q_csv_load_rejects(spark, sf_dir):
    return _staged_csv(spark, sf_dir)[1].select(F.col("listing_id").alias("first_field"), "line")


def q_uncovered_keys(spark, sf_dir):
    return uncovered(null_tokens(binding.raw_listings(spark, sf_dir)), "city", city_dimension(spark))


def q_avg_ignore_zero(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.groupBy("city").agg(
        round_dec(avg_nonzero(F.col("review_scores_rating")), 2).alias("avg_rating_nonzero"),
        round_dec(F.avg("review_scores_rating"), 2).alias("avg_rating_all"),
        round_dec(avg_nonzero(F.col("review_scores_value")), 2).alias("avg_value_nonzero"))


def q_price_stats_median(spark, sf_dir):
    p = F.col("price_usd")
    g = grouped_states(_silver(spark, sf_dir), ["room_type"], "price_usd", {"mean": p}, {}, {})
    return g.select("room_type", round_dec(F.col("mean"), 2).alias("avg_price_usd"),
                    round_dec(F.col("median"), 2).alias("median_price_usd"),
                    round_dec(F.col("low"), 2).alias("min_price_usd"), round_dec(F.col("high"), 2).alias("max_price_usd"))


def q_ratio_pct(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.groupBy("city").agg(
        ratio(distinct_if(F.col("host_is_superhost"), F.col("host_id")),
              F.count_distinct("host_id")).alias("superhost_host_pct"),
        ratio(count_when(F.col("instant_bookable")), F.count(F.lit(1))).alias("instant_row_pct"),
        ratio(F.count(F.lit(1)), F.count_distinct("host_id"), pct=False).alias("listings_per_host"))


def _profiled(spark, sf_dir):
    return null_tokens(binding.raw_listings(spark, sf_dir))


def _profiled_once(spark, sf_dir):
    """The extract written once for the multi-pass full report."""
    return materialize(_profiled(spark, sf_dir))


def q_null_summary(spark, sf_dir):
    return profile.null_summary(_profiled(spark, sf_dir))


def q_null_rate_report(spark, sf_dir):
    return profile.null_summary(_profiled(spark, sf_dir), fixed.NULL_RATE_REPORT_PCT)


def q_duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(null_tokens(binding.raw_reviews(spark, sf_dir)))


def q_value_counts(spark, sf_dir):
    return profile.value_counts(_profiled(spark, sf_dir))


def q_distinct_values(spark, sf_dir):
    return profile.distinct_counts(profile.value_counts(_profiled(spark, sf_dir)))


def q_numeric_ranges(spark, sf_dir):
    return profile.numeric_ranges(_profiled(spark, sf_dir))


def q_type_census(spark, sf_dir):
    return profile.type_census(_profiled(spark, sf_dir))


def q_table_shape(spark, sf_dir):
    return profile.shape(_profiled(spark, sf_dir), "listings").unionByName(
        profile.shape(null_tokens(binding.raw_reviews(spark, sf_dir)), "reviews"))


def q_profile_listings(spark, sf_dir):
    return profile.profile_report(_profiled_once(spark, sf_dir), "listings", dim=city_dimension(spark))


def q_profile_reviews(spark, sf_dir):
    return profile.profile_report(materialize(null_tokens(binding.raw_reviews(spark, sf_dir))), "reviews")


def q_profile_states(spark, sf_dir):
    """The listings profile merged from the states of three landing files, the last one scanned later."""
    store = Snapshots(spark, shared_dir(spark, "profile"))
    landed = materialize(_profiled(spark, sf_dir))
    third = F.pmod(F.xxhash64("listing_id"), F.lit(3))
    files = {str(i): landed.where(third == i) for i in range(3)}
    keys = {f: f"file {f}" for f in files}
    stored_states(store, {f: files[f] for f in ("0", "1")}, keys, "listings")
    states, _ = stored_states(store, files, keys, "listings")
    return report_from_states(states, landed.columns, dim=city_dimension(spark))


def _tested_models(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...]) -> dict[str, DataFrame]:
    """The models that tests of ``kinds`` look at, over a raw table of the listings written once
    and bronze reviews written once.

    The tests read few columns of a model: over the raw text only those are parsed, which is less
    than a write of the whole bronze table. A unique test reads one column, so for those alone
    nothing is written.
    """
    wanted = {model for model, _, kind, _ in fixed.DATA_TESTS if kind in kinds}
    raw_l, raw_r = raw_listings(spark, sf_dir), raw_reviews(spark, sf_dir)
    if set(kinds) != {"unique"}:
        raw_l = materialize(raw_l, "raw_listings")
    bl, br = bronze_listings(raw_l), bronze_reviews(raw_r)
    if set(kinds) != {"unique"} and wanted & {"bronze_reviews", "silver_reviews", "fct_seasonal_trends"}:
        br = materialize(br, "bronze_reviews")
    found = models_over(bl, br, city_dimension(spark), AS_OF)
    return {name: df for name, df in found.items() if name in wanted}


def _tests(kind: str) -> Query:
    def q(spark, sf_dir):
        return run_data_tests(_tested_models(spark, sf_dir, (kind,)), kinds=(kind,))
    return q


def q_row_count_gates(spark, sf_dir):
    raw_l, raw_r = raw_listings(spark, sf_dir), raw_reviews(spark, sf_dir)
    ms = models_over(materialize(bronze_listings(raw_l), "bronze_listings"),
                     materialize(bronze_reviews(raw_r), "bronze_reviews"), city_dimension(spark), AS_OF)
    tables = {"raw_listings": (raw_l, 1), "raw_reviews": (raw_r, 1)}
    tables.update({name: (ms[name], n) for name, n in fixed.GOLD_MIN_ROWS})
    return row_counts(tables)


# --- loads and tests with something to find ----------------------------------------

def q_reviews_csv_load(spark, sf_dir):
    """The 4-column load of the reviews with its batch time, damaged lines set aside."""
    out = binding.stage_reviews_csv(spark, sf_dir, shared_dir(spark, "stage", "reviews"))
    good, _ = read_csv_positional(spark, [f"{out}/good", f"{out}/extra", f"{out}/short"],
                                  fixed.RAW_REVIEW_COLUMNS, stage_to=f"{out}/parsed")
    stamped = with_load_time(good, BATCH_TS)
    return stamped.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


def q_csv_quoted_breaks(spark, sf_dir):
    """Positional load of names that hold line breaks, commas, quotes and accents."""
    out = shared_dir(spark, "stage", "quoted")
    rows = binding.quoted_listings(spark, sf_dir)
    write_csv(rows, f"{out}/csv")
    return read_csv_positional(spark, f"{out}/csv", rows.columns, stage_to=f"{out}/parsed")[0]


def q_csv_named_latin1(spark, sf_dir):
    """Header-named scan of the same rows written as ISO-8859-1."""
    out = shared_dir(spark, "stage", "latin1")
    write_csv(binding.quoted_listings(spark, sf_dir), out, encoding="ISO-8859-1")
    return read_csv_named(spark, out, encoding="ISO-8859-1")


def q_duplicate_rows_found(spark, sf_dir):
    reviews = null_tokens(binding.raw_reviews(spark, sf_dir))
    return profile.duplicate_rows(binding.with_repeats(reviews, "review_id", binding.REPEATED_REVIEW_EVERY))


def q_data_tests_found(spark, sf_dir):
    """All tests of three models over tables with missing and repeated keys and values off the lists."""
    return run_data_tests({name: materialize(df, f"flawed_{name}")
                           for name, df in binding.flawed_models(spark, sf_dir).items()})


# --- publishing -----------------------------------------------------------------------

def q_table_versions(spark, sf_dir):
    """One table in two published versions, read by number; the newest is what a plain read gives."""
    store = Snapshots(spark, shared_dir(spark, "versions"))

    def published(df):
        counts = df.groupBy("room_type").agg(F.count(F.lit(1)).alias("listings"))
        return store.publish({("gold", "listings_by_room"): store.write(counts, "gold", "listings_by_room")})

    first = published(bronze_listings(raw_listings(spark, sf_dir)))
    second = published(_silver(spark, sf_dir))
    newest = store.read("gold", "listings_by_room").select(F.col("room_type").alias("r"), F.col("listings").alias("n"))
    parts = [store.read("gold", "listings_by_room", v).select(F.lit(v).alias("version"), "room_type", "listings")
             for v in (first, second)]
    both = parts[0].unionByName(parts[1])
    return both.join(newest, both.room_type.eqNullSafe(F.col("r")) & (both.listings == F.col("n")), "left").select(
        "version", "room_type", "listings", F.col("n").isNotNull().alias("newest"))


def _silver_view(spark: SparkSession, name: str, source: str, bronze: DataFrame) -> DataFrame:
    """A bronze table published with the silver view over it, and that view read by its name."""
    root = shared_dir(spark, "layers")
    store = Snapshots(spark, root)
    store.publish({("bronze", source): store.write(bronze, "bronze", source)},
                  {("silver", name): silver_views(AS_OF)["silver", name]})
    return read_table(spark, root, "silver", name).drop("loaded_at")


def q_silver_listings_view(spark, sf_dir):
    return _silver_view(spark, "silver_listings", "bronze_listings", bronze_listings(raw_listings(spark, sf_dir)))


def q_silver_reviews_view(spark, sf_dir):
    return _silver_view(spark, "silver_reviews", "bronze_reviews", bronze_reviews(raw_reviews(spark, sf_dir)))


def q_write_metrics(spark, sf_dir):
    """Rows and nulls of the bronze tables as their writes have seen them."""
    store = Snapshots(spark, shared_dir(spark, "metrics"))
    seen = []
    for name, df, column in (("bronze_listings", bronze_listings(raw_listings(spark, sf_dir)), "price_raw"),
                             ("bronze_reviews", bronze_reviews(raw_reviews(spark, sf_dir)), "review_date")):
        table = store.write(df, "bronze", name, metrics={"nulls": F.count_if(F.col(column).isNull())})
        seen.append((name, table.metrics["rows"], column, table.metrics["nulls"]))
    return spark.createDataFrame(seen, "table_name string, rows long, column_name string, nulls long")


def q_build_stamps(spark, sf_dir):
    """Whether every gold row is stamped with a time of this build, per model."""
    begun = F.timestamp_micros(F.lit(time.time_ns() // 1000))
    silver = _silver(spark, sf_dir)
    out = None
    for name, df in (("fct_revenue_by_city", fct_revenue_by_city(silver)), ("fct_price_vs_rating", fct_price_vs_rating(silver)),
                     ("fct_superhost_performance", fct_superhost_performance(silver))):
        part = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                      F.every(F.col("updated_at") >= begun).alias("stamped"))
        out = part if out is None else out.unionByName(part)
    return out


def _named_rows(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """(table_name, key): the rows of a sorted result in the order it has."""
    return df.select(F.lit(name).alias("table_name"),
                     F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("?")) for k in keys]).alias("key"))


def q_presentation_order(spark, sf_dir):
    """Row positions of the sorted gold tables and of the sorted profile sections, over one raw table."""
    profiled = _profiled_once(spark, sf_dir)
    silver = silver_listings(bronze_listings(with_load_time(profiled, BATCH_TS)), city_dimension(spark), AS_OF)
    parts = [
        _named_rows(fct_revenue_by_city(silver), "fct_revenue_by_city", ["city", "total_listings"]),
        _named_rows(fct_superhost_performance(silver), "fct_superhost_performance", ["city", "host_type"]),
        _named_rows(fct_seasonal_trends(_silver_reviews(spark, sf_dir), silver), "fct_seasonal_trends",
                   ["city", "year_number", "month_number", "room_type", "price_category"]),
        _named_rows(fct_price_vs_rating(silver), "fct_price_vs_rating",
                   ["city", "price_category", "room_type", "property_type"]),
        _named_rows(profile.ordered_nulls(profile.null_summary(profiled)), "null_summary", ["column_name", "nulls"]),
        _named_rows(profile.ordered_values(profile.value_counts(profiled)), "value_counts",
                   ["column_name", "n", "value"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return with_positions(out, groups=("table_name",)).select("table_name", "position", "key")


def _with_folder(query: Query) -> Query:
    """The query in a session that names no shared folder: it then gets one in the warehouse."""
    @wraps(query)
    def q(spark, sf_dir):
        if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(
                spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
        return query(spark, sf_dir)
    return q


QUERIES: dict[str, Query] = {
    "bronze_listings": q_bronze_listings,
    "bronze_reviews_dedupe": q_bronze_reviews_dedupe,
    "silver_listings": q_silver_listings,
    "silver_reviews": q_silver_reviews,
    "fct_revenue_by_city": q_fct_revenue_by_city,
    "fct_superhost_performance": q_fct_superhost_performance,
    "fct_seasonal_trends": q_fct_seasonal_trends,
    "fct_price_vs_rating": q_fct_price_vs_rating,
    "bronze_reviews_table": q_bronze_reviews_table,
    "years_active": q_years_active,
    "null_tokens": q_null_tokens,
    "csv_load_good": q_csv_load_good,
    "csv_load_rejects": q_csv_load_rejects,
    "uncovered_keys": q_uncovered_keys,
    "avg_ignore_zero": q_avg_ignore_zero,
    "price_stats_median": q_price_stats_median,
    "ratio_pct": q_ratio_pct,
    "null_summary": q_null_summary,
    "null_rate_report": q_null_rate_report,
    "duplicate_rows": q_duplicate_rows,
    "value_counts": q_value_counts,
    "distinct_values": q_distinct_values,
    "numeric_ranges": q_numeric_ranges,
    "type_census": q_type_census,
    "table_shape": q_table_shape,
    "profile_listings": q_profile_listings,
    "profile_reviews": q_profile_reviews,
    "profile_states": q_profile_states,
    "not_null_tests": _tests("not_null"),
    "unique_tests": _tests("unique"),
    "accepted_values_tests": _tests("accepted_values"),
    "row_count_gates": q_row_count_gates,
    "reviews_csv_load": q_reviews_csv_load,
    "csv_quoted_breaks": q_csv_quoted_breaks,
    "csv_named_latin1": q_csv_named_latin1,
    "duplicate_rows_found": q_duplicate_rows_found,
    "data_tests_found": q_data_tests_found,
    "presentation_order": q_presentation_order,
    "table_versions": q_table_versions,
    "silver_listings_view": q_silver_listings_view,
    "silver_reviews_view": q_silver_reviews_view,
    "write_metrics": q_write_metrics,
    "build_stamps": q_build_stamps,
}
QUERIES = {name: _with_folder(q) for name, q in QUERIES.items()}
