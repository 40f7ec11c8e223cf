"""Distributed data profiler.

Each metric family is one Spark job whatever the number of columns: the
null census, numeric ranges and type census are single wide aggregates
(one scan, map-side partial aggregation, one tiny shuffle); value
frequencies unpivot and aggregate in one stage. Results come back as
long-format DataFrames (one row per column / value), never as driver-side
loops over data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import fixed
from stratum.functions.measures import round_dec
from stratum.operators.coverage import uncovered
from stratum.functions.parse import ISO_DATE_PATTERN, NUMERIC_PATTERN, money

INTEGER_PATTERN = r"^[+-]?\d+$"
RANGES_SCHEMA = "column_name string, min_value double, max_value double, mean_value double, nulls bigint"


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def _long(one_row: DataFrame, columns: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Turn a one-row ``{col}__{metric}`` aggregate into rows ``(column_name, metric...)``."""
    rows = [F.struct(F.lit(c).alias("column_name"),
                     *[F.col(f"{c}__{m}").alias(m) for m in metrics]) for c in columns]
    return one_row.select(F.inline(F.array(*rows)))


def shape(df: DataFrame, name: str) -> DataFrame:
    """``(table_name, rows, columns)``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"))


def _summary(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """One-row aggregate: row count, nulls per column, ranges of the numeric columns."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in df.columns]
    for c in numeric:
        v = money(F.col(c))
        aggs += [F.min(v).alias(f"{c}__min_value"), F.max(v).alias(f"{c}__max_value"),
                 F.avg(v).alias(f"{c}__mean_value"), F.count_if(v.isNull()).alias(f"{c}__bad")]
    return df.agg(*aggs)


def _nulls_from(summary: DataFrame, columns: Sequence[str], threshold_pct: float) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nulls").alias("nulls"),
                     F.col("__rows").alias("rows")) for c in columns]
    long = summary.select(F.inline(F.array(*rows)))
    share = F.col("nulls") / F.col("rows") * F.lit(100)
    return (long.where((F.col("nulls") > 0) & (share > F.lit(threshold_pct)))
            .select("column_name", "nulls", round_dec(share, 2).alias("null_pct")))


def _ranges_from(summary: DataFrame, numeric: Sequence[str]) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column_name"),
                     *[round_dec(F.col(f"{c}__{m}"), 2).alias(m)
                       for m in ("min_value", "max_value", "mean_value")],
                     F.col(f"{c}__bad").alias("nulls")) for c in numeric]
    return summary.select(F.inline(F.array(*rows)))


def null_summary(df: DataFrame, threshold_pct: float = 0.0) -> DataFrame:
    """``(column_name, nulls, null_pct)`` for columns whose null share is above the threshold.

    ``null_pct`` is rounded to 2 places; the threshold compares the unrounded share
    and is strict. Columns without nulls are never listed.
    """
    return _nulls_from(_summary(df, ()), df.columns, threshold_pct)


def value_counts(df: DataFrame, columns: Iterable[str] = fixed.PROFILE_CATEGORICAL) -> DataFrame:
    """``(column_name, value, n)`` including a NULL value row; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return _empty(df, "column_name string, value string, n bigint")
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(c).cast("string").alias("value")) for c in present])
    return (df.select(F.inline(pairs))
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def distinct_counts(counts: DataFrame) -> DataFrame:
    """``(column_name, distinct_values)``: non-null distinct values from :func:`value_counts`."""
    return counts.groupBy("column_name").agg(F.count("value").alias("distinct_values"))


def numeric_ranges(df: DataFrame, columns: Iterable[str] = fixed.PROFILE_NUMERIC) -> DataFrame:
    """``(column_name, min_value, max_value, mean_value, nulls)`` after money coercion."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return _empty(df, RANGES_SCHEMA)
    return _ranges_from(_summary(df, present), present)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """``(duplicate_rows)``: rows after the first of each group of fully equal rows (NULLs equal).

    One scan and one shuffle; equal rows are combined before it, so a row
    that a third of the table repeats crosses it once per task.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def ordered_nulls(nulls: DataFrame) -> DataFrame:
    """Presentation order of a null census: most nulls first (ties by name)."""
    return nulls.orderBy(F.desc("nulls"), "column_name")


def ordered_values(counts: DataFrame) -> DataFrame:
    """Presentation order of value frequencies: per column, most frequent first."""
    return counts.orderBy("column_name", F.desc("n"), F.asc_nulls_last("value"))


def value_class(v: Column) -> Column:
    """'integer' | 'decimal' | 'date' | 'text' for a non-null text value."""
    t = F.trim(v)
    # numbers and dates start with a digit, sign or dot: other text skips the patterns
    starts_like_number = F.substring(t, 1, 1).isin(*"0123456789+-.")
    return (F.when(~starts_like_number, F.lit("text"))
            .when(t.rlike(INTEGER_PATTERN), F.lit("integer"))
            .when(t.rlike(NUMERIC_PATTERN), F.lit("decimal"))
            .when(t.rlike(ISO_DATE_PATTERN), F.lit("date"))
            .otherwise(F.lit("text")))


def type_census(df: DataFrame) -> DataFrame:
    """Per column, how many non-null values read as integer / decimal / date / text.

    ``mixed`` is TRUE when more than one class occurs: the distributed
    counterpart of "column holds more than one value type after load".
    Values are unpivoted to ``(column, value)`` and classified once each;
    the aggregate is partial per task, so the shuffle carries one row per
    column per task.
    """
    classes = ("integer", "decimal", "date", "text")
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                      for c in df.columns])
    classified = df.select(F.inline(pairs)).select(
        "column_name", F.when(F.col("v").isNotNull(), value_class(F.col("v"))).alias("cls"))
    counts = classified.groupBy("column_name").agg(
        *[F.count_if(F.col("cls") == F.lit(cls)).alias(f"{cls}_values") for cls in classes])
    used = sum((F.col(f"{cls}_values") > 0).cast("int") for cls in classes)
    return counts.withColumn("mixed", used > 1)


def section_rows(frame: DataFrame, section: str, column: Column, value: Column, metrics: Sequence[str]) -> DataFrame:
    """One report row per row of ``frame`` and metric."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("amount"))
                      for m in metrics])
    return frame.select(F.lit(section).alias("section"), column.alias("column_name"),
                        value.alias("value"), F.inline(pairs))


def profile_report(df: DataFrame, name: str,
                   categorical: Iterable[str] = fixed.PROFILE_CATEGORICAL,
                   numeric: Iterable[str] = fixed.PROFILE_NUMERIC,
                   dim: DataFrame | None = None, key: str = "city") -> DataFrame:
    """Every profile section of one input as ``(section, column_name, value, metric, amount)``.

    With ``dim`` and a ``key`` column present, a ``coverage`` section lists the
    key values the dimension does not cover, with their row counts.
    """
    none = F.lit(None).cast("string")
    present = [c for c in numeric if c in df.columns]
    # shape, null census and ranges share one aggregate (its exchange is reused)
    summary = _summary(df, present)
    counts = value_counts(df, categorical)
    ranges = _ranges_from(summary, present) if present else _empty(df, RANGES_SCHEMA)
    parts = [
        section_rows(summary.select(F.col("__rows").alias("rows"), F.lit(len(df.columns)).alias("columns")),
             "shape", none, none, ["rows", "columns"]),
        section_rows(duplicate_rows(df), "duplicates", none, none, ["duplicate_rows"]),
        section_rows(_nulls_from(summary, df.columns, 0.0), "nulls", F.col("column_name"), none,
             ["nulls", "null_pct"]),
        section_rows(counts, "values", F.col("column_name"), F.col("value"), ["n"]),
        section_rows(distinct_counts(counts), "distinct", F.col("column_name"), none, ["distinct_values"]),
        section_rows(ranges, "ranges", F.col("column_name"), none,
             ["min_value", "max_value", "mean_value", "nulls"]),
        section_rows(type_census(df).withColumn("mixed", F.col("mixed").cast("int")), "types",
             F.col("column_name"), none,
             ["integer_values", "decimal_values", "date_values", "text_values", "mixed"]),
    ]
    if dim is not None and key in df.columns:
        parts.append(section_rows(uncovered(df, key, dim), "coverage", F.lit(key), F.col(key), ["rows"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
