"""Declarative data tests and gates.

Tests return failure counts as DataFrames ``(test_id, model, column_name,
test_name, failures)`` with the usual semantics of column tests:

* ``not_null``: rows where the column is NULL;
* ``unique``: non-null values that occur more than once;
* ``accepted_values``: distinct non-null values outside the list.

All ``not_null`` tests of one table share an aggregate pass and all its
``accepted_values`` tests another; each ``unique`` test is one
map-side-combined group-by. Gates collect a handful of counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum import fixed
from stratum.operators.coverage import uncovered
from stratum.session import shared_dir


class GateError(RuntimeError):
    """A data gate or data test failed; the run must stop."""


def _row(test_id: int, model: str, column: str, test: str, failures) -> list:
    return [F.lit(test_id).cast("int").alias("test_id"), F.lit(model).alias("model"),
            F.lit(column).alias("column_name"), F.lit(test).alias("test_name"),
            failures.cast("bigint").alias("failures")]


def not_null(df: DataFrame, model: str, columns: Sequence[tuple[int, str]]) -> DataFrame:
    """``columns`` = [(test_id, column)]; one scan for all of them."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in columns])
    rows = [F.struct(*_row(i, model, c, "not_null", F.col(f"__{i}"))) for i, c in columns]
    return agg.select(F.inline(F.array(*rows)))


def unique(df: DataFrame, model: str, column: str, test_id: int = 0) -> DataFrame:
    dup = (df.where(F.col(column).isNotNull()).groupBy(column)
           .agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1))
    return dup.agg(*_row(test_id, model, column, "unique", F.count(F.lit(1))))


def accepted_values(df: DataFrame, model: str, column: str, values: Iterable[Any],
                    test_id: int = 0) -> DataFrame:
    bad = (df.select(column).where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
           .distinct())
    return bad.agg(*_row(test_id, model, column, "accepted_values", F.count(F.lit(1))))


def column_tests(df: DataFrame, model: str, tests: Sequence[tuple[int, str, str, Any]]) -> DataFrame:
    """All ``not_null`` and ``accepted_values`` tests of one table.

    ``tests`` = [(test_id, column, test_name, accepted_values_or_None)]. The
    ``not_null`` tests are one aggregate pass. An accepted-values failure
    count is the number of distinct bad values: a second pass gives a row
    (test, value) per violation only, made distinct and counted per test.
    """
    wrong = [test for _, _, test, _ in tests if test not in ("not_null", "accepted_values")]
    if wrong:
        raise ValueError(f"not a column test: {wrong[0]}")
    nulls = [(i, c) for i, c, test, _ in tests if test == "not_null"]
    lists = [(i, c, list(arg)) for i, c, test, arg in tests if test == "accepted_values"]
    out = not_null(df, model, nulls) if nulls else None
    if lists:
        found = F.array(*[F.struct(F.lit(i).alias("__id"), F.when(~F.col(c).isin(vals), F.col(c).cast("string")).alias("__bad"))
                          for i, c, vals in lists])
        bad = (df.select(F.inline(F.filter(found, lambda s: s["__bad"].isNotNull()))).distinct()
               .groupBy("__id").agg(F.count(F.lit(1)).alias("__n")))
        every = df.sparkSession.range(1).select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("__test"), F.lit(c).alias("__column")) for i, c, _ in lists])))
        got = every.join(bad, F.col("__test") == F.col("__id"), "left")
        counted = got.select(*_row(F.col("__test"), model, F.col("__column"), "accepted_values",
                                   F.coalesce(F.col("__n"), F.lit(0))))
        out = counted if out is None else out.unionByName(counted)
    return out


def run_data_tests(models: Mapping[str, DataFrame],
                   tests: Sequence[tuple[str, str, str, Any]] = fixed.DATA_TESTS,
                   kinds: Iterable[str] | None = None) -> DataFrame:
    """Run every test of ``tests`` whose model is in ``models``; one row per test.

    ``test_id`` is the 1-based position in ``tests``; ``kinds`` keeps only some test types.
    Per table, not_null tests share one pass and accepted_values tests another; each unique test is
    one map-side-combined group-by.
    """
    kinds = None if kinds is None else set(kinds)
    per_table: dict[str, list[tuple[int, str, str, Any]]] = {}
    parts: list[DataFrame] = []
    for i, (model, column, test, arg) in enumerate(tests, start=1):
        if model not in models or (kinds is not None and test not in kinds):
            continue
        if test == "unique":
            parts.append(unique(models[model], model, column, i))
        elif test in ("not_null", "accepted_values"):
            per_table.setdefault(model, []).append((i, column, test, arg))
        else:
            raise ValueError(f"unknown test {test}")
    parts = [column_tests(models[m], m, ts) for m, ts in per_table.items()] + parts
    if not parts:
        raise ValueError("no tests for the given models")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raise_on_failures(results: DataFrame) -> None:
    """Fail when any test reports failures (collects only the failing test rows)."""
    bad = results.where(F.col("failures") > 0).orderBy("test_id").collect()
    if bad:
        lines = [f"{r.model}.{r.column_name} {r.test_name}: {r.failures}" for r in bad]
        raise GateError("data tests failed:\n  " + "\n  ".join(lines))


def row_counts(tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """``(table_name, rows, min_rows, passed)`` for each ``name: (df, min_rows)``."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(n).cast("bigint").alias("min_rows"))
        for name, (df, n) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("rows") >= F.col("min_rows"))


def gate_min_rows(tables: Mapping[str, tuple[DataFrame, int]]) -> dict[str, int]:
    """Raise when a table has fewer rows than required; returns the counts."""
    counts = {r.table_name: (r.rows, r.min_rows) for r in row_counts(tables).collect()}
    short = [f"{t} has only {n} rows, expected at least {m}" for t, (n, m) in counts.items() if n < m]
    if short:
        raise GateError("; ".join(short))
    return {t: n for t, (n, _) in counts.items()}


def gate_counts(counts: Mapping[str, int], min_rows: Iterable[tuple[str, int]]) -> dict[str, int]:
    """:func:`gate_min_rows` over counts that are known already, such as those a write has seen."""
    least = dict(min_rows)
    short = [f"{t} has only {counts[t]} rows, expected at least {m}" for t, m in least.items() if counts[t] < m]
    if short:
        raise GateError("; ".join(short))
    return {t: counts[t] for t in least}


def gate_non_empty(tables: Mapping[str, DataFrame]) -> None:
    """Raise when any table is empty (reads at most one row per table)."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise GateError(f"empty after load: {', '.join(empty)}")


def gate_coverage(df: DataFrame, key: str, dim: DataFrame, report_to: str | None = None, show: int = 20) -> None:
    """Raise when a non-null key value has no dimension row (schema drift guard).

    All uncovered values with their row counts are written to ``report_to`` (or a fresh
    shared folder), which the error names beside the first ``show`` of them.
    """
    path = report_to or shared_dir(df.sparkSession, "uncovered")
    uncovered(df, key, dim).write.mode("overwrite").parquet(path)
    missing = df.sparkSession.read.parquet(path)
    total = missing.count()
    if total:
        names = ", ".join(f"{r[key]} ({r['rows']} rows)" for r in missing.orderBy(key).limit(show).collect())
        raise GateError(f"{total} {key} values not covered by the lookup: {names}; all of them: {path}")
