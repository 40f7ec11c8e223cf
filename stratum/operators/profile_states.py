"""Profiles that merge: one small state table per landing file, one report over any set of them.

A state row is ``(kind, column_name, value, n, total, low, high)``; states of the same
``(kind, column_name, value)`` merge by sums and extremes, so the report over the states of
all files equals the report over all their rows and a new file is the only one scanned.

* ``rows``: n rows of the file
* ``types``: n values of a column in a class (integer, decimal, date, text) or null
* ``ranges``: n numbers of a column after money coercion, their total, low and high
* ``values``: n rows with a value of a categorical column, null included
* ``digests``: n rows with the SHA-256 of all columns, for the count of repeated rows; this
  kind has as many rows as the file has distinct rows, the others stay small
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum import fixed
from stratum.functions.measures import round_dec
from stratum.functions.parse import money
from stratum.operators.profile import section_rows, value_class
from stratum.sources.snapshots import Snapshots, Table, digest_of

CLASSES = ("integer", "decimal", "date", "text")
STATE = ("kind", "column_name", "value")


def _merged(states: DataFrame) -> DataFrame:
    return states.groupBy(*STATE).agg(F.sum("n").alias("n"), F.sum("total").alias("total"),
                                      F.min("low").alias("low"), F.max("high").alias("high"))


def profile_states(df: DataFrame, categorical: Iterable[str] = fixed.PROFILE_CATEGORICAL,
                   numeric: Iterable[str] = fixed.PROFILE_NUMERIC) -> DataFrame:
    """The state table of one input: cells and digests of its rows, each combined before and after a shuffle.

    Columns that the input lacks are skipped; an input without rows has no states.
    """
    texts = {c: F.col(c).cast("string") for c in df.columns}
    names = list(texts)
    counted, measured = ([i for i, c in enumerate(names) if c in set(some)] for some in (categorical, numeric))
    # one cell per column and row, classified after the unpivot: one small expression, not one per column
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), t.alias("v")) for i, t in enumerate(texts.values())])))
    i, v = F.col("i"), F.col("v")
    cells = (cells.select(i, F.when(v.isNotNull(), value_class(v)).otherwise("null").alias("class"),
                          F.when(i.isin(counted), v).alias("value"), F.when(i.isin(measured), money(v)).alias("number"))
             .groupBy("i", "class", "value").agg(F.count(F.lit(1)).alias("n"), F.count("number").alias("numbers"),
                                                 F.sum("number").alias("total"), F.min("number").alias("low"),
                                                 F.max("number").alias("high")))

    def state(kind: str, value: Column, column: bool = True, n: str = "n", number: bool = False):
        return F.struct(F.lit(kind).alias("kind"), F.when(F.lit(column), F.col("column_name")).alias("column_name"),
                        value.cast("string").alias("value"), F.col(n).alias("n"),
                        *[F.when(F.lit(number), F.col(c)).alias(c) for c in ("total", "low", "high")])

    none = F.lit(None)
    column_name = F.element_at(F.array(*[F.lit(c) for c in names]), i + 1)
    states = F.array(F.when(i == 0, state("rows", none, column=False)), state("types", F.col("class")),
                     F.when(i.isin(measured), state("ranges", none, n="numbers", number=True)),
                     F.when(i.isin(counted), state("values", F.col("value"))))
    small = _merged(cells.withColumn("column_name", column_name)
                    .select(F.inline(F.filter(states, lambda s: s.isNotNull()))))
    # every text under its column's name and length, so no two rows read alike; nulls leave nothing, so they
    # differ from empty text. Grouped on their own, since they are as many as the rows: the hash table of
    # the other states stays small
    named = [F.coalesce(F.concat(F.lit(f"{len(c)}:{c}="), F.octet_length(t).cast("string"), F.lit(":"), t), F.lit(""))
             for c, t in texts.items()]
    digest = F.sha2(F.concat(*named), 256)
    missing = F.lit(None).cast("double")
    digests = (df.groupBy(digest.alias("value")).agg(F.count(F.lit(1)).alias("n"))
               .select(F.lit("digests").alias("kind"), F.lit(None).cast("string").alias("column_name"), "value", "n",
                       *[missing.alias(c) for c in ("total", "low", "high")]))
    return small.unionByName(digests)


def report_from_states(states: DataFrame, columns: Iterable[str],
                       categorical: Iterable[str] = fixed.PROFILE_CATEGORICAL,
                       numeric: Iterable[str] = fixed.PROFILE_NUMERIC,
                       dim: DataFrame | None = None, key: str = "city") -> DataFrame:
    """The rows of ``profile.profile_report`` over all inputs whose ``states`` are given, no input read.

    ``columns`` are those of the inputs. The ``coverage`` section needs ``key`` among the
    categorical columns.
    """
    columns = list(columns)
    merged = _merged(states)
    none = F.lit(None).cast("string")
    column, value, n = F.col("column_name"), F.col("value"), F.col("n")
    kinds = merged.where("kind != 'digests'")
    rows = kinds.where("kind = 'rows'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    repeated = merged.where("kind = 'digests'").agg(F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicate_rows"))
    types = kinds.where("kind = 'types'").groupBy("column_name").agg(
        F.sum("n").alias("rows"), *[F.coalesce(F.sum(F.when(value == c, n)), F.lit(0)).alias(f"{c}_values")
                                    for c in (*CLASSES, "null")])
    nulls = types.where("null_values > 0").select(
        "column_name", F.col("null_values").alias("nulls"),
        round_dec(F.col("null_values") / F.col("rows") * F.lit(100), 2).alias("null_pct"))
    used = sum((F.col(f"{c}_values") > 0).cast("int") for c in CLASSES)
    counts = kinds.where("kind = 'values'")
    distinct = counts.groupBy("column_name").agg(F.count("value").alias("distinct_values"))
    # a numeric column without a state (no rows at all) is still listed
    listed = states.sparkSession.createDataFrame([(c,) for c in numeric if c in columns], "column_name string")
    ranges = listed.join(kinds.where("kind = 'ranges'"), "column_name", "left").join(
        types.select("column_name", "rows"), "column_name", "left").select(
        "column_name", round_dec(F.col("low"), 2).alias("min_value"), round_dec(F.col("high"), 2).alias("max_value"),
        round_dec(F.try_divide("total", "n"), 2).alias("mean_value"), F.coalesce(F.col("rows") - n, F.lit(0)).alias("nulls"))
    parts = [
        section_rows(rows.withColumn("columns", F.lit(len(columns))), "shape", none, none, ["rows", "columns"]),
        section_rows(repeated, "duplicates", none, none, ["duplicate_rows"]),
        section_rows(nulls, "nulls", column, none, ["nulls", "null_pct"]),
        section_rows(counts, "values", column, value, ["n"]),
        section_rows(distinct, "distinct", column, none, ["distinct_values"]),
        section_rows(ranges, "ranges", column, none, ["min_value", "max_value", "mean_value", "nulls"]),
        section_rows(types.withColumn("mixed", (used > 1).cast("int")), "types", column, none,
                     [*(f"{c}_values" for c in CLASSES), "mixed"]),
    ]
    if dim is not None and key in columns:
        if key not in categorical:
            raise ValueError(f"coverage of {key} needs its values among the categorical columns")
        held = counts.where((column == key) & value.isNotNull()).select(value.alias(key), n.alias("rows"))
        missing = held.join(dim.select(key).distinct(), key, "left_anti")
        parts.append(section_rows(missing, "coverage", F.lit(key), F.col(key), ["rows"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stored_states(store: Snapshots, files: Mapping[str, DataFrame], keys: Mapping[str, str], name: str,
                  categorical: Iterable[str] = fixed.PROFILE_CATEGORICAL,
                  numeric: Iterable[str] = fixed.PROFILE_NUMERIC) -> tuple[DataFrame, dict[str, Table]]:
    """(states of all ``files``, their state tables): only a file whose key the ledger lacks is scanned.

    A key names a file's contents (``snapshots.files_digest``), so a changed file is profiled
    anew; a state table whose write was killed is not in the ledger and is written again.
    """
    if not files:
        raise ValueError("no files to profile")
    lists = [list(categorical), list(numeric)]
    tables = {f: store.write(profile_states(df, *lists), "PROFILE", f"{name}-{f}",
                             key=digest_of("profile 2", name, lists, df.columns, keys[f]))
              for f, df in files.items()}
    spark = next(iter(files.values())).sparkSession
    return spark.read.parquet(*[t.path for t in tables.values()]), tables
