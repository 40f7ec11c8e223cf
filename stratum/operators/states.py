"""One-pass grouped measures: medians, plain and conditional distinct counts, sums and extremes together.

Every input row becomes a few state rows per group: one under its median value, which also
carries the sums, counts and extremes, and one under each id that is counted distinctly, with
a mask of the conditions that hold. States are merged before and after one shuffle by (group,
value or id), so a group of a third of all rows is split by its values and ids; a second
level merges the states of a group. The input is read once and joined to nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE = -1  # the kind of a value's state; ids are numbered from 0


def grouped_states(df: DataFrame, keys: Sequence[str], median: str, averages: Mapping[str, Column],
                   counts: Mapping[str, Column], distinct: Mapping[str, Mapping[str, Column | None]]) -> DataFrame:
    """``df`` grouped by ``keys`` (nulls are a group of their own), with

    * ``median``, ``low`` and ``high``: exact median, least and greatest of the column ``median``;
    * per name of ``averages`` the unrounded average of the column's non-null values;
    * per name of ``counts`` the rows in which the condition holds; ``rows``: all of them;
    * ``distinct``: id column -> {name: condition or None}: distinct non-null ids among the rows
      in which the condition holds, all rows for None.
    """
    masks = {}
    for number, (column, wanted) in enumerate(distinct.items()):
        conditions = [c for c in wanted.values() if c is not None]
        bits = F.lit(0)
        for place, condition in enumerate(conditions):
            bits = bits + F.when(condition, 1 << place).otherwise(0)
        masks[column] = (number, bits)
    measured = {f"a{i}": c for i, c in enumerate(averages.values())}
    flags = {f"c{i}": c for i, c in enumerate(counts.values())}
    some = [F.col(median).cast("double").alias("value"), *[c.cast("double").alias(n) for n, c in measured.items()],
            *[c.alias(n) for n, c in flags.items()]]
    none = [F.lit(None).cast("double").alias("value"), *[F.lit(None).cast("double").alias(n) for n in measured],
            *[F.lit(None).cast("boolean").alias(n) for n in flags]]
    states = [F.struct(F.lit(VALUE).alias("kind"), F.lit(None).cast("bigint").alias("id"), F.lit(0).alias("mask"), *some)]
    states += [F.struct(F.lit(n).alias("kind"), F.col(column).cast("bigint").alias("id"), bits.alias("mask"), *none)
               for column, (n, bits) in masks.items()]
    held = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    group = [f"k{i}" for i in range(len(keys))]

    level = (df.select(*held, F.inline(F.array(*states))).groupBy(*group, "kind", "value", "id")
             .agg(F.count(F.lit(1)).alias("n"), F.bit_or("mask").alias("mask"),
                  *[F.sum(n).alias(f"{n}s") for n in measured], *[F.count(n).alias(f"{n}n") for n in measured],
                  *[F.count_if(F.col(n)).alias(n) for n in flags]))
    of_value = F.col("kind") == VALUE
    wanted = [F.percentile("value", 0.5, F.col("n")).alias("median"), F.min("value").alias("low"), F.max("value").alias("high"),
              F.coalesce(F.sum(F.when(of_value, F.col("n"))), F.lit(0)).alias("rows")]
    wanted += [F.sum(f"{n}s").alias(f"{n}s") for n in measured] + [F.sum(f"{n}n").alias(f"{n}n") for n in measured]
    wanted += [F.sum(n).alias(n) for n in flags]
    names = []
    for column, of_id in distinct.items():
        place = 0
        for name, condition in of_id.items():
            found = (F.col("kind") == masks[column][0]) & F.col("id").isNotNull()
            if condition is not None:
                found &= F.col("mask").bitwiseAND(1 << place) != 0
                place += 1
            wanted.append(F.count_if(found).alias(f"d{len(names)}"))
            names.append(name)
    out = level.groupBy(*group).agg(*wanted)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "median", "low", "high", "rows",
                      *[(F.col(f"a{i}s") / F.nullif(F.col(f"a{i}n"), F.lit(0))).alias(n) for i, n in enumerate(averages)],
                      *[F.col(f"c{i}").alias(n) for i, n in enumerate(counts)],
                      *[F.col(f"d{i}").alias(n) for i, n in enumerate(names)])
