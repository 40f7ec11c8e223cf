"""Lookup coverage: key values present in the data but absent from a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def uncovered(df: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    """``(key, rows)`` for every non-null key value with no dimension row.

    The count is aggregated map-side first, so a hot key costs one row per
    task in the shuffle; the anti join then runs on distinct keys only.
    """
    counts = (df.where(F.col(key).isNotNull())
              .groupBy(key).agg(F.count(F.lit(1)).alias("rows")))
    return counts.join(dim.select(key).distinct(), key, "left_anti")
