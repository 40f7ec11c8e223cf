"""Positions of the rows of a sorted result, without bringing them into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.sources.tables import materialize

#: monotonically_increasing_id holds a row's place in its partition in the bits below this one
_PLACE_BITS = 33


def with_positions(ordered: DataFrame, name: str = "position", groups: tuple[str, ...] = ()) -> DataFrame:
    """``ordered`` with the 1-based position of each row in the order it has.

    A global sort leaves range partitions, each sorted. The rows are written once with their
    partition and place in it; the partitions' row counts are added up to offsets (a row per
    partition, the only thing a window without keys sees), and offset plus place is the
    position. A union of sorted results is numbered in one go, each from 1, with ``groups``
    naming the columns that tell them apart (never null). An empty input gives no rows.
    """
    part, place, before, first = "__part", "__place", "__before", "__first"
    at = F.monotonically_increasing_id()
    rows = materialize(ordered.withColumns({part: F.shiftright(at, _PLACE_BITS),
                                            place: at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}), "numbered")
    upto = F.sum("__rows").over(Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = (rows.groupBy(*groups, part).agg(F.count(F.lit(1)).alias("__rows"), F.min(place).alias(first))
               .select(*groups, part, first, F.coalesce(upto, F.lit(0)).alias(before)))
    return (rows.join(offsets, [*groups, part])
            .select(*ordered.columns, (F.col(before) + F.col(place) - F.col(first) + 1).alias(name)))
