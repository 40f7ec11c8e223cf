"""Threshold tiering and boolean labels built from bound lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tier(c: Column, bounds: Sequence[tuple[float, str]], otherwise: str, closed: bool) -> Column:
    """First label whose bound admits the value; ``otherwise`` for the rest and NULL.

    ``closed`` selects ``value <= bound``; else ``value < bound``.
    """
    expr = None
    for bound, label in bounds:
        cond = c <= F.lit(bound) if closed else c < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def label(flag: Column, yes: str, no: str) -> Column:
    """``yes`` when the flag is TRUE; ``no`` when FALSE or NULL."""
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))
