"""Aggregate measure helpers with warehouse-style exact rounding.

Doubles are rounded through DECIMAL(28,10) so that a value such as 0.285
rounds half up to 0.29 regardless of its binary representation. Ratios of
counts follow fixed-point division: the quotient is rounded to 6 places
before it is scaled and rounded again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_dec(c: Column, places: int) -> Column:
    """Round half away from zero on the decimal value; result is DOUBLE."""
    exact = F.round(c.try_cast("decimal(28,10)"), places).cast("double")
    return F.coalesce(exact, F.round(c, places))  # beyond 18 digits a double has no such places left


def ratio(numerator: Column, denominator: Column, places: int = 2, pct: bool = True) -> Column:
    """``round(round(n / nullif(d, 0), 6) [* 100], places)`` in exact decimals; DOUBLE."""
    q = F.round(numerator.cast("decimal(20,0)")
                / F.nullif(denominator, F.lit(0)).cast("decimal(20,0)"), 6)
    if pct:
        q = q * F.lit(100)
    return F.round(q, places).cast("double")


def avg_nonzero(c: Column) -> Column:
    """Average that ignores the sentinel 0 (and NULL)."""
    return F.avg(F.nullif(c, F.lit(0)))


def distinct_if(cond: Column, value: Column) -> Column:
    """COUNT(DISTINCT CASE WHEN cond THEN value END)."""
    return F.count_distinct(F.when(cond, value))


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END): rows where cond is TRUE."""
    return F.count_if(cond)
