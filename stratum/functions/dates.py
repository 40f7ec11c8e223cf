"""Date helpers: calendar-year difference, season and the review date dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum import fixed


def as_date(value: _dt.date | str | Column | None) -> Column:
    """A run date parameter as a DATE column; ``None`` means today."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, str) else value.isoformat()).cast("date")


def years_between(start: Column, end: Column) -> Column:
    """Number of calendar-year boundaries crossed from ``start`` to ``end``.

    2023-12-31 -> 2024-01-01 is 1 (not the elapsed-years 0 of timestampdiff).
    """
    return F.year(end) - F.year(start)


def season(month: Column) -> Column:
    expr = None
    for months, name in fixed.SEASONS:
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(fixed.SEASON_OTHER))


def month_name(month: Column) -> Column:
    """Short name of a month number."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")


def month_quarter(month: Column) -> Column:
    return F.ceil(month / 3).cast("int")


def date_dimension(d: Column) -> list[Column]:
    """Calendar attributes of a DATE column (day_of_week 0 = Sunday)."""
    return [
        F.trunc(d, "month").alias("review_month"),
        F.trunc(d, "year").alias("review_year"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "MMM").alias("month_name"),
        F.month(d).alias("month_number"),
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        season(F.month(d)).alias("season"),
    ]
