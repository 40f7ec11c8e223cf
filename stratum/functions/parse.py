"""Tolerant and strict text-to-value parsing as Column expressions.

All of these stay inside Catalyst (no Python UDF), so they are code-generated
and pushed through projections like any built-in expression. Spark's own
``try_cast`` is more lenient than a warehouse number parser (it accepts
``'12d'`` as 12.0), so numeric parsing is guarded by one shared pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation with an optional exponent, surrounding blanks allowed.
# Possessive and without groups to note down: the same texts match, in one pass.
NUMERIC_PATTERN = r"^[+-]?+(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?+\d++)?+$"
# Most whole numbers: settled without a decimal; what it matches fits 64 bits.
SHORT_DIGITS_PATTERN = r"^\d{1,18}$"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_text(c: str | Column) -> Column:
    """The trimmed text when it looks like a number, else NULL."""
    t = F.trim(_col(c))
    return F.when(t.rlike(NUMERIC_PATTERN), t)


def try_number(c: str | Column) -> Column:
    """NUMBER(38,0) parse: rounds half up to an integer, NULL when unparseable.

    Going through DECIMAL(38,0) is what makes '3.7' -> 4 and '2.0' -> 2;
    a direct cast to BIGINT would return NULL for both. A whole number that
    has a value but not in 64 bits stops the job: it is never lost as a NULL.
    The check is reached only by rows without a 64-bit value.
    """
    c = _col(c)
    wide = numeric_text(c).try_cast("decimal(38,0)")
    return F.when(c.rlike(SHORT_DIGITS_PATTERN), c.try_cast("bigint")).otherwise(F.coalesce(wide.try_cast("bigint"), F.when(
        wide.isNotNull(), F.raise_error(F.concat(F.lit("number beyond 64 bits: "), wide.cast("string"))).cast("bigint"))))


def try_double(c: str | Column) -> Column:
    """Double parse, NULL when the text is not a plain number."""
    return numeric_text(c).try_cast("double")


def try_date(c: str | Column) -> Column:
    """Strict ``YYYY-MM-DD`` date; NULL for other layouts or impossible dates."""
    c = _col(c)
    return F.when(c.rlike(ISO_DATE_PATTERN), F.try_to_date(c, "yyyy-MM-dd"))


def strict_int(c: str | Column, name: str = "value") -> Column:
    """Hard integer cast: fails the job on text that is not a number.

    The failure does not depend on the session's ANSI setting.
    """
    c = _col(c)
    parsed = numeric_text(c).try_cast("decimal(38,0)").try_cast("bigint")
    return F.when(c.rlike(SHORT_DIGITS_PATTERN), c.try_cast("bigint")).when(
                  c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"cannot cast {name} to INTEGER: '"), c, F.lit("'")))
                  ).otherwise(parsed)


def flag(c: str | Column) -> Column:
    """'t' -> TRUE; anything else, NULL included, -> FALSE."""
    return F.coalesce(_col(c) == F.lit("t"), F.lit(False))


def percent(c: str | Column) -> Column:
    """'97%' -> 97.0."""
    return try_double(F.replace(_col(c), F.lit("%"), F.lit("")))


def money(c: str | Column) -> Column:
    """Strip currency symbols and thousands separators, then parse ('$1,200' -> 1200.0)."""
    return try_double(F.regexp_replace(_col(c).cast("string"), r"[$,]", ""))
