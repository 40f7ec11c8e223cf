"""Dimension lookup that normalises an amount into one currency.

The warehouse model writes this as two CASE expressions over a constant
city list. Here the list is a dimension DataFrame joined once; both the
currency code and the converted amount come from the same join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import fixed

def literal_table(spark: SparkSession, rows, names: tuple[str, ...], types: tuple[str, ...]) -> DataFrame:
    """A small constant table built inside the JVM (no Python workers at run time)."""
    return spark.range(1).select(_inline_rows(tuple(map(tuple, rows)), tuple(names), tuple(types)))


def _inline_rows(rows, names, types) -> Column:
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)])
               for row in rows]
    return F.inline(F.array(*structs))


def city_dimension(spark: SparkSession) -> DataFrame:
    """(city, currency, rate): the fixed ten-city reference table."""
    return literal_table(spark, fixed.CITY_CURRENCY_RATES, ("city", "currency", "rate"),
                         ("string", "string", "double"))


def lookup_normalise(df: DataFrame, dim: DataFrame, key: str = "city",
                     amount: str = "price_raw", code_out: str = "currency",
                     amount_out: str = "price_converted",
                     default_code: str = fixed.DEFAULT_CURRENCY,
                     default_rate: float = fixed.DEFAULT_RATE) -> DataFrame:
    """Left join ``df`` to ``dim(key, currency, rate)``; add code and converted amount.

    Unmatched keys (NULL included) get ``default_code`` and ``amount * default_rate``.
    ``dim`` must be unique on ``key`` (true for the city dimension). Whether it is broadcast
    is left to the planner and AQE, which measure it.
    """
    d = dim.select(F.col(key).alias("__k"), F.col("currency").alias("__code"),
                   F.col("rate").alias("__rate"))
    joined = df.join(d, F.col(key) == F.col("__k"), "left")
    return (joined
            .withColumn(code_out, F.coalesce(F.col("__code"), F.lit(default_code)))
            .withColumn(amount_out, F.col(amount) * F.coalesce(F.col("__rate"), F.lit(default_rate)))
            .drop("__k", "__code", "__rate"))


def in_dimension(key: Column, keys: tuple[str, ...] = fixed.CITIES) -> Column:
    """Membership in the dimension as an IN-list (pushed into Parquet scans)."""
    return key.isin(*keys)
