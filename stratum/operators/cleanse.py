"""Row-preserving cleansing steps: null tokens, load audit stamp, defaults."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stratum import fixed


def null_tokens(df: DataFrame, tokens: Iterable[str] = fixed.NULL_TOKENS,
                columns: Iterable[str] | None = None) -> DataFrame:
    """Replace any of ``tokens`` by NULL in every (or the given) string column.

    One projection over the input: no shuffle, stays in whole-stage codegen.
    """
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*_token_exprs(tuple(df.columns), frozenset(targets), tuple(tokens)))


def _token_exprs(columns: tuple[str, ...], targets: frozenset, tokens: tuple[str, ...]) -> tuple[Column, ...]:
    return tuple(F.when(~F.col(c).isin(list(tokens)), F.col(c)).alias(c) if c in targets else F.col(c)
                 for c in columns)


def with_load_time(df: DataFrame, batch_ts: _dt.datetime | str | None = None) -> DataFrame:
    """Add the ``loaded_at`` audit column: one timestamp for the whole batch."""
    ts = F.current_timestamp() if batch_ts is None else F.lit(
        batch_ts if isinstance(batch_ts, str) else batch_ts.isoformat(sep=" ")).cast("timestamp")
    return df.withColumn("loaded_at", ts)


def defaulted(defaults: Mapping[str, Any]) -> dict[str, Column]:
    """``{column: coalesce(column, default)}`` for use inside one ``select``."""
    return {c: F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()}


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULLs by per-column defaults, keeping column order and types."""
    exprs = defaulted(defaults)
    return df.select(*[exprs.get(c, F.col(c)) for c in df.columns])
