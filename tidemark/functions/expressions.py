"""Null tokens, casts, hashes and ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CSV_TIMESTAMP_PATTERN, NULL_TOKENS


def blank_to_null(c: Column) -> Column:
    """Map each spelling of "no value" to null."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def parse_text(c: Column, dtype: T.DataType) -> Column:
    """Typed value of a text cell; null if the text does not parse."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.TimestampNTZType):
        return F.when(c.rlike(CSV_TIMESTAMP_PATTERN), c.try_cast(dtype))
    return c.try_cast(dtype)


def change_hash(columns: Sequence[str]) -> Column:
    """SHA2-256 of the pipe-joined columns; null counts as empty text."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def ratio_pct(part: Column, whole: Column, scale: int = 1) -> Column:
    """``part / whole`` in percent, rounded half up; null when ``whole`` is zero."""
    exact = F.try_divide((part * 100).cast("decimal(20,0)"), whole.cast("decimal(18,0)"))
    return F.round(exact, scale).cast("double")


def rounded_mean(total: Column, rows: Column, scale: int) -> Column:
    """Mean of exact values, rounded half up without a detour through binary floats."""
    exact = F.try_divide(total.cast("decimal(38,10)"), rows.cast("decimal(18,0)"))
    return F.round(exact, scale)
