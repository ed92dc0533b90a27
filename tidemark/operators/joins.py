"""Outer and anti joins whose left side has many rows without a key.

Such rows match nothing, yet a shuffle on the key would send all of them to one task.
They are given a key that no row can have and that differs between them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# No id starts with this character.
NO_ID = "\u0000"


def spread_nulls(key: str, by: Sequence[str]) -> Column:
    """A string key with its nulls replaced by unmatched values that depend on ``by``."""
    return F.coalesce(F.col(key), F.concat(F.lit(NO_ID), F.xxhash64(*by).cast("string")))


def _spread_by(df: DataFrame, key: str) -> list[str]:
    return [c for c, kind in df.dtypes if c != key and kind in ("string", "bigint", "timestamp_ntz")] or [key]


def left_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``df`` left join ``other`` on a string key of the same name, nulls spread over the tasks."""
    probe = df.withColumn("_probe", spread_nulls(key, _spread_by(df, key)))
    return probe.join(other.withColumnRenamed(key, "_probe"), "_probe", "left").drop("_probe")


def without(df: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows of ``df`` whose string key is not listed, nulls included and spread over the tasks."""
    probe = df.withColumn("_probe", spread_nulls(key, _spread_by(df, key)))
    return probe.join(listed.select(F.col(listed_key).alias("_probe")), "_probe", "left_anti").select(*df.columns)
