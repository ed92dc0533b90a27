"""Upserts as joins, for tables in a format without ``MERGE``.

Each form keeps the large target out of the shuffle when the incoming batch is
small: the batch is the build side of every join, and Spark broadcasts it only
if its size is below the session's threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A batch holds more than one row for a key."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise unless ``keys`` identify the rows of ``df``. Runs a job."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise DuplicateKeyError(f"more than one row for key {repeated[0].asDict()}")


def existing_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``source`` that ``target`` already holds, once each.

    Semi-joining the target with the batch first lets a small batch be broadcast;
    an anti join of the batch against the target would have to shuffle the target.
    """
    return target.select(*keys).join(source.select(*keys), list(keys), "left_semi").distinct()


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key the target does not hold: the rows to append."""
    return source.join(existing_keys(target, source, keys), list(keys), "left_anti")


def overwrite_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after replacing or adding each row of ``source``. Source keys are unique."""
    untouched = target.join(source.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(source.select(*target.columns))


def update_by_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Like :func:`overwrite_by_key`, but only ``values`` of a matched row change.

    Target columns outside ``keys`` and ``values``, such as a surrogate key, survive.
    Rows without a match are not added.
    """
    fresh = source.select(*keys, F.struct(*values).alias("_new"))
    return target.join(fresh, list(keys), "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )


def guarded_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: Callable[[str], Column]
) -> DataFrame:
    """Target after taking each source row that is at least as new as the row it replaces.

    ``version(prefix)`` is the age of the row whose columns start with ``prefix``.
    A comparison with null keeps the target row. Source keys are unique.
    """
    return guarded_merge(target, source, keys, version).drop("_changed")


def guarded_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: Callable[[str], Column]
) -> DataFrame:
    """:func:`guarded_upsert` with a ``_changed`` flag on the rows taken from the source."""
    columns = target.columns
    old = target.select(*keys, F.struct(*columns).alias("_old"))
    new = source.select(*keys, F.struct(*columns).alias("_new"))
    newer = F.coalesce(version("_new.") >= version("_old."), F.lit(False))
    take = F.col("_new").isNotNull() & newer
    matched = old.join(new, list(keys), "left").select(
        F.when(take, F.col("_new")).otherwise(F.col("_old")).alias("_row"), take.alias("_changed")
    )
    added = insert_new(target, source.select(*columns), keys).select(
        F.struct(*columns).alias("_row"), F.lit(True).alias("_changed")
    )
    return matched.unionByName(added).select("_row.*", "_changed")


def updated_or_loaded(prefix: str) -> Column:
    """Age of a clean row: when its source changed it, else when it was loaded."""
    return F.coalesce(F.col(prefix + "updated_at"), F.col(prefix + "load_ts"))
