"""Ordered windows for keys that may hold a large share of all rows.

A plain window puts a whole key into one task. Here the key is cut into slices
(months, hours, any coarse form of the ordering column): each slice is ordered on
its own, and only one summary row per slice is ordered across the key. The join
that brings the summaries back uses the slices' own partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_sliced(df: DataFrame, keys: Sequence[str], slice_by: str, order: str, value: str, name: str) -> DataFrame:
    """Add the previous row's ``value`` within the key. ``value`` is never null."""
    return _neighbour(df, keys, slice_by, order, value, name, F.lag, F.max_by)


def lead_sliced(df: DataFrame, keys: Sequence[str], slice_by: str, order: str, value: str, name: str) -> DataFrame:
    """Add the next row's ``value`` within the key. ``value`` is never null."""
    return _neighbour(df, keys, slice_by, order, value, name, F.lead, F.min_by)


def _neighbour(df, keys, slice_by, order, value, name, shift, edge_of) -> DataFrame:
    at = [*keys, slice_by]
    near = shift(value).over(Window.partitionBy(*at).orderBy(order))
    edges = df.groupBy(*at).agg(edge_of(value, order).alias("_edge"))
    far = edges.select(*at, shift("_edge").over(Window.partitionBy(*keys).orderBy(slice_by)).alias("_carry"))
    joined = df.withColumn(name, near).join(far, at, "left")
    return joined.withColumn(name, F.coalesce(name, "_carry")).drop("_carry")


def running_sum_sliced(
    df: DataFrame, keys: Sequence[str], slice_by: str, order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Add the sum of ``value`` over the key's rows up to and including each row."""
    at = [*keys, slice_by]
    valued = df.withColumn("_v", value)
    upto = Window.partitionBy(*at).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(slice_by).rowsBetween(Window.unboundedPreceding, -1)
    totals = valued.groupBy(*at).agg(F.sum("_v").alias("_total"))
    carry = totals.select(*at, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carry"))
    joined = valued.withColumn("_near", F.sum("_v").over(upto)).join(carry, at, "left")
    return joined.withColumn(name, F.col("_near") + F.coalesce("_carry", F.lit(0))).drop("_v", "_near", "_carry")
