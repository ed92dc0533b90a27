"""Surrogate keys without a global sort into one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import cut_lineage

_ROW_BITS = 33  # low bits of monotonically_increasing_id that number the rows of a partition


def assign_keys(new_rows: DataFrame, order: Sequence[str], column: str, taken: DataFrame | None = None) -> DataFrame:
    """Number ``new_rows`` in ``order``, densely, after the highest key in ``taken``.

    Rows are range-partitioned and written to the checkpoint folder, so that a lost
    executor cannot renumber them. Each partition's starting number comes from one
    count per partition, which is all that is ever ordered or broadcast.
    """
    spark = new_rows.sparkSession
    ordered = new_rows.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = cut_lineage(ordered.withColumn("_mid", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_part", F.shiftright("_mid", _ROW_BITS))
    counts = tagged.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    if taken is None:
        taken = spark.range(0).select(F.col("id").alias(column))
    base = taken.agg(F.coalesce(F.max(column), F.lit(0)).alias("base")).scalar()
    offset = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per partition of the checkpoint: bounded by the partition count, not by the data.
    numbered = tagged.join(F.broadcast(starts), "_part")
    return numbered.select((base + F.col("_start") + offset + 1).alias(column), *new_rows.columns)
