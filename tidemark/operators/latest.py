"""Newest row per key, and the views built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import Feed

# Actions of a change row that carry the row's new state.
POST_IMAGES = ("INSERT", "UPDATE")


def latest_by_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``newest_first`` order.

    Spark turns rank-and-filter into a group limit that each task applies before
    the shuffle, so a key with very many copies sends one row per task.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def recency(feed: Feed) -> list[Column]:
    """Newest-first order of a feed's raw rows, made total by the row's load id."""
    if feed.append_only:
        return [F.desc_nulls_last(feed.date_column), F.desc_nulls_last("ingestion_ts"), F.desc_nulls_last("load_id")]
    return [
        F.coalesce(F.col("updated_at"), F.col("ingestion_ts")).desc_nulls_last(),
        F.desc_nulls_last("ingestion_ts"),
        F.desc_nulls_last("load_id"),
    ]


def post_images(changes: DataFrame, key: str) -> DataFrame:
    """Change rows that state a new row version and have a key; deletes are ignored."""
    kept = changes.filter(F.col(key).isNotNull())
    if "_action" in changes.columns:
        kept = kept.filter(F.col("_action").isin(*POST_IMAGES)).drop("_action")
    return kept


def snapshot_as_of(change_log: DataFrame, keys: Sequence[str], load_column: str, at: Column) -> DataFrame:
    """The table as it stood at ``at``, from an append-only log of its row versions."""
    known = change_log.filter(F.col(load_column) <= at)
    return latest_by_key(known, keys, [F.desc_nulls_last(load_column)])
