"""Connected components of links by alternating stars, and the rows of a table that stand for their group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored, whole_row


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over ``u > v``: each node moves to the smallest node it has met."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    large = stored(large, "large-star")
    low = large.groupBy("u").agg(F.min("v").alias("low"))
    met = large.join(low, "u")
    small = met.select("u", F.col("low").alias("v")).unionByName(
        met.filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    )
    return stored(small.distinct(), "small-star")


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (two columns of one ordered type): the smallest node it reaches.

    Repeated links and links to oneself change nothing; a link with a null is left out. The work per round is a few
    shuffles of the links, and rounds grow with the logarithm of the longest path.
    """
    a, b = links.columns
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stored(edges.distinct(), "links")
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).alias("mark")
    seen = edges.select(mark).first().mark
    while True:
        edges = _round(edges)
        now = edges.select(mark).first().mark
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def rows_of(docs: DataFrame, stay: DataFrame, id_col: str, key: Column) -> DataFrame:
    """One row of ``docs`` for each row of ``stay`` (``stay_id, stay_key``), by id (null-safe) and ``key``.

    The rows travel as one column, so their own columns may have any names.
    """
    keyed = docs.select(whole_row(docs), F.col(id_col).alias("id"), key.alias("key"))
    same = keyed["id"].eqNullSafe(stay["stay_id"]) & keyed["key"].eqNullSafe(stay["stay_key"])
    return keyed.join(stay, same, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
