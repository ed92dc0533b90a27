"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of characters. All different blocks are sorted (by hash, then by content)
and get an integer name each. Adjacent pairs of names are named in turn, which halves the number of names per document,
until each document has one name. Documents have the same (level, name) exactly if their texts are equal: no step relies
on a hash being free of collisions, for blocks that share a hash are told apart by their content.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import rows_of
from tidemark.llm.shared import ascii_lower, stored

BLOCK = 8192


def _blocks(text: Column, block: int) -> Column:
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(F.length(text) <= block, F.array(text)).otherwise(cut)


def _named(distinct: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """Different keys with an integer ``name`` each, numbered in sorted order within each partition."""
    return stored(distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()), purpose)


def block_names(texts: DataFrame, block: int, block_hash: Callable[[Column], Column]) -> DataFrame:
    """The different blocks of column ``text``: ``h, content, name``; content only where several share the hash.

    Copies of a block are merged within each task before the one shuffle of text, so a block that a third of all
    documents hold costs one row per task.
    """
    single = texts.select(F.explode(_blocks(F.col("text"), block)).alias("block"))
    met = single.groupBy(block_hash(F.col("block")).alias("h")).agg(F.collect_set("block").alias("found"))
    told = met.select("h", F.size("found").alias("n"), F.posexplode(F.array_sort("found")).alias("nth", "content"))
    content = F.when(F.col("n") > 1, F.col("content")).alias("content")
    return _named(told.select("h", content), ["h", "content"], "block-names")


def block_identities(
    texts: DataFrame, block: int = BLOCK, block_hash: Callable[[Column], Column] = F.xxhash64
) -> tuple[DataFrame, DataFrame]:
    """Identities of the rows of ``texts`` by their column ``text`` (not null).

    Gives two stored tables: the rows with a number ``rid`` but without ``text``, and ``rid, level, name``. An empty
    table gives empty ones; an empty text is one empty block. ``block_hash`` only spreads blocks: any function is right.
    """
    names = block_names(texts, block, block_hash)
    # Blocks that share a 64-bit hash are as rare as chance has it: about 300 among 10^11 different blocks.
    clashes = [r.h for r in names.filter("content is not null").select("h").distinct().collect()]
    part = lambda b: F.struct(
        block_hash(b).alias("h"), F.when(block_hash(b).isin(clashes) if clashes else F.lit(False), b).alias("content")
    )
    parts = F.transform(_blocks(F.col("text"), block), part).alias("parts")
    others = [c for c in texts.columns if c != "text"]
    numbered = stored(texts.select(F.monotonically_increasing_id().alias("rid"), *others, parts), "block-hashes")
    at = numbered.select("rid", F.size("parts").alias("left"), F.posexplode("parts").alias("pos", "part"))
    same = (F.col("part.h") == F.col("h")) & F.col("part.content").eqNullSafe(F.col("content"))
    current = stored(at.join(names, same).select("rid", "left", "pos", "name"), "named-blocks")
    done, level = None, 0
    while True:
        finished = current.filter("left = 1").select("rid", F.lit(level).alias("level"), "name")
        done = finished if done is None else done.unionByName(finished)
        rest = current.filter("left > 1")
        if rest.isEmpty():
            return numbered.drop("parts"), done
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = stored(
            rest.groupBy("rid", F.expr("pos div 2").cast("int").alias("pos")).agg(
                F.expr("cast((max(left) + 1) div 2 as int)").alias("left"),
                F.max(F.when(even, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
            ),
            "name-pairs",
        )
        names = _named(pairs.select("a", "b").distinct(), ["a", "b"], "pair-names")
        current = stored(pairs.join(names, ["a", "b"]).select("rid", "left", "pos", "name"), "named-pairs")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = ascii_lower,
    block: int = BLOCK,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised forms are identical; null counts as empty. Of equal texts the row with the
    largest id stays; a null id is smaller than any other, and of repeated rows of one id one stays. Only id and text
    are read, so further columns may have any names. An empty table gives no rows.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    texts = plain.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "text")
    numbered, identities = block_identities(texts, block, block_hash)
    rows = stored(numbered.join(identities, "rid"), "identities")
    newest = F.max(F.struct("doc_id", "rid")).alias("keep")
    # Written, so that both sides of the join are plain shuffles: adaptive execution then splits a group of very many copies.
    groups = stored(rows.groupBy("level", "name").agg(newest, F.count(F.lit(1)).alias("group_size")), "copy-groups")
    return rows.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, in their own columns. Repeated rows of one id and text leave one row."""
    groups = exact_groups(docs, id_col, text_col)
    stay = groups.filter("kept").select(F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_key"))
    return rows_of(docs, stay, id_col, F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256))
