"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight; its schedule says how that weight is spread over the training run. The schedule is integrated
to a cumulative token demand, each document covers an interval of its source's demand, and the inverse of the demand
gives the document its training position between 0 and 1, by which the mix is range-sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import stored, whole_row, word_count

WEIGHTS = (5, 2, 1)
#: For each weight the knots (time, density) of its schedule, linear in between: heavy sources early, light ones late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
CAP = 3


def position_at(share: Column, schedule: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the cumulative demand of a schedule reaches ``share`` of its total.

    Within a piece the density is g + m (t - t0), so the demand is quadratic and its inverse a closed form.
    """
    pieces, total = [], 0.0
    for (t0, g0), (t1, g1) in zip(schedule, schedule[1:]):
        pieces.append((t0, g0, (g1 - g0) / (t1 - t0), total))
        total += (t1 - t0) * (g0 + g1) / 2
    found = None
    for t0, g, m, before in pieces:
        over = share * total - before
        root = F.sqrt(F.greatest(F.lit(g * g) + over * (2 * m), F.lit(0.0)))
        at = F.lit(t0) + F.coalesce(over * 2 / F.nullif(F.lit(g) + root, F.lit(0.0)), F.lit(0.0))
        found = at if found is None else F.when(over >= 0, at).otherwise(found)
    return F.least(found, F.lit(schedule[-1][0]))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per source: ``source, source_size, n_docs, class, target``; one row per source, which is few, in one window.

    Targets share the total size by weight. A source whose target would exceed ``cap`` times its size gets just that;
    sources reach their cap in the order of size by weight, so one running sum finds who is capped and the level of the
    rest. All comparisons are of integers.
    """
    big = "decimal(38,0)"
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("class", ((F.row_number().over(order) - 1) % len(weights)).cast("int"))
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("class") + 1).cast("long"))
    everyone = Window.partitionBy()
    by_ratio = Window.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    run = per.select(
        "*",
        F.sum("source_size").over(everyone).alias("total"),
        F.sum("w").over(everyone).alias("all_w"),
        F.coalesce(F.sum("source_size").over(before) * cap, F.lit(0)).alias("taken_up"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"),
    )
    left, open_w = F.col("total") - F.col("taken_up"), F.col("all_w") - F.col("w_before")
    capped = left.cast(big) * F.col("w") > (F.col("source_size") * cap).cast(big) * open_w
    level = left.cast("double") / open_w.cast("double")
    run = run.withColumn("capped", capped).withColumn("level", F.when(~capped, level))
    run = run.withColumn("level", F.first("level", ignorenulls=True).over(by_ratio.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("capped"), (F.col("source_size") * cap).cast("double")).otherwise(F.col("level") * F.col("w"))
    return run.select("source", "source_size", "n_docs", "class", target.alias("target"))


def place(sizes: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, cap: int = CAP) -> DataFrame:
    """Copies and places of documents (``doc_id, source, size``): adds ``source_size, target, whole, passes, start, class``.

    A document is taken ``passes`` times: as often as its source's target holds the whole source, and once more if its
    middle lies within the rest, in the order of a hash of the id. ``start`` is its place in that order in words. Running
    sums are of two steps, over buckets of the hash and within one bucket; a source of n documents has as many buckets as
    its square root, so neither step meets more than about that many rows in a group.
    """
    keyed = stored(
        sizes.withColumn(
            "key", F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
        ),
        "sizes",
    )
    sources = stored(
        targets(keyed, weights, cap)
        .withColumn("buckets", F.ceil(F.sqrt("n_docs")).cast("long"))
        .withColumn("width", F.expr(f"{1 << 60} div buckets + 1")),
        "sources",
    )
    same_source = keyed["source"].eqNullSafe(sources["source"])
    rows = keyed.join(sources, same_source).select(keyed["*"], *(sources[c] for c in sources.columns if c != "source"))
    rows = rows.withColumn("bucket", F.expr("key div width"))
    sums = rows.groupBy("class", "source", "bucket").agg(F.sum("size").alias("in_bucket"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_source"),
        F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("base"),
    )
    inner = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = rows.withColumn("upto", F.sum("size").over(inner))
    met = rows["source"].eqNullSafe(sums["_source"]) & (rows["bucket"] == sums["_bucket"])
    placed = rows.join(sums, met).withColumn("start", F.expr("base + upto - size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))).otherwise(0)
    placed = placed.withColumn("whole", whole.cast("long"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    more = (F.col("start") * 2 + F.col("size")).cast("double") < rest * 2
    return placed.withColumn("passes", F.col("whole") + F.when(more, 1).otherwise(0))


def position(nth: Column, schedules=SCHEDULES) -> Column:
    """Training position of copy ``nth`` (from 0) of a placed document: by the middle of the words it stands for."""
    words = nth * F.col("source_size") + F.col("start") + F.col("size") / 2
    share = F.coalesce(words / F.nullif(F.col("target"), F.lit(0.0)), F.lit(0.0))
    share = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    found = F.lit(0.0)
    for n, schedule in enumerate(schedules):
        found = F.when(F.col("class") == n, position_at(share, schedule)).otherwise(found)
    return found


def document_sizes(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """``doc_id, source, size``: size in words, 0 for a null text."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, cap: int = CAP, **columns: str) -> DataFrame:
    """One row per document, range-sorted by ``position``: ``doc_id, size, source_size, target, taken, position``.

    ``taken`` counts the words the mix takes, repeats included; ``position`` is that of the first copy, null if none is
    taken. Null sources are one source, the last. Null ids share one place in the order, told apart by size. Repeated
    rows are documents of their own. A source without words has target 0. An empty table gives no rows.
    """
    placed = place(document_sizes(docs, **columns), weights, schedules, cap)
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size")).alias("taken"),
        F.when(F.col("passes") > 0, position(F.lit(0), schedules)).alias("position"),
    ).orderBy("position", "doc_id")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, cap: int = CAP) -> DataFrame:
    """The mix itself: documents in their own columns, as often as taken, range-sorted by training position.

    Rows of one id, source and size are numbered on both sides, so each repeated row brings its own passes.
    """
    key = ["id", "source", "size", "nth"]
    alike = Window.partitionBy("id", "source", "size")
    placed = place(document_sizes(docs), weights, schedules, cap).withColumnRenamed("doc_id", "id")
    placed = placed.withColumn("nth", F.row_number().over(alike.orderBy("start")))
    copies = F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1), lambda n: position(n, schedules))
    taken = placed.filter("passes > 0").select(*key, copies.alias("places"))
    rows = docs.select(
        whole_row(docs), F.col("doc_id").alias("id"), F.col("source"), word_count(F.col("text")).alias("size")
    )
    rows = rows.withColumn("nth", F.row_number().over(alike.orderBy(F.col("row")["text"])))
    same = [rows[c].eqNullSafe(taken[c]) for c in key]
    mixed = rows.join(taken, same).select(rows["row"], F.explode(taken["places"]).alias("place"))
    return mixed.orderBy("place").select("row.*")
