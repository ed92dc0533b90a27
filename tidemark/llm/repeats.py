"""Substring deduplication by hashing of lines, paragraphs and runs of neighbouring sentences.

A unit is a line, a paragraph, or as many neighbouring sentences as make the least length; one such run begins at every
sentence, so a passage that was pasted into the middle of a line is found by the runs within it, and short sentences
between others go with them. Units are normalised (lower case, single spaces) and get a 128-bit digest. Digests are
grouped over all documents; the earliest occurrence, by id and place, stays. The others are removed: where their units
touch or overlap they are joined to one span, with its offsets in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, stored

#: Words of a unit at least. Where words are not spaced, so many characters count as one.
LEAST_WORDS, WIDE_WORD = 16, 12
#: A sentence, or what a line holds of one.
SENTENCE = re.compile(r"\S[^\n.!?]*(?:[.!?]+(?!\s|$)[^\n.!?]*)*(?:[.!?]+)?")
LINE = re.compile(r"\S[^\n]*")
PARAGRAPH = re.compile(r"\S(?:[^\n]|\n(?![^\S\n]*\n))*")


def size_of(words: list[str], characters: int) -> int:
    return max(len(words), characters // WIDE_WORD)


def units(text: str, least: int = LEAST_WORDS) -> Iterator[tuple[int, int, bytes]]:
    """``(start, end, digest)`` of the units of a text; offsets in code points. A span is given once for each digest."""
    sentences = [(m.start(), m.start() + len(m[0].rstrip()), m[0].split()) for m in SENTENCE.finditer(text)]
    sizes = [size_of(words, end - start) for start, end, words in sentences]
    seen, last, total = set(), 0, 0
    for first, (start, _, _) in enumerate(sentences):
        while last < len(sentences) and total < least:
            total += sizes[last]
            last += 1
        if total < least:
            break
        end = sentences[last - 1][1]
        seen.add((start, end))
        yield start, end, _digest(w for _, _, words in sentences[first:last] for w in words)
        total -= sizes[first]
    for pattern in (LINE, PARAGRAPH):
        for m in pattern.finditer(text):
            words = m[0].split()
            span = (m.start(), m.start() + len(m[0].rstrip()))
            if span not in seen and size_of(words, span[1] - span[0]) >= least:
                seen.add(span)
                yield *span, _digest(words)


def _digest(words) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).lower())


def unit_rows(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """All units: ``doc_id, row, start, end, high, low``; ``row`` tells documents of one id apart."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            at, starts, ends, digests = [], [], [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                for start, end, digest in units(text or "", least):
                    at.append(n)
                    starts.append(start)
                    ends.append(end)
                    digests.append(digest)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            place = pa.array(at, pa.int64())
            longs = [pa.array(x, pa.int64()) for x in (starts, ends, halves[:, 0], halves[:, 1])]
            own = [batch.column(0).take(place), batch.column(2).take(place)]
            yield pa.RecordBatch.from_arrays([*own, *longs], ["doc_id", "row", "start", "end", "high", "low"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, row long, start long, end long, high long, low long")


def repeated_units(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS
) -> DataFrame:
    """One row per span to remove: ``doc_id, start, end, units, keep_id, keep_start``.

    Of equal units the earliest by id, row and place stays; a null id comes after all others. ``keep_id`` and
    ``keep_start`` say where the first unit of the span is kept, ``units`` how many units it is joined of. Repeats within
    a document count. Null and empty texts have no units. Repeated rows are documents of their own, of which one keeps its
    units. An empty table gives no rows. Only id and text are read, texts whole.

    The earliest occurrence of a digest is found by one aggregation with a sum per task first; units then meet the digests
    seen more than once in a join whose hot keys are split. Spans are joined within one document's units.
    """
    keys = ["high", "low"]
    found = stored(unit_rows(docs, id_col, text_col, least), "units")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "start")
    often = found.groupBy(*keys).agg(F.min(place).alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    often = stored(often.drop("n"), "repeated-digests")
    gone = found.join(often, keys).filter((F.col("row") != F.col("keep.row")) | (F.col("start") != F.col("keep.start")))
    reading = Window.partitionBy("row").orderBy("start", "end", *keys)
    reached = F.max("end").over(reading.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("start") > reached + 1), 1).otherwise(0)
    spans = gone.withColumn("begins", begins).withColumn("span", F.sum("begins").over(reading))
    first = F.min(F.struct("start", "end", "keep")).alias("first")
    joined = spans.groupBy("row", "span").agg(F.first("doc_id").alias("doc_id"), first, F.max("end").alias("end"), F.count(F.lit(1)).alias("units"))
    return joined.select(
        "doc_id", F.col("first.start").alias("start"), "end", "units",
        F.col("first.keep.doc_id").alias("keep_id"), F.col("first.keep.start").alias("keep_start"),
    )


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without some spans; white space that is left before a line's end goes as well."""
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at:start])
        at = max(at, end)
    out.append(text[at:])
    return re.sub(r"[ \t]+(?=\n|$)", "", "".join(out))
