"""Quality rules by distribution divergence.

Each document has two histograms: its characters by class, and its words over the common words of some languages and all
other words. References are the same histograms summed over all documents of a language. A document is judged by its
Jensen-Shannon distance to the nearest reference, and only if it is long enough for its histogram to mean something.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, stored

#: Common words of the languages that have a reference; fixed values.
COMMON = {
    "en": "the of and to in is that for with as on was are be it by this an or from at a not have which you".split(),
    "fr": "le la les de des du et un une en que qui dans pour par sur au aux est ce il elle ne pas plus".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split(),
    "es": "el la los las de del y en que un una a por con no se para es al lo como más o pero sus".split(),
}
#: Words a document must have for its classes to be judged, and the greatest distance that passes.
CLASS_WORDS, CLASS_DISTANCE = 60, 0.27
#: The same for common words, set from the labelled rows of sf0.1 that are not held out: shorter texts may be further off.
COMMON_LIMITS = ((60, 0.35), (100, 0.30), (150, 0.27))
#: Rules on counts: fewest words, and the greatest share of words in repeated windows.
FEWEST, REPEATED, WINDOW = 10, 0.20, 5
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "other")
_MARKS = b""".,;:!?'"()-"""
_PLAIN = bytes(32 if b in b""".,;:!?"()[]""" else b for b in range(256))


def _class_of() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for b in range(128):
        c = chr(b)
        table[b] = (
            0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in " \t\n\r\x0b\x0c"
            else 4 if b in _MARKS else 5
        )
    table[192:] = 6  # first bytes of characters beyond ASCII
    table[128:192] = 7  # further bytes, not counted
    return table


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of some words found twice or more in the text, the first included."""
    windows = list(zip(*(words[n:] for n in range(window))))
    if len(set(windows)) == len(windows):
        return 0
    often, covered, past = Counter(windows), 0, 0
    for at, w in enumerate(windows):
        if often[w] > 1:
            covered += at + window - max(at, past)
            past = at + window
    return covered


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts and histograms of every document: one pass over whole texts."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    listed = sorted({w for words in COMMON.values() for w in words})
    number = {w.encode(): n for n, w in enumerate(listed)}
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def measured(data: bytes, classes: np.ndarray) -> list:
        by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        by_class = np.bincount(classes, by_byte, 8).astype(np.int64)[: len(CLASSES)]
        words = data.split()
        lines = [line for line in data.split(b"\n") if line.strip()]
        plain = Counter(data.translate(_PLAIN).lower().split())
        common = [0] * (len(listed) + 1)
        for w in plain.keys() & number.keys():
            common[number[w]] = plain[w]
        common[-1] = plain.total() - sum(common)
        points = int(by_class.sum())
        symbols = int(by_byte[list(SYMBOLS)].sum())
        return [
            len(words), points - int(by_class[3]), symbols, len(lines) - len(set(lines)), repeated_words(words),
            by_class.tolist(), common,
        ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _class_of()
        for batch in slices(batches, "text", 4 << 20):
            found = [measured(t or b"", classes) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            columns = list(zip(*found))
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            arrays += [pa.array(c, pa.list_(pa.int64())) for c in columns[5:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], ["doc_id", "lang", *counts, "classes", "common"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in counts)
    return rows.mapInArrow(work, f"doc_id {kind}, lang string, {longs}, classes array<long>, common array<long>")


def references(measured: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Summed histograms of each language with a list of common words, over all its documents; a few hundred numbers."""
    languages = measured.filter(F.col("lang").isin(*COMMON))
    found: dict[str, list] = {}
    for column in ("classes", "common"):
        cells = languages.select("lang", F.posexplode(column).alias("cell", "n")).groupBy("lang", "cell").sum("n").collect()
        for lang in {r.lang for r in cells}:
            own = np.zeros(1 + max(r.cell for r in cells))
            for r in cells:
                if r.lang == lang:
                    own[r.cell] = r["sum(n)"]
            found.setdefault(lang, []).append(own)
    return {lang: (a, b) for lang, (a, b) in found.items()}


def distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of counts to a reference; 1 where either is empty."""
    rows, other = counts.sum(axis=1, keepdims=True), reference.sum()
    p, q = counts / np.maximum(rows, 1), reference / max(other, 1)
    m = (p + q) / 2
    part = lambda x: np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)
    found = np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))
    return np.where((rows[:, 0] > 0) & (other > 0), found, 1.0)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept``, ``class_distance``, ``common_distance``.

    ``base_failed``: fewer than ten words, or over a fifth of them in repeated windows. ``kept`` is false if that holds,
    or if a document that is long enough is further from every reference than the limits say. Null texts are empty and
    fail. Null and unknown languages have no reference of their own; they are held to the nearest. If there is no
    reference at all, nothing is judged by distance (it is null). Repeated rows count each, in references too. An empty
    table gives no rows. Ids may be null; further columns may have any names.
    """
    rows = stored(measures(docs, id_col, text_col, lang_col), "quality-measures")
    known = list(references(rows).values())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = []
            for n, name in enumerate(("classes", "common")):
                flat = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy()
                counts = flat.reshape(batch.num_rows, -1).astype(float)
                each = [distances(counts, reference[n]) for reference in known]
                near.append(pa.array(np.min(each, axis=0)) if each else pa.nulls(batch.num_rows, pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], *near], [*batch.schema.names[:7], "class_distance", "common_distance"]
            )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:7]]
    judged = rows.mapInArrow(work, ", ".join([*fields, "class_distance double", "common_distance double"]))
    failed = (F.col("n_words") < FEWEST) | (F.col("n_repeat_words") * 100 > F.col("n_words") * int(REPEATED * 100))
    far = (F.col("n_words") >= CLASS_WORDS) & (F.col("class_distance") > CLASS_DISTANCE)
    for words, distance in COMMON_LIMITS:
        far |= (F.col("n_words") >= words) & (F.col("common_distance") > distance)
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & ~F.coalesce(far, F.lit(False)))
