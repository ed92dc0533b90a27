"""Toxicity of texts that may be disguised: noisy-channel restoration by Viterbi, then a score of words and stems.

A character trigram model is counted over the words of all documents. A disguised word (leetspeak, letters spaced out,
letters repeated) is a lattice of the letters each symbol may stand for, with the channel's costs; Viterbi decoding finds
the likeliest readings. Words and their restored readings are scored by features, the word and its beginnings, each by a
lower confidence bound of the share of toxic documents among the labelled documents that hold it as often. A document's
score is that of its worst feature, stretched so that the best cut of the labelled sample falls on the threshold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, stored
from tidemark.llm.word_memory import memory

#: Labelled documents that the features are learnt from at most, chosen by a hash of the id.
TRAIN_ROWS = 40_000
THRESHOLD = 0.3
#: Shortest and longest beginnings of words that are features.
STEM = range(3, 9)
#: Toxic documents that must hold a feature; documents from which on a frequency is judged on its own; the width of the
#: confidence bound in standard deviations; words among which one occurrence is often.
SUPPORT, LEAST, WIDTH, DENSE = 4, 12, 3.0, 150
#: Letters of the character model: 0 is the border of a word, then these; others share the last place.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100)))
SIZE = 64
#: What a symbol may stand for; fixed values.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
    "*": "aeiou", "#": "aeiou", "а": "a", "е": "e", "о": "o", "і": "i", "с": "c", "р": "p", "х": "x", "у": "y",
}
#: Costs (negative logarithms): a symbol read as a letter, passed over, a repeated letter dropped or kept, an accent lost.
READ, PASSED, DROPPED, KEPT = 0.5, 3.0, 0.2, 0.7
READINGS_KEPT = 3
#: Cost of a border between two words that were spaced out into one run.
BORDER = 1.0
#: Symbols that are decoded at once; longer ones are decoded in pieces that overlap by half, so no word of up to half as
#: many letters is cut in all of them.
PIECE = 64
#: Words that a worker remembers at most; then it starts anew, which costs time and changes nothing.
MOST = 300_000
TRIM = ".,;:?\"'()[]{}…«»“”„`~^%&=/\\>-_#*"
SPACED = re.compile(r"(?<!\S)(?:[\w@$!|+(<€£¡*#][ .\-_*]){2,}[\w@$!|+(<€£¡*#](?![^\s.,;:!?])")
REPEATED = re.compile(r"([^\W\d_])\1\1")
STRETCHED = re.compile(r"(.)\1\1+")
SYMBOL = re.compile(r"[0-9@$!|+(<€£¡*#аеоісрху.\-_​‌‍]")
LETTER = re.compile(r"[^\W\d_]")
INSIDE = ".-_ ​‌‍"


def _classes() -> np.ndarray:
    table = np.zeros(0x250, np.int64)
    for point in range(0x250):
        if chr(point).isalpha():
            small = chr(point).lower()
            table[point] = LETTERS.index(small) + 1 if small in LETTERS else SIZE - 1
    return table


def trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of letter trigrams over the words of all documents; at most 64 to the third cells reach the driver."""

    def work(batches):
        table, counts = _classes(), np.zeros(SIZE**3, np.int64)
        for batch in slices(batches, "text", 2 << 20):
            text = "\n\n".join(t for t in batch.column(0).to_pylist() if t)
            points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
            c = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 0)
            c = np.concatenate(([0, 0], c, [0, 0]))
            c = c[(c > 0) | np.concatenate(([True], c[:-1] > 0)) | np.concatenate((c[1:] > 0, [True]))]
            counts += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], ["cell", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(work, "cell long, n long")
    counts = np.zeros(SIZE**3)
    for cell, n in found.groupBy("cell").sum("n").collect():
        counts[cell] = n
    return counts.reshape(SIZE, SIZE, SIZE)


def character_model(counts: np.ndarray) -> np.ndarray:
    """Negative logarithm of a letter's probability after two others, smoothed by the shorter contexts."""
    one = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + SIZE)
    pairs = counts.sum(axis=0)
    two = (pairs + 5 * one) / (pairs.sum(axis=1, keepdims=True) + 5)
    three = (counts + 5 * two) / (counts.sum(axis=2, keepdims=True) + 5)
    return -np.log(three).astype(np.float32)


#: Places of letters in the character model.
PLACE = {letter: n + 1 for n, letter in enumerate(LETTERS)}


def flat(model: np.ndarray) -> list[float]:
    """The character model as a list: single cells of a list are read faster than those of an array."""
    return model.ravel().tolist()


def readings(token: str, model: list[float] | np.ndarray, borders: bool = False) -> list[str]:
    """The likeliest letter strings behind a disguised token, found by Viterbi over its whole lattice.

    A state is the last two letters; it keeps its likeliest strings, so the result is exact. With ``borders`` a border of
    words, a space in the result, may lie before each symbol.
    """
    cells = model if isinstance(model, list) else flat(model)
    states: dict[tuple[int, int], dict[str, float]] = {(0, 0): {"": 0.0}}
    last = ""
    for at, symbol in enumerate(token):
        if borders and at:
            split: dict[str, float] = {}
            for (a, b), paths in states.items():
                if b:
                    cost = BORDER + cells[(a * SIZE + b) * SIZE]
                    split |= {s + " ": p + cost for s, p in paths.items()}
            if split:
                states.setdefault((0, 0), {}).update(_best(split))
        read = READINGS.get(symbol, "")
        options: list[tuple[str, int, float]] = [(r, PLACE.get(r, SIZE - 1), READ) for r in read]
        if symbol in INSIDE:
            options.append(("", 0, 0.0))
        elif not read and symbol.isalpha():
            options.append((symbol, PLACE.get(symbol, SIZE - 1), KEPT if symbol == last else 0.0))
        elif not read or not at or at == len(token) - 1 or symbol == last or symbol == token[at + 1]:
            options.append(("", 0, PASSED))
        if symbol == last:
            options.append(("", 0, DROPPED))
        last = symbol
        step: dict[tuple[int, int], dict[str, float]] = {}
        merged = False
        for (a, b), paths in states.items():
            row = (a * SIZE + b) * SIZE
            for letter, c, cost in options:
                if letter:
                    key, cost = (b, c), cost + cells[row + c]
                else:
                    key = (a, b)
                own = step.get(key)
                if own is None:
                    step[key] = {s + letter: p + cost for s, p in paths.items()}
                    continue
                merged = True
                for string, p in paths.items():
                    longer = string + letter
                    if p + cost < own.get(longer, math.inf):
                        own[longer] = p + cost
        states = {key: _best(paths) for key, paths in step.items()} if merged else step
    ends = {s: p + cells[(a * SIZE + b) * SIZE] for (a, b), paths in states.items() for s, p in paths.items()}
    return list(_best(ends))


def _best(paths: dict[str, float]) -> dict[str, float]:
    """The likeliest strings, ties in their order."""
    if len(paths) <= 1:  # nothing to choose
        return paths
    return dict(sorted(paths.items(), key=lambda x: (x[1], x[0]))[:READINGS_KEPT])


def disguised(token: str) -> bool:
    return bool(SYMBOL.search(token) or REPEATED.search(token)) and bool(LETTER.search(token))


def pieces(token: str) -> list[str]:
    """A token, or what is to be decoded of a long one: stretched letters are cut to two first, then it is cut up."""
    if len(token) > PIECE:
        token = STRETCHED.sub(r"\1\1", token)
    if len(token) <= PIECE:
        return [token]
    return [token[n : n + PIECE] for n in range(0, len(token) - PIECE // 2, PIECE // 2)]


def inner_features(run: str) -> Iterator[str]:
    """Features from every start in a run of letters whose words may not have been found: long enough to be no chance."""
    for start in range(len(run)):
        for n in range(5, STEM.stop):
            if start + n <= len(run):
                yield run[start : start + n]
        for n in range(4, 17):
            if start + n <= len(run):
                yield run[start : start + n] + "$"


def features(word: str) -> Iterator[str]:
    """The word itself and its beginnings."""
    yield word + "$"
    for n in STEM:
        if len(word) >= n:
            yield word[:n]


def _sample(docs, labels, id_col, text_col, label_col, train_rows):
    """Labelled documents outside the held-out quarter: ``text, y``."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("y")).filter("y is not null and _id is not null")
    known = known.groupBy("_id").agg(F.max("y").cast("int").alias("y"))
    known = known.filter(F.crc32(F.col("_id").cast("string").cast("binary")) % 4 != 2)
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    met = texts.join(F.broadcast(chosen), "_id")
    return met.groupBy("_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))  # one id has one label


def frequency(count: int, words: int) -> int:
    """How often a feature occurs in a text: once, twice or more, and whether that is often for the text's length."""
    return min(count, 3) * 2 + (count * DENSE >= words)


def bound(toxic: int, clean: int, width: float = WIDTH) -> float:
    """Lower end of Wilson's interval of the share of toxic documents."""
    n, z = toxic + clean, width * width
    p = toxic / n
    return (p + z / (2 * n) - width * math.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)


def _pair_key(text: str) -> int:
    """The smallest hash of a pair of words, which near copies mostly share."""
    words = text.split()
    return min((xxhash.xxh64_intdigest(f"{a} {b}") for a, b in zip(words, words[1:] or words)), default=0) >> 1


def toxic_features(sample: DataFrame, support: int = SUPPORT, least: int = LEAST) -> dict[str, dict[int, float]]:
    """Features and their bounds by frequency, 0 standing for any; only features whose bound exceeds a tenth.

    A frequency is judged on its own if ``least`` documents have it. Of labelled documents that share their smallest
    hash of a word pair the one whose text comes first is counted, of equal texts a toxic one. The features come from a bounded sample, so they are bounded as well.
    """

    def keyed(batches):
        for batch in slices(batches, "text"):
            keys = pa.array([_pair_key(t or "") for t in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, batch.column(0), batch.column(1)], ["k", "text", "y"])

    def counted(batches):
        toxic, clean = Counter(), Counter()
        for batch in slices(batches, "text"):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = Counter(w.strip(TRIM + "!") for w in (text or "").lower().split())
                total, found = words.total(), Counter()
                for w, n in words.items():
                    for f in features(w):
                        found[f] += n
                (toxic if y else clean).update((f, frequency(n, total)) for f, n in found.items())
        names = list(toxic.keys() | clean.keys())
        columns = [pa.array([f for f, _ in names], pa.string()), pa.array([k for _, k in names], pa.int32())]
        columns += [pa.array([c[f] for f in names], pa.int64()) for c in (toxic, clean)]
        yield from pa.Table.from_arrays(columns, ["f", "often", "toxic", "clean"]).to_batches(20_000)

    texts = sample.select("text", "y").mapInArrow(keyed, "k long, text string, y int")
    first = F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), (-F.col("y")).alias("less"))).alias("first")
    single = texts.groupBy("k").agg(first).select("first.text", (-F.col("first.less")).alias("y"))
    per = single.mapInArrow(counted, "f string, often int, toxic long, clean long")
    per = per.groupBy("f", "often").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    seen = F.collect_list(F.struct("often", "toxic", "clean")).alias("seen")
    all_of = per.groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), seen)
    likely = all_of.filter((F.col("toxic") >= support) & (F.col("toxic") * 9 > F.col("clean"))).collect()
    learnt = {}
    for r in likely:
        if (any_often := bound(r.toxic, r.clean)) > 0.1:
            learnt[r.f] = {0: any_often} | {s.often: bound(s.toxic, s.clean) for s in r.seen if s.toxic + s.clean >= least}
    return learnt


class Scorer:
    """Scores texts by learnt features; words are remembered by the worker until it meets another model.

    Most words have no disguise and begin like no feature, which is seen at once.
    """

    def __init__(self, weights: dict[str, dict[int, float]], model: np.ndarray, key: str):
        self.weights, self.model, self.known = weights, flat(model), memory("words", f"toxicity {key}")
        self.starts = {f[:3] for f in weights}

    def _of(self, found: Iterator[str]) -> tuple[str, ...]:
        return tuple(dict.fromkeys(f for f in found if f in self.weights))

    def word(self, token: str) -> tuple[str, ...]:
        """The learnt features of a word and of its readings; a long one's pieces may begin within words."""
        core = token.strip(TRIM)
        plain = core.strip("!")
        own = list(features(plain))
        if disguised(core):
            cut = pieces(core)
            for piece in cut:
                for reading in readings(piece, self.model):
                    own += features(reading)
                    if len(cut) > 1:
                        own += inner_features(reading)
        return self._of(own)

    def spaced(self, run: str) -> tuple[str, ...]:
        """The learnt features of the words in a run of single symbols."""
        letters, own = re.sub(r"[ .\-_*]", "", run), []
        for piece in pieces(letters):
            for reading in readings(piece, self.model, borders=True):
                for word in reading.split(" "):
                    own += features(word)
                own += inner_features(reading.replace(" ", ""))
        return self._of(own)

    def text(self, text: str) -> float:
        small = text.lower()
        words = Counter(small.split())
        known, starts, found = self.known, self.starts, {}
        if len(known) > MOST:
            known.clear()
        for w in words:
            own = known.get(w)
            if own is None:
                core = w.strip(TRIM)
                plain = core.isascii() and core.isalpha() or not SYMBOL.search(core)
                if plain and (core + "$")[:3] not in starts and not REPEATED.search(core):
                    known[w] = ()
                    continue
                own = known[w] = self.word(w)
            for f in own:
                found[f] = found.get(f, 0) + words[w]
        for m in SPACED.finditer(small):
            for f in self.spaced(m[0]):
                found[f] = found.get(f, 0) + 1
        total, best = words.total(), 0.0
        for f, n in found.items():
            by_often = self.weights[f]
            best = max(best, by_often.get(frequency(n, total), by_often[0]))
        return best


def best_cut(scores: list[tuple[float, int, int]]) -> float:
    """The raw score from which on calling a document toxic has the best F1: of ``(score, toxic, clean)`` counts.

    The middle between the score and the one below it; one half if nothing is toxic.
    """
    scores = sorted(scores, reverse=True)
    all_toxic, toxic, clean, best, cut = sum(t for _, t, _ in scores), 0, 0, 0.0, 0.5
    for at, (score, t, c) in enumerate(scores):
        toxic, clean = toxic + t, clean + c
        f1 = 2 * toxic / (toxic + clean + all_toxic) if all_toxic else 0.0
        if f1 > best and score > 0:
            below = scores[at + 1][0] if at + 1 < len(scores) else 0.0
            best, cut = f1, (score + below) / 2
    return cut


def calibrated(raw: float, cut: float, threshold: float) -> float:
    """Rising from 0 to 1, with the cut at the threshold."""
    if raw < cut:
        return threshold * raw / cut
    return threshold + (1 - threshold) * (raw - cut) / max(1 - cut, 1e-9)


def _sample_cut(sample: DataFrame, shared) -> float:
    """The best cut of the labelled sample; raw scores meet the driver as counts of a thousand steps."""

    def work(batches):
        scorer = Scorer(*shared.value)
        for batch in slices(batches, "text"):
            steps = [round(1000 * scorer.text(t)) if t else 0 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(steps, pa.int32()), batch.column(1)], ["step", "y"])

    steps = sample.select("text", "y").mapInArrow(work, "step int, y int").groupBy("step")
    counts = steps.agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)), F.sum(F.when(F.col("y") > 0, 0).otherwise(1)))
    return best_cut([(step / 1000, toxic, clean) for step, toxic, clean in counts.collect()])


def _learnt(docs, labels, id_col, text_col, label_col, train_rows):
    """The broadcast scorer's parts and the cut, learnt from the labelled sample and the character model of all texts."""
    model = character_model(trigrams(docs, text_col))
    sample = stored(_sample(docs, labels, id_col, text_col, label_col, train_rows).select("text", "y"), "toxicity-sample")
    weights = toxic_features(sample)
    told = repr(sorted((f, sorted(w.items())) for f, w in weights.items()))
    key = f"{xxhash.xxh64_hexdigest(model.tobytes())}-{xxhash.xxh64_hexdigest(told)}"
    shared = docs.sparkSession.sparkContext.broadcast((weights, model, key))
    return shared, _sample_cut(sample, shared)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    ``held_out`` marks ids whose CRC-32, of the id as text, leaves 2 modulo 4; they are not learnt from (a null id
    counts as an empty text). Labels that are null, or of no document, are passed over; of several for one id the larger
    counts. Null and empty texts score 0, and so does everything if there are no labels. Repeated rows are scored each.
    An empty table gives no rows. Scores depend on
    texts and the ids that were learnt from, not on the order or partitions of rows; of several texts under one learnt id
    the first in order counts.
    """
    shared, cut = _learnt(docs, labels, id_col, text_col, label_col, train_rows)
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.crc32(name.cast("binary")) % 4 == 2).alias("held_out"), F.col(text_col).alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in slices(batches, "text"):
            scores = [calibrated(scorer.text(t), cut, threshold) if t else 0.0 for t in batch.column(2).to_pylist()]
            predicted = pa.array([int(s >= threshold) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), predicted],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents whose score stays below the threshold, in their own columns; rows are decided on as they pass."""
    shared, cut = _learnt(docs, labels, id_col, text_col, label_col, train_rows)
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in slices(batches, text_col):
            texts = batch.column(at).to_pylist()
            keep = [not t or calibrated(scorer.text(t), cut, threshold) < threshold for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
