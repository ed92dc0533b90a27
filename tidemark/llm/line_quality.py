"""Quality of texts by a linear-chain conditional random field over their lines.

Every line is good or bad. A line speaks by binned counts of its characters and words and by those of the line before and
the line after it; the chain adds what one line's label says about the next. The weights are fitted on labelled documents,
whose lines all take the document's label: each step's gradient is summed over the stored sample by a Spark job, and only
the weights, whose number is fixed, meet on the driver. A document's quality is the mean of its lines' forward-backward
marginals, weighted by their lengths, stretched so that the sample's best cut falls on the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, stored

#: Labelled documents that the weights are fitted on at most, chosen by a hash of the id.
TRAIN_ROWS = 20_000
THRESHOLD = 0.5
STEPS, PENALTY, MEMORY = 40, 1e-3, 8
#: Characters that stand for junk rather than prose.
SYMBOLS = "#*$%&|<>@^~=+/\\{}[]_`"
#: Classes of characters.
OTHER, LOWER, UPPER, DIGIT, SPACE, STOP, LIGHT, SYMBOL, BANG, LINE = range(10)
#: Upper ends of the bins of each count; a value lies in the first bin whose end it does not reach.
SHARES = (0.001, 0.02, 0.06, 0.12, 0.25, 0.5, 0.8)
BINS = {
    "characters": (1, 20, 60, 120, 240, 480, 1500),
    "words": (1, 4, 10, 20, 40, 80, 250),
    "upper": SHARES,
    "symbols": SHARES,
    "odd ends": SHARES,
    "bangs": SHARES,
    "digits": SHARES,
    "stops": (0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.8),
    "word length": (2, 3, 4, 5, 6, 8, 12),
    "same word": SHARES,
    "short words": SHARES,
    "accents": SHARES,
    "again": (0.5,),
    "ends in a stop": (0.5,),
    "document": (1, 10, 20, 50, 150, 500, 2000),
}
WIDTH = 8
KINDS = len(BINS)
#: Where weights lie: own, previous and next line's features, no previous line, no next line, four transitions, start.
PREVIOUS, NEXT, FIRST, LAST = KINDS * WIDTH, 2 * KINDS * WIDTH, 3 * KINDS * WIDTH, 3 * KINDS * WIDTH + 1
MOVES, START = LAST + 1, LAST + 5
SIZE = START + 1


def _classes() -> np.ndarray:
    table = np.full(0x250, OTHER, np.uint8)
    for point in range(0x250):
        c = chr(point)
        table[point] = (
            LINE if c == "\n" else SPACE if c.isspace() else DIGIT if c.isdigit() else BANG if c == "!" else STOP if c in ".?"
            else LIGHT if c in ",;:'\"()-" else SYMBOL if c in SYMBOLS else UPPER if c.isupper() else LOWER if c.isalpha() else OTHER
        )
    return table


CLASSES = _classes()
#: An odd number whose powers spread the places of a word's letters; its inverse modulo 2 to the 64th.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of some texts: feature numbers (a row each), lengths in code points, and lines per text."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    kind = np.where(points < len(CLASSES), CLASSES[np.minimum(points, len(CLASSES) - 1)], LOWER)
    ends = np.flatnonzero(points == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    lengths = ends - starts
    per_text = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
    n = len(ends)
    line = np.repeat(np.arange(n), lengths + 1)
    counts = np.bincount(line * 10 + kind, minlength=10 * n).reshape(n, 10).astype(np.float64)
    accents = np.bincount(line[(points > 127) & (kind <= UPPER)], minlength=n)

    inside = (kind != SPACE) & (kind != LINE)
    begin = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    stop = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False])))
    own, size = line[begin], stop - begin + 1
    words = np.bincount(own, minlength=n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(points.astype(np.uint64) * _powers(BASE, len(points)), dtype=np.uint64)))
    back = _powers(INVERSE, len(points))
    digest = (sums[stop + 1] - sums[begin]) * back[begin]
    same = np.zeros(len(begin), bool)
    for lag in range(1, min(5, len(begin))):
        same[lag:] |= (digest[lag:] == digest[:-lag]) & (own[lag:] == own[:-lag])
    per_line = lambda mark: np.bincount(own[mark], minlength=n)
    odd = np.isin(kind[stop], (SYMBOL, BANG))

    text = np.repeat(np.arange(len(texts)), per_text)
    whole = (sums[ends] - sums[starts]) * back[starts]
    order = np.lexsort((np.arange(n), whole, text))
    again = np.zeros(n, bool)
    again[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    last = np.where(lengths > 0, kind[np.maximum(ends - 1, 0)], OTHER)

    shown, some = np.maximum(lengths - counts[:, SPACE], 1), np.maximum(words, 1)
    letters = np.maximum(counts[:, UPPER] + counts[:, LOWER] + counts[:, OTHER], 1)
    values = {
        "characters": lengths, "words": words, "upper": counts[:, UPPER] / letters, "symbols": counts[:, SYMBOL] / shown,
        "odd ends": per_line(odd) / some, "bangs": counts[:, BANG] / some, "digits": counts[:, DIGIT] / shown,
        "stops": counts[:, STOP] / some, "word length": shown / some, "same word": per_line(same) / some,
        "short words": per_line(size <= 3) / some, "accents": accents / letters, "again": again & (words > 0),
        "ends in a stop": last == STOP, "document": np.bincount(text, words, len(texts))[text],
    }
    ids = np.empty((n, KINDS), np.int16)
    for k, (name, bins) in enumerate(BINS.items()):
        ids[:, k] = k * WIDTH + np.searchsorted(bins, np.asarray(values[name], np.float64), side="right")
    return ids, lengths, per_text


def potentials(ids: np.ndarray, per_text: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How much each line's features and its neighbours' speak for good."""
    if not len(ids):
        return np.zeros(0)
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    last = np.cumsum(per_text) - 1
    out = weights[ids].sum(axis=1)
    before = np.concatenate(([0.0], weights[PREVIOUS + ids[:-1]].sum(axis=1)))
    after = np.concatenate((weights[NEXT + ids[1:]].sum(axis=1), [0.0]))
    before[first], after[last] = weights[FIRST], weights[LAST]
    return out + before + after


def forward_backward(speak: np.ndarray, per_text: np.ndarray, moves: np.ndarray, start: float):
    """Probability that each line is good, expected moves of each text, and the logarithm of each text's sum over labels.

    All texts go forward and backward together, those of many lines first, one line of each at a time.
    """
    order = np.argsort(-per_text, kind="stable")
    counts, first = per_text[order], (np.cumsum(per_text) - per_text)[order]
    odds = np.clip(speak, -50, 50)
    own = np.stack((1 / (1 + np.exp(odds)), 1 / (1 + np.exp(-odds))), axis=1)
    move = np.exp(moves)
    forward, backward = np.ones((len(speak), 2)), np.ones((len(speak), 2))
    scale = np.zeros(len(speak))
    longest = int(counts[0]) if len(counts) else 0
    reach = np.searchsorted(-counts, -np.arange(longest + 1), side="left")  # texts with more lines than that
    for t in range(longest):
        at = first[: reach[t]] + t
        now = own[at] * (forward[at - 1] @ move if t else np.exp([0.0, start]))
        total = now.sum(axis=1)
        forward[at], scale[at] = now / total[:, None], np.log(total)
    for t in range(longest - 2, -1, -1):
        at = first[: reach[t + 1]] + t
        now = (own[at + 1] * backward[at + 1]) @ move.T
        backward[at] = now / now.sum(axis=1, keepdims=True)
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    text = np.repeat(np.arange(len(per_text)), per_text)
    total = np.bincount(text, scale + np.logaddexp(0, odds), len(per_text))
    later = np.flatnonzero(text[1:] == text[:-1]) + 1
    pairs = forward[later - 1][:, :, None] * move * (own[later] * backward[later])[:, None, :]
    pairs /= pairs.sum(axis=(1, 2), keepdims=True)
    return good, (text[later], pairs), total


def gradient(ids: np.ndarray, per_text: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Negative log-likelihood of some labelled texts and its gradient, as one array; a text counts once, however long."""
    out = np.zeros(SIZE + 1)
    if not len(ids):
        return out
    speak, moves = potentials(ids, per_text, weights), weights[MOVES : MOVES + 4].reshape(2, 2)
    good, (text, pairs), total = forward_backward(speak, per_text, moves, weights[START])
    share = 1.0 / per_text
    each, first = np.repeat(share, per_text), np.cumsum(per_text) - per_text
    label = np.repeat(labels, per_text)
    told = np.bincount(np.repeat(np.arange(len(per_text)), per_text), speak * label, len(per_text))
    told = told + (per_text - 1) * moves[labels, labels] + labels * weights[START]
    out[SIZE] = (share * (total - told)).sum()
    off = (good - label) * each
    inner = np.ones(len(ids), bool)
    inner[first] = False
    add = lambda k, off: np.bincount(k.ravel(), np.repeat(off, KINDS), SIZE)
    out[:SIZE] = add(ids.astype(np.int64), off)
    out[:SIZE] += add(PREVIOUS + ids[:-1][inner[1:]].astype(np.int64), off[1:][inner[1:]])
    out[:SIZE] += add(NEXT + ids[1:][inner[1:]].astype(np.int64), off[:-1][inner[1:]])
    out[FIRST], out[LAST] = off[first].sum(), off[first + per_text - 1].sum()
    expected = (pairs * share[text][:, None, None]).sum(axis=0)
    expected[[0, 1], [0, 1]] -= np.bincount(labels, share * (per_text - 1), 2)
    out[MOVES : MOVES + 4] = expected.ravel()
    out[START] = (share * (good[first] - labels)).sum()
    return out


def _sample(docs, labels, id_col, text_col, label_col, train_rows):
    """Features of labelled documents outside the held-out third: ``y, lines, ids`` of each."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("y")).filter("y is not null and _id is not null")
    known = known.groupBy("_id").agg(F.min("y").cast("int").alias("y"))
    known = known.filter(F.crc32(F.col("_id").cast("string").cast("binary")) % 3 != 1)
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    met = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    met = met.groupBy("_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))  # one id has one label

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            ids, lengths, per_text = line_features([t or "" for t in batch.column(0).to_pylist()])
            ends = np.cumsum(per_text)
            rows = [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), per_text.tolist())]
            sizes = [lengths[e - n : e].astype(np.int64).tobytes() for e, n in zip(ends.tolist(), per_text.tolist())]
            columns = [batch.column(1), pa.array(per_text), pa.array(rows, pa.binary()), pa.array(sizes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["y", "lines", "ids", "lengths"])

    return met.select("text", "y").mapInArrow(work, "y int, lines long, ids binary, lengths binary")


def _taken(batch: pa.RecordBatch):
    """``ids, lengths, lines, y`` of a batch of the stored sample."""
    ids = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int16).reshape(-1, KINDS)
    lengths = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int64)
    return ids, lengths, batch.column(1).to_numpy(), (batch.column(0).to_numpy() > 0).astype(np.int64)


def fit(sample: DataFrame, steps: int = STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Weights by limited-memory BFGS; loss and gradient of each step are one Spark job over the sample."""

    def summed(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def work(batches):
            for batch in slices(batches, "ids"):
                ids, _, per_text, labels = _taken(batch)
                cells = np.append(gradient(ids, per_text, labels, weights), batch.num_rows)
                cells = np.round(cells * 2**30).astype(np.int64)  # whole numbers: sums in any order are the same
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

        found = np.zeros(SIZE + 2)
        parts = sample.mapInArrow(work, "cell long, n long").groupBy("cell").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
        for cell, n in parts.collect():
            found[cell] = float(n) / 2**30
        n = max(found[SIZE + 1], 1.0)
        return found[SIZE] / n + penalty / 2 * weights @ weights, found[:SIZE] / n + penalty * weights

    weights = np.zeros(SIZE)
    loss, slope = summed(weights)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(slope).max() < 1e-5:
            break
        ahead, marks = -slope, []
        for s, y in reversed(past):
            marks.append(s @ ahead / (s @ y))
            ahead = ahead - marks[-1] * y
        if past:
            s, y = past[-1]
            ahead = ahead * (s @ y) / (y @ y)
        for (s, y), mark in zip(past, reversed(marks)):
            ahead = ahead + s * (mark - y @ ahead / (s @ y))
        length = 1.0 if past else min(1.0, 1 / np.abs(slope).sum())
        while True:
            tried = weights + length * ahead
            then, slope_then = summed(tried)
            if then <= loss + 1e-4 * length * (slope @ ahead):
                break
            length /= 2
            if length < 1e-6:
                return weights
        s, y = tried - weights, slope_then - slope
        if s @ y > 1e-12:
            past = [*past, (s, y)][-MEMORY:]
        weights, loss, slope = tried, then, slope_then
    return weights


def raw_scores(ids: np.ndarray, lengths: np.ndarray, per_text: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean probability of good lines, weighted by length; a line break counts as one character."""
    moves = weights[MOVES : MOVES + 4].reshape(2, 2)
    good = forward_backward(potentials(ids, per_text, weights), per_text, moves, weights[START])[0]
    text, size = np.repeat(np.arange(len(per_text)), per_text), lengths + 1.0
    return np.bincount(text, good * size, len(per_text)) / np.bincount(text, size, len(per_text))


def best_cut(counts: list[tuple[int, int, int]], steps: int) -> float:
    """The raw score from which on calling a document good is right most often: of ``(step, good, bad)`` counts.

    The middle of the widest stretch that is best; one half if one of the labels is missing.
    """
    good, bad = np.zeros(steps + 2), np.zeros(steps + 2)
    for step, g, b in counts:
        good[step], bad[step] = g, b
    if not good.any() or not bad.any():
        return 0.5
    right = np.cumsum(bad) - bad + good.sum() - (np.cumsum(good) - good)  # calling steps below n bad
    best = np.flatnonzero(right[1 : steps + 1] == right[1 : steps + 1].max()) + 1
    runs = np.split(best, np.flatnonzero(np.diff(best) != 1) + 1)
    widest = max(runs, key=len)
    return float(widest[0] + widest[-1]) / 2 / steps


def _sample_cut(sample: DataFrame, weights: np.ndarray, steps: int = 1000) -> float:
    def work(batches):
        for batch in slices(batches, "ids"):
            ids, lengths, per_text, labels = _taken(batch)
            at = np.floor(raw_scores(ids, lengths, per_text, weights) * steps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(labels)], ["step", "y"])

    per = sample.mapInArrow(work, "step int, y long").groupBy("step").agg(F.sum("y"), F.sum(1 - F.col("y")))
    return best_cut([tuple(r) for r in per.collect()], steps)


def line_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    ``held_out`` marks ids whose CRC-32, of the id as text, leaves 1 modulo 3; they are not learnt from (a null id counts as
    an empty text). Labels that are null or of no document are passed over; of several for one id the smaller counts, of
    several texts the first in order. Lines end at ``\\n``. Null and empty texts are one empty line. Without labels, or with
    one label only, weights say little and the cut is one half. Repeated rows are scored each. An empty table gives no
    rows. Scores depend on texts and on the ids that were learnt from, not on how rows are dealt. Time is linear in the text.
    """
    sample = stored(_sample(docs, labels, id_col, text_col, label_col, train_rows), "line-quality-sample")
    weights = fit(sample)
    cut = min(max(_sample_cut(sample, weights), 0.001), 0.999)
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.crc32(name.cast("binary")) % 3 == 1).alias("held_out"), F.col(text_col).alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            raw = raw_scores(*line_features([t or "" for t in batch.column(2).to_pylist()]), weights)
            score = np.where(raw < cut, threshold * raw / cut, threshold + (1 - threshold) * (raw - cut) / (1 - cut))
            score = np.clip(score, 0.0, 1.0)
            columns = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, held_out boolean, score double, predicted int")
