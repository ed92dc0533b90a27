"""Near-duplicates by SimHash, found by the generalised pigeonhole principle.

Fingerprints of 64 bits are linked when at most ``limit`` bits differ. The bits are dealt into parts, correlated bits
together; each part i has a threshold t_i of its own, with sum(t_i + 1) = limit + 1. Two fingerprints within the limit
then differ by at most t_i bits in some part i, so it is enough to compare those that meet in a part: each fingerprint is
filed under its part's value and probes all values up to t_i bits away. How many parts there are and which thresholds
they get is decided by dynamic programming on candidate counts, estimated over all fingerprints. Any choice finds every
link; it only changes the work. Within a meeting place only links that join something new are put out, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected, rows_of
from tidemark.llm.shared import slices, stored

SHINGLE = 4
LIMIT = 4
SEED = 42
#: Rows of one meeting place that one task compares; a larger place is cut into blocks, and each two blocks compared.
BLOCK = 20_000
#: Relative costs of filing one row and of comparing one pair.
FILE_COST, PAIR_COST = 1.0, 0.005
#: Each value probed is part of the plan, which costs as much as filing so many rows.
PER_PROBE = 1000
LAGS = 32


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text as a signed integer: a bit is set if it is set in over half of the shingles' hashes."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle, 0)
    ends = ends[min(shingle, len(words)) - 1 :]
    hashed = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, last + 1, 1 << 16):
        pairs = zip(starts[at : min(at + (1 << 16), last + 1)].tolist(), ends[at : at + (1 << 16)].tolist())
        h = np.array([hashed(joined[a:b], SEED) for a, b in pairs], np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > last + 1, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, fp`` of every row; texts without words, null ones included, have fingerprint zero."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [fingerprint(x or b"", shingle) for x in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "text_key", "fp"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, text_key long, fp long")


def _bit_pairs(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many of them each two bits are both set."""

    def work(batches):
        total = np.zeros((64, 64))
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(total.ravel()[cells].astype(np.int64))], ["cell", "n"]
        )

    both = np.zeros(64 * 64)
    for cell, n in prints.select("fp").mapInArrow(work, "cell long, n long").groupBy("cell").sum("n").collect():
        both[cell] = n  # at most 64 x 64 sums
    return prints.count(), both.reshape(64, 64)


def layouts(n: int, both: np.ndarray, most: int) -> list[list[list[int]]]:
    """For each number of parts from 1 to ``most``, the bits of each part: a part grows by the most correlated free bit."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    found = []
    for m in range(1, most + 1):
        free, parts = list(range(64)), []
        for k in range(m):
            width = 64 * (k + 1) // m - 64 * k // m
            part = [max(free, key=lambda b: (spread[b], -b))]
            free.remove(part[0])
            while len(part) < width:
                nearest = max(free, key=lambda b: (corr[b, part].sum(), -b))
                part.append(nearest)
                free.remove(nearest)
            parts.append(sorted(part))
        found.append(parts)
    return found


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near_counts(prints: DataFrame, masks: list[int], limit: int) -> tuple[np.ndarray, int]:
    """For each mask, pairs that differ in 0..limit of its bits; pairs are each fingerprint with the next few stored.

    Fingerprints lie in the order of a hash, so neighbours are random pairs; every fingerprint takes part.
    """

    def work(batches):
        counts, pairs = np.zeros((len(masks), limit + 1), np.int64), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lag in range(1, min(LAGS, len(fps) - 1) + 1):
                differ = fps[lag:] ^ fps[:-lag]
                pairs += len(differ)
                for k, mask in enumerate(masks):
                    near = np.bitwise_count(differ & np.uint64(mask))
                    counts[k] += np.bincount(near, minlength=limit + 1)[: limit + 1]
        cells = np.append(counts.ravel(), pairs)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    rows = prints.select("fp").mapInArrow(work, "cell long, n long").groupBy("cell").sum("n").collect()
    cells = np.zeros(len(masks) * (limit + 1) + 1, np.int64)
    for cell, n in rows:
        cells[cell] = n
    return cells[:-1].reshape(len(masks), limit + 1), int(cells[-1])


def thresholds(n: int, widths: list[int], near: np.ndarray, pairs: int, limit: int) -> tuple[float, list[int]]:
    """The cheapest thresholds with sum(t + 1) = limit + 1, a threshold of -1 leaving a part out, and their cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, counts in zip(widths, near):
        cost = {-1: 0.0}
        for t in range(min(limit, width) + 1):
            filed = (n + PER_PROBE) * sum(comb(width, r) for r in range(t + 1))
            likely = (counts[: t + 1].sum() + 1) / (pairs + 1)
            cost[t] = FILE_COST * filed + PAIR_COST * likely * n * n
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for t, c in cost.items():
                total = used + t + 1
                if total <= limit + 1 and spent + c < step.get(total, (np.inf, []))[0]:
                    step[total] = (spent + c, [*chosen, t])
        best = step
    return best.get(limit + 1, (np.inf, []))


def plan(prints: DataFrame, limit: int = LIMIT) -> list[tuple[int, int, int]]:
    """``(part, mask, probe)`` of the cheapest layout: what a fingerprint is filed under is ``(fp & mask) ^ probe``."""
    n, both = _bit_pairs(prints)
    options = layouts(n, both, limit + 1)
    parts = [part for option in options for part in option]
    near, pairs = _near_counts(prints, [_mask(part) for part in parts], limit)
    choices, at = [], 0
    for option in options:
        widths = [len(part) for part in option]
        choices.append((*thresholds(n, widths, near[at : at + len(option)], pairs, limit), option))
        at += len(option)
    _, chosen, option = min(choices, key=lambda c: c[0])
    keys = []
    for k, (t, bits) in enumerate(zip(chosen, option)):
        for r in range(t + 1):
            keys += [(k, _signed(_mask(bits)), _signed(_mask(flip))) for flip in combinations(bits, r)]
    return keys


def joining_links(fps: np.ndarray, own: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what was apart among rows that met; one of each two must be there by its own value.

    A search through what has not been reached yet: a dense cluster costs one pass, and n rows give n - 1 links at most.
    """
    n = len(fps)
    if n <= 512:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= limit
        near &= own[:, None] | own[None, :]
        np.fill_diagonal(near, False)
        linked = near.any(axis=1)
        if not linked.any():
            return
        fps, own = fps[linked], own[linked]
    apart = np.arange(len(fps))
    while len(apart):
        root, apart, stack = apart[0], apart[1:], [apart[0]]
        while stack and len(apart):
            u = stack.pop()
            hit = np.bitwise_count(fps[apart] ^ fps[u]) <= limit
            if not own[u]:
                hit &= own[apart]
            if hit.any():
                found = apart[hit]
                apart = apart[~hit]
                stack.extend(found.tolist())
                yield np.full(len(found), fps[root]), fps[found]


def links(prints: DataFrame, limit: int = LIMIT, block: int = BLOCK, keys=None) -> DataFrame:
    """Links ``a, b`` between different fingerprints that connect all those within ``limit`` bits of each other."""
    keys = plan(prints, limit) if keys is None else keys
    places = F.array(
        *(
            F.struct(F.lit(k).alias("part"), F.lit(m).cast("long").alias("mask"), F.lit(p).cast("long").alias("probe"))
            for k, m, p in keys
        )
    )
    filed = prints.select("fp", F.explode(places).alias("x")).select(
        F.col("x.part").alias("part"),
        F.col("fp").bitwiseAND(F.col("x.mask")).bitwiseXOR(F.col("x.probe")).alias("value"),
        "fp",
        (F.col("x.probe") == 0).alias("own"),
    )
    large = filed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("met")).filter(F.col("met") > block)
    large = stored(large.withColumn("cuts", F.ceil(F.col("met") * 2 / block).cast("int")), "large-places")
    met = filed.join(large, ["part", "value"], "left")
    mine = F.expr("cast(pmod(xxhash64(fp, part), cuts) as int)")
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("cuts"), F.lit(1)) - 1)).alias("other")
    met = met.withColumn("mine", F.coalesce(mine, F.lit(0))).select("part", "value", "fp", "own", "mine", other)
    met = met.select("part", "value", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "fp", "own")
    where = ["part", "value", "x", "y"]

    def work(batches):
        rest, out = None, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            head = [table.column(c).to_numpy() for c in where]
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in head])) + 1
            bounds = np.concatenate(([0], change))
            rest = table.slice(int(bounds[-1]))
            yield from compared(table, bounds)
        if rest is not None and rest.num_rows:
            yield from compared(rest, np.array([0, rest.num_rows]))

    def compared(table, bounds):
        fps, own = table.column("fp").to_numpy().view(np.uint64), table.column("own").to_numpy()
        left, right = [], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a > 1 and own[a:b].any():
                for x, y in joining_links(fps[a:b], own[a:b], limit):
                    left.append(x)
                    right.append(y)
        if left:
            pair = [pa.array(np.concatenate(side).view(np.int64)) for side in (left, right)]
            yield pa.RecordBatch.from_arrays(pair, ["a", "b"])

    dealt = met.repartition(*where).sortWithinPartitions(*where)
    return dealt.mapInArrow(work, "a long, b long")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, limit: int = LIMIT
) -> DataFrame:
    """One row per document: ``doc_id, text_key, fp, component, component_id``.

    ``component_id`` is the smallest id among all documents that links reach, itself included; nulls are passed over, so
    it is null only if all ids of a component are. Equal fingerprints are one node, so copies cost nothing; texts without
    words are linked to each other. Repeated rows and ids are documents of their own. An empty table gives no rows. Only
    id and text are read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    different = rows.select("fp").distinct().sortWithinPartitions(F.xxhash64("fp"))
    prints = stored(different, "different-fingerprints")
    roots = stored(connected(links(prints, limit)), "components")
    per = rows.groupBy("fp").agg(F.min("doc_id").alias("low")).join(roots, F.col("fp") == F.col("node"), "left")
    per = stored(per.select("fp", "low", F.coalesce("root", "fp").alias("component")), "fingerprint-components")
    lows = per.groupBy("component").agg(F.min("low").alias("component_id"))
    return rows.join(per.select("fp", "component").join(lows, "component"), "fp").select(
        "doc_id", "text_key", "fp", "component", "component_id"
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document of smallest id of each group, in its own columns; a null id is chosen only if there is no other."""
    groups = near_groups(docs, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    stay = groups.groupBy("component").agg(first).select(
        F.col("first.doc_id").alias("stay_id"), F.col("first.text_key").alias("stay_key")
    )
    return rows_of(docs, stay, id_col, F.xxhash64(text_col))
