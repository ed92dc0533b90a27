"""Packing of token ids into sequences by Karmarkar-Karp multiway differencing.

Whole windows are cut off a document and stand alone. What is left over is cut into pieces and pooled; a pool is a fixed
number of windows' worth of tokens. It is dealt out by differencing: each piece starts as a partial partition, the two of
largest imbalance are merged again and again so that the fullest window of one meets the emptiest of the other, and
near-equal windows come out. If one exceeds the capacity, the pool is dealt to one window more. A task holds one pool at
a time and no rows are moved between tasks.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices
from tidemark.llm.word_memory import ByteLevelIds

CAPACITY = 2048
PIECE = 512
WINDOWS = 64
#: Tokens per window that a pool leaves free, so that near-equal windows stay below the capacity.
FREE = 8
END_ID = 1


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal items to ``windows`` near-equal windows; gives the item numbers of each."""
    heap = []
    for n, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-size, n, sums, {0: [n]}))
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)  # sums fall from left to right
        _, _, b, b_items = heapq.heappop(heap)
        merged = a + b[::-1]
        order = np.argsort(-merged, kind="stable")
        place = np.empty(windows, np.int64)
        place[order] = np.arange(windows)
        items: dict[int, list[int]] = {}
        for at, own in a_items.items():
            items.setdefault(int(place[at]), []).extend(own)
        for at, own in b_items.items():
            items.setdefault(int(place[windows - 1 - at]), []).extend(own)
        sums = merged[order]
        count += 1
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), count, sums, items))
    return [own for _, own in sorted(heap[0][3].items())] if heap else []


def windows_of(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows none of which exceeds the capacity; their number rises until that holds."""
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = differencing(sizes, count)
        if all(sum(sizes[n] for n in own) <= capacity for own in dealt):
            return dealt
        count += 1


class Packer:
    """Packs the documents of one task; ``rows`` holds finished pieces until they are taken."""

    def __init__(self, first_sequence: int, capacity=CAPACITY, piece=PIECE, windows=WINDOWS, free=FREE):
        self.sequence, self.capacity, self.piece = first_sequence, capacity, min(piece, capacity)
        self.room = max(capacity, windows * (capacity - free))
        self.pool, self.pooled, self.rows = [], 0, []

    def add(self, doc_id, ids: bytes) -> None:
        tokens, at = len(ids) // 4, 0
        while tokens - at >= self.capacity:
            self.rows.append((doc_id, at, self.capacity, zlib.crc32(ids[at * 4 : (at + self.capacity) * 4]), tokens, self.sequence, 0))
            self.sequence += 1
            at += self.capacity
        while at < tokens:
            length = min(self.piece, tokens - at, self.room - self.pooled)
            self.pool.append((doc_id, at, length, zlib.crc32(ids[at * 4 : (at + length) * 4]), tokens))
            self.pooled += length
            at += length
            if self.pooled == self.room:
                self.flush()

    def flush(self) -> None:
        for own in windows_of([p[2] for p in self.pool], self.capacity) if self.pool else []:
            offset = 0
            for n in own:
                self.rows.append((*self.pool[n], self.sequence, offset))
                offset += self.pool[n][2]
            self.sequence += 1
        self.pool, self.pooled = [], 0

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    piece: int = PIECE,
    windows: int = WINDOWS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids and then ``end_id``, so a null or empty text is one token. Every id lies in exactly one piece;
    pieces of a sequence follow each other without gaps and hold ``capacity`` tokens at most. ``sequence_id`` names the
    task's partition and a number within it. Repeated rows and ids are documents of their own. ``tokenizer`` is the path
    of a byte-level BPE file of the tokenizers library, found on every executor. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ByteLevelIds(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, piece, windows)

        def out(kind):
            columns = list(zip(*packer.taken())) or [[]] * len(names)
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, names)

        kind = None
        for batch in slices(batches, "text", 2 << 20):
            kind = batch.column(0).type
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, packed in zip(batch.column(0).to_pylist(), ids.encode(texts)):
                packer.add(doc_id, packed + end)
            yield out(kind)
        packer.flush()
        if kind is not None:
            yield out(kind)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, " + ", ".join(f"`{n}` long" for n in names[1:]))
