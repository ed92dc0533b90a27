"""Token counts of whole texts, huge ones by overlap resynchronisation.

Tokens of the counted vocabulary never hold white space, so words separated by ASCII white space are encoded on their own
and remembered by each worker. A huge text is encoded in overlapping chunks with offsets. Two neighbours are spliced at a
boundary that is proven stable: an ASCII white-space character in the overlap from which on both chunks hold the same
tokens at the same offsets up to a further one. If there is none, the overlap is widened, and a chunk that is nothing but
one word is lengthened, until there is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices
from tidemark.llm.word_memory import MOST, memory, tokenizer_of

#: Characters of a chunk, and of the overlap of two chunks to begin with.
CHUNK, OVERLAP = 32_768, 256
LIMIT = 2048
SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")


class WordCounter:
    """Numbers of tokens of texts under a tokenizers file whose pre-tokenizer drops white space."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer, self.known = tokenizer_of(path), memory("words", f"counts {path}")
        self.chunk, self.overlap = chunk, overlap
        own = memory("word lengths", path)
        if not own:
            added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
            lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
            for word, i in self.tokenizer.get_vocab().items():
                lengths[i] = len(added[i].encode()) if i in added else len(word.removesuffix("</w>"))
            own.update(lengths=lengths, specials=list(added.values()))
        self.lengths, self.specials = own["lengths"], own["specials"]

    def _learn(self, words: list[bytes]) -> None:
        """Encode unknown words as one text and cut its ids at the words' lengths; odd words are encoded alone."""
        joint = [w for w in words if w.isascii() and b"<|" not in w]
        rest = [w for w in words if not (w.isascii() and b"<|" not in w)]
        if joint:
            ids = self.tokenizer.encode_batch_fast([b" ".join(joint).decode()], add_special_tokens=False)[0].ids
            ends = np.cumsum(self.lengths[ids])
            want = np.cumsum([len(w) for w in joint])
            cut = np.searchsorted(ends, want)
            if len(ends) and ends[-1] == want[-1] and np.array_equal(ends[cut], want):
                self.known.update(zip(joint, np.diff(cut, prepend=-1).tolist()))
            else:
                rest += joint
        if rest:
            texts = [w.decode("utf-8", "replace") for w in rest]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            self.known.update(zip(rest, map(len, found)))

    def counts(self, texts: list[bytes]) -> list[int]:
        short = [t.split() if len(t) <= self.chunk else None for t in texts]
        fresh = {w for words in short if words for w in words}
        missing = [w for w in fresh if w not in self.known]
        if len(self.known) + len(missing) > MOST:
            self.known.clear()
            missing = list(fresh)
        if missing:
            self._learn(missing)
        look = self.known.__getitem__
        return [
            sum(map(look, words)) if words is not None else self.huge(text.decode("utf-8", "replace"))
            for words, text in zip(short, texts)
        ]

    def _encoded(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and absolute starts of the tokens of a chunk."""
        found = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        return np.array(found.ids, np.int64), np.array([o[0] for o in found.offsets], np.int64) + start

    def huge(self, text: str) -> int:
        """Tokens of a text of any length, never encoding more of it at once than a chunk, or its longest word."""
        total, begin, chunk = 0, 0, self.chunk
        ids, starts = self._encoded(text, 0, chunk)
        end = min(chunk, len(text))
        while end < len(text):
            overlap, spliced = min(self.overlap, self.chunk // 2), None
            while spliced is None:
                at = max(end - overlap, begin)
                right_end = min(at + max(chunk, 2 * overlap), len(text))
                right = self._encoded(text, at, right_end)
                spliced = self._stable(text, at, end, (ids, starts), right)
                if spliced is None and at == begin:
                    break
                overlap *= 2
            if spliced is None:  # no stable boundary in the whole chunk: encode it anew, twice as long
                chunk = 2 * (end - begin)
                end = min(begin + chunk, len(text))
                ids, starts = self._encoded(text, begin, end)
                continue
            total += int(np.count_nonzero(starts < spliced))
            keep = right[1] >= spliced
            ids, starts, begin, end, chunk = right[0][keep], right[1][keep], spliced, right_end, self.chunk
        return total + len(ids)

    @staticmethod
    def _stable(text: str, at: int, end: int, left, right) -> int | None:
        """The first white space of the overlap after which both sides agree up to the next; they must share a word."""
        spaces = [m.start() for m in SPACE.finditer(text, at, end)]
        for a, b in zip(spaces, spaces[1:]):
            mine = (left[1] >= a) & (left[1] < b)
            theirs = (right[1] >= a) & (right[1] < b)
            same = np.array_equal(left[0][mine], right[0][theirs]) and np.array_equal(left[1][mine], right[1][theirs])
            if same and mine.any():
                return a
        return None


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    Counts are those of the tokenizers library without special tokens added; special strings inside a text are its
    default's. A null text is empty and has none. Repeated rows are counted each. An empty table gives no rows. Only id
    and text are read. ``tokenizer`` is a file that every executor has.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(tokenizer, chunk, overlap)
        for batch in slices(batches, "text", 2 << 20):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            found = counter.counts(texts)
            columns = [
                batch.column(0),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(found, pa.int64()),
                pa.array([n > limit for n in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
