"""Ids of words remembered by each Python worker: a text is cut where no token can cross, and each part looked up."""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np

#: Words that a worker remembers at most; then it starts anew, which costs time and changes nothing.
MOST = 500_000


def memory(purpose: str, key: str = "") -> dict:
    """A dictionary that outlives the task; it belongs to the worker process and holds only what can be recomputed.

    There is one for each purpose: another key drops what the last one gathered. All dictionaries of words share one
    purpose, so a worker holds one of them, however many models and files it meets.
    """
    kept = vars(sys.modules.setdefault("_tidemark_worker_memory", types.ModuleType("_tidemark_worker_memory")))
    if kept.get(purpose, ("", {}))[0] != key:
        kept.pop(purpose, None)
    return kept.setdefault(purpose, (key, {}))[1]


def tokenizer_of(path: str):
    """The tokenizers library's tokenizer of a file, loaded once per worker and run in the task's one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    loaded = memory("tokenizer", path)
    if not loaded:
        from tokenizers import Tokenizer

        loaded["it"] = Tokenizer.from_file(path)
    return loaded["it"]


class ByteLevelIds:
    """Ids of a byte-level BPE file, as packed little-endian unsigned 32-bit numbers.

    In this scheme a space belongs to the word after it, so no token holds a character other than white space and then a
    space: a text may be cut before each such space. Unknown parts are encoded together, by the vocabulary's merge ranks,
    and cut apart at their lengths in bytes. Parts with a special token's string go to the tokenizer itself.
    """

    SPLIT = re.compile(r"(?<=\S)(?= )")
    #: White space other than space and newline.
    OTHER = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
    #: The split pattern of byte-level BPE; a fixed value.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        self.known = memory("words", f"byte-level {path}")
        self.tokenizer = tokenizer_of(path)
        own = memory("ranks", path)
        if not own:
            own.update(zip(("ranks", "lengths", "specials"), self._ranks()))
        self.ranks, self.lengths, self.specials = own["ranks"], own["lengths"], own["specials"]

    def _ranks(self):
        import tiktoken

        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shifted = [b for b in range(256) if b not in set(plain)]
        as_byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(shifted)}
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        words = {w: i for w, i in self.tokenizer.get_vocab().items() if w not in specials}
        ranks = {bytes(as_byte[c] for c in w): i for w, i in words.items()}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for word, i in ranks.items():
            lengths[i] = len(word)
        encoding = tiktoken.Encoding("byte-level", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return encoding, lengths, specials

    def _learn(self, units: list[str]) -> None:
        alone = lambda u: u[:1] != " " or not u[1:].strip() or u[1].isspace() or any(s in u for s in self.specials)
        joint = []
        for unit in units:
            if alone(unit):
                ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
                self.known[unit] = np.array(ids, "<u4").tobytes()
            else:
                joint.append(unit)
        if joint:
            ids = np.array(self.ranks.encode_ordinary("".join(joint)), "<u4")
            ends = np.cumsum(self.lengths[ids])
            want = np.cumsum([len(u.encode()) for u in joint])
            cut = np.searchsorted(ends, want)
            if not np.array_equal(ends[cut], want):
                raise ValueError("a token crosses the border between two words")
            packed, at = ids.tobytes(), 0
            for unit, end in zip(joint, ((cut + 1) * 4).tolist()):
                self.known[unit] = packed[at:end]
                at = end

    def units(self, text: str) -> list[str]:
        if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or self.OTHER.search(text):
            return self.SPLIT.split(text)
        first, *rest = text.split(" ")
        return [first, *(" " + w for w in rest)] if first else [" " + w for w in rest]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        cut = [self.units(t) if t else [] for t in texts]
        missing = set()
        for units in cut:
            missing.update(units)
        fresh = [u for u in missing if u not in self.known]
        if len(self.known) + len(fresh) > MOST:
            self.known.clear()
            fresh = list(missing)
        if fresh:
            self._learn(fresh)
        look = self.known.__getitem__
        return [b"".join(map(look, units)) for units in cut]
