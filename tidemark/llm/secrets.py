"""Secret scans: keywords by Aho-Corasick, anchored expressions only at their hits, then checksums that secrets carry.

One automaton runs over a text twice: over the text in lower case for keywords, and over its characters' classes, in which
sixteen hexadecimal digits in a row are a keyword too. An expression is tried only where a keyword begins. Formats with a
checksum of their own (the last six characters are the CRC-32 of the rest in base 62) count only if it is right.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import slices

ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
CHECKED = re.compile(rb"((?:gh[pousr]|npm)_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
#: Least lengths: of the value assigned, of an access key, of a run of hexadecimal digits.
ASSIGNED, ACCESS_KEY, RUN = 12, 18, 16
KINDS = ("assign", "access", "hex", "checked")
#: Keywords and the kinds of expression they start; fixed values.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
}
DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX_CLASS = bytes(104 if chr(b) in "0123456789abcdef" else 46 for b in range(256))


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def checksum(body: bytes) -> bytes:
    """CRC-32 in six digits of base 62."""
    n, out = zlib.crc32(body), b""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = DIGITS[digit : digit + 1] + out
    return out


def _hex_runs(data: bytes) -> Iterator[tuple[int, int]]:
    """Runs of hexadecimal digits, sought as one keyword in the text's classes and measured at the hit."""
    classes, key, at = data.translate(_HEX_CLASS), b"h" * RUN, 0
    while (at := classes.find(key, at)) >= 0:
        end = HEX.match(data, at).end()
        yield at, end
        at = end


def spans(data: bytes, words) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in bytes of a UTF-8 text, by start and then by kind."""
    found = [(a, b, "hex") for a, b in _hex_runs(data)]
    past = dict.fromkeys(KEYWORDS, 0)
    hits = [(end - length + 1, kind) for end, (kind, length) in words.iter(data.lower().decode("latin-1"))]
    for at, kind in sorted(hits):
        if at < past[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(data, at):
                past[kind] = m.end()
                if m.end(2) - m.start(2) >= ASSIGNED:
                    found.append((at, m.end(), kind))
        elif kind == "access":
            if m := ACCESS.match(data, at):
                past[kind] = m.end()
                if m.end() - at >= ACCESS_KEY:
                    found.append((at, m.end(), kind))
        elif m := CHECKED.match(data, at):
            if checksum(m[2]) == m[3]:
                past[kind] = m.end()
                found.append((at, m.end(), kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def code_points(data: bytes, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The same spans in code points; secrets are ASCII, so their lengths stay."""
    if not found or data.isascii():
        return found
    out, at, chars = [], 0, 0
    for a, b, kind in found:
        chars += len(data[at:a].decode("utf-8", "replace"))
        at = a
        out.append((chars, chars + b - a, kind))
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, n_checked, base_sha256, spans``.

    Of each kind the leftmost matches that do not overlap; kinds may overlap each other. ``spans`` is an array of
    ``kind, start, end`` in code points, end exclusive, by start and then kind; ``base_sha256`` is over the first three
    kinds. A null text is empty. Repeated rows are scanned each. An empty table gives no rows. Whole texts are scanned,
    a few megabytes of a batch at a time.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in slices(batches, "text"):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            found = [code_points(t, spans(t, words)) for t in texts]
            counts = [pa.array([sum(s[2] == k for s in own) for own in found], pa.int64()) for k in KINDS]
            base = [",".join(f"{k}:{a}:{b}" for a, b, k in own if k in KINDS[:3]) for own in found]
            digests = pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base])
            listed = pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in own] for own in found], span)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, digests, listed],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(
        work, f"doc_id {kind}, {counts}, base_sha256 string, spans array<struct<kind string, start long, end long>>"
    )
