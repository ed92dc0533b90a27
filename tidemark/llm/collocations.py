"""Phrases that occur together more often than their parts, mined from an FM-index per shard over word ids.

Texts are dealt into shards of whole texts. The words of a shard that are frequent over all shards become symbols, all
else is a border; the Burrows-Wheeler transforms of the symbols and of their reverse, both sorted by as many symbols as
phrases need, make a bidirectional index. A phrase is an interval in either; its extensions by one word to the right or
to the left are the symbols that the transform holds in the interval, with their counts. Phrases grow one word a round,
to the right and to the left by turns. A shard extends phrases that are frequent over all shards, and puts out extensions
whose other end is frequent as well; the counts are summed across shards, and what stays frequent goes back to its shards.
A phrase is named by the numbers of its two parts that lack the last and the first word, so counts of beginnings and ends
and one-word extensions on either side are known without reading texts again.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, stored
from tidemark.sources.scratch import new_folder

LEAST, LONGEST, TOP = 100, 5, 2000
#: Words of a shard, whose index one task holds: texts are added until it has as many.
SHARD = 1_500_000
#: A quarter of the shards' frequent phrases that may be sent whole to every task; more are shuffled to their shards.
FEW = 500_000
#: Phrases of all shards that a group of a sum holds on average at most, and eight times its words: these take more room.
SHARE = 3_000_000
#: Marks the border of a piece; this byte is in no UTF-8 text.
BORDER = b"\xff"
#: Characters that end a piece become line feeds.
PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unpacked(data: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd"), kind) if n else np.zeros(0, kind)


def _pieces(docs: DataFrame, text_col: str, lang_col: str, shard: int) -> DataFrame:
    """``piece, lang, n, length, ids, words, counts``: local numbers of a task's words, 0 for borders, and its words.

    A task hands on the words of a language once there is a shard of them, and what is left at its end.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def fresh():
            words = defaultdict()
            words.default_factory = words.__len__
            words[BORDER]
            return words, []

        open_, held = defaultdict(fresh), Counter()

        def out(lang: str) -> pa.RecordBatch:
            nonlocal number
            words, parts = open_.pop(lang)
            held.pop(lang)
            ids = np.concatenate(parts)
            counts = np.bincount(ids, minlength=len(words))
            number += 1
            names = [w.decode("utf-8", "replace") for w in words if w != BORDER]
            columns = [
                pa.array([number], pa.int64()), pa.array([lang], pa.string()), pa.array([int(counts[1:].sum())], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([_packed(ids)], pa.binary()),
                pa.array([names], pa.list_(pa.string())), pa.array([counts[1:]], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["piece", "lang", "n", "length", "ids", "words", "counts"])

        for batch in slices(batches, "text", 2 << 20):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if text:
                    words, parts = open_[lang]
                    found = text.lower().translate(PIECES).replace(b"\n", b" \xff ").split()
                    found.append(BORDER)
                    parts.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
                    held[lang] += len(found)
                    if held[lang] >= shard or held.total() >= 2 * shard:
                        yield out(max(held, key=held.get))
        for name in list(open_):
            yield out(name)

    kind = "piece long, lang string, n long, length long, ids binary, words array<string>, counts array<long>"
    return rows.mapInArrow(work, kind)


def _shards(pieces: DataFrame, shard: int) -> DataFrame:
    """``piece, shard``: pieces of a language put together until a shard has its words. There are few pieces per task."""
    before = Window.partitionBy("lang").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / shard)
    placed = pieces.select("piece", "lang", place.alias("place"))
    return placed.select("piece", F.min("piece").over(Window.partitionBy("lang", "place")).alias("shard"))


def transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before each place, places sorted by their next ``depth`` symbols (at least); it goes round at the end."""
    key, known = symbols.astype(np.int64), 1
    while known < depth:
        size = int(key.max(initial=0)) + 1
        if size >= 1 << 31:
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max(initial=0)) + 1
        after = np.roll(key, -known)
        key *= size
        key += after
        known *= 2
    order = np.argsort(key, kind="stable")
    del key
    return symbols[order - 1]


def extended(bwt: np.ndarray, at: np.ndarray, size: np.ndarray, other: np.ndarray, symbols: int):
    """One more word before each phrase, for all phrases at once: ``phrase, symbol, at, other, size`` of what occurs.

    ``at`` is where the phrases' intervals begin in the index of ``bwt``, ``other`` in the index of the reverse; a border
    is no word. The same on the transform of the reverse adds a word behind.
    """
    place = np.empty(len(bwt), np.int32)
    place[np.argsort(bwt, kind="stable")] = np.arange(len(bwt), dtype=np.int32)
    begin = np.cumsum(size) - size
    where = np.repeat((at - begin).astype(np.int32), size)
    where += np.arange(len(where), dtype=np.int32)
    key = np.repeat(np.arange(len(at)) * (symbols + 1), size)
    key += bwt[where]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    phrase, symbol = np.divmod(key[first], symbols + 1)
    new_at, new_other = place[where[order[first]]], other[phrase] + first - begin[phrase]
    word = symbol > 0
    return phrase[word], symbol[word], new_at[word], new_other[word], count[word]


def inside(at: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of some disjoint intervals each place lies in, or -1."""
    if not len(begin):
        return np.full(len(at), -1)
    order = np.argsort(begin)
    k = np.searchsorted(begin[order], at, side="right") - 1
    found = order[np.maximum(k, 0)]
    return np.where((k >= 0) & (at < begin[found] + size[found]), found, -1)


#: Phrases alive in a shard and where their intervals begin, in packed pieces of ``n`` phrases each.
_FIELDS = ("id", "lo", "rlo", "size")
_PACKED = "struct<n: long, id: binary, lo: binary, rlo: binary, size: binary>"


def _pack(columns: list[np.ndarray]) -> pa.StructArray:
    arrays = [pa.array([_packed(c.astype(np.int64))], pa.binary()) for c in columns]
    return pa.StructArray.from_arrays([pa.array([len(columns[0])], pa.int64()), *arrays], ["n", *_FIELDS])


def _unpack(packed: pa.StructArray) -> list[np.ndarray]:
    sizes = packed.field("n").to_pylist()
    return [
        np.concatenate([np.zeros(0, np.int64), *(_unpacked(p, n, np.int64) for p, n in zip(packed.field(f).to_pylist(), sizes))])
        for f in _FIELDS
    ]


def _known(pieces: DataFrame, shard_of: DataFrame, least: int, parts: int) -> DataFrame:
    """``lang, word, f, id`` of frequent words, and ``shard, piece, n, at, ids`` of where pieces hold them, packed.

    Words meet by a hash in one of ``parts`` groups; a piece sends each of its words once, in one row per group.
    """
    rows = pieces.select("piece", "lang", "words", "counts").join(F.broadcast(shard_of), "piece")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                piece, lang, words, counts, shard = (batch.column(c).slice(k, 1) for c in range(5))
                words, counts = words.flatten(), counts.flatten()
                part = np.fromiter((crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words)) % parts
                order = np.argsort(part, kind="stable")
                ends = pa.array(np.searchsorted(part[order], np.arange(parts + 1)), pa.int32())
                same = pa.array(np.zeros(parts, np.int64))
                columns = [pa.array(np.arange(parts)), *(c.take(same) for c in (shard, piece, lang))]
                columns += [pa.ListArray.from_arrays(ends, c.take(pa.array(order))) for c in (words, counts)]
                columns.append(pa.ListArray.from_arrays(ends, pa.array(order)))
                yield pa.RecordBatch.from_arrays(columns, ["part", "shard", "piece", "lang", "words", "counts", "at"])

    kind = "part long, shard long, piece long, lang string, words array<string>, counts array<long>, at array<long>"
    dealt = rows.mapInArrow(deal, kind)

    def work(table: pa.Table) -> pa.Table:
        own, taken, out = table.column("part")[0].as_py(), 0, []
        langs = np.array(table.column("lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            some = table.take(np.flatnonzero(langs == lang))
            words, counts, at = (pc.list_flatten(some.column(c)) for c in ("words", "counts", "at"))
            coded = words.cast(pa.large_string()).combine_chunks().dictionary_encode()
            codes, at = coded.indices.to_numpy(), at.to_numpy()
            sums = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(sums, codes, counts.to_numpy())
            often = np.flatnonzero(sums >= least)
            ids = np.full(len(sums), -1)
            ids[often] = (taken + np.arange(len(often))) * parts + own
            taken += len(often)
            names = coded.dictionary.take(pa.array(often)).cast(pa.string())
            out.append(_filled({"lang": [lang] * len(often), "word": names, "f": sums[often], "id": ids[often]}, len(often)))
            ends = np.cumsum(pc.list_value_length(some.column("words")).to_numpy())
            packs = defaultdict(list)
            for shard, piece, begin, end in zip(*(some.column(c).to_pylist() for c in ("shard", "piece")), [0, *ends[:-1]], ends):
                mine = ids[codes[begin:end]]
                hit = mine >= 0
                if hit.any():
                    for c, value in zip(("shard", "piece", "n"), (shard, piece, int(hit.sum()))):
                        packs[c].append(value)
                    packs["at"].append(_packed(at[begin:end][hit]))
                    packs["ids"].append(_packed(mine[hit]))
            out.append(_filled(packs, len(packs["n"])))
        return pa.concat_tables(out)

    kind = "lang string, word string, f long, id long, shard long, piece long, n long, at binary, ids binary"
    return dealt.groupBy("part").applyInArrow(work, kind)


_KNOWN_TYPES = pa.schema(
    [
        ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64()), ("id", pa.int64()), ("shard", pa.int64()),
        ("piece", pa.int64()), ("n", pa.int64()), ("at", pa.binary()), ("ids", pa.binary()),
    ]
)


def _filled(columns: dict, rows: int, kind: pa.Schema = _KNOWN_TYPES) -> pa.Table:
    """Some columns of ``kind``; the others are null."""
    given = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in kind]
    return pa.Table.from_arrays(given, schema=kind)


def _indexed(pieces: DataFrame, shard_of: DataFrame, known: DataFrame, longest: int) -> DataFrame:
    """``shard, length, symbols, forward, backward, alive`` of every shard that has a frequent word.

    ``alive`` has a shard's frequent words with their intervals, which are the same in both directions.
    """
    # Both sides of the cogroup need columns of their own.
    known = known.select(*(F.col(c).alias(c) for c in ("shard", "piece", "n", "at", "ids")))
    texts = pieces.select("piece", "length", "ids").join(F.broadcast(shard_of), "piece")

    def work(key, texts: pa.Table, known: pa.Table) -> pa.Table:
        kind = _INDEX_TYPES
        if not known.num_rows:
            return kind.empty_table()
        sizes = known.column("n").to_pylist()
        of_piece = np.repeat(known.column("piece").to_numpy(), sizes)
        at, ids = (
            np.concatenate([_unpacked(p, n, np.int64) for p, n in zip(known.column(c).to_pylist(), sizes)]) for c in ("at", "ids")
        )
        symbols = np.unique(ids)
        parts = [np.zeros(1, np.int32)]
        for piece, length, data in sorted(zip(*(texts.column(c).to_pylist() for c in ("piece", "length", "ids")))):
            mine = of_piece == piece
            names = np.zeros(int(at[mine].max(initial=-1)) + 2, np.int32)
            names[at[mine] + 1] = np.searchsorted(symbols, ids[mine]) + 1
            text = _unpacked(data, length, np.int32)
            parts += [np.where(text < len(names), names[np.minimum(text, len(names) - 1)], 0).astype(np.int32), np.zeros(1, np.int32)]
        text = np.concatenate(parts)
        text = text[(text > 0) | np.concatenate(([True], text[:-1] > 0))]
        counts = np.bincount(text, minlength=len(symbols) + 1)
        begin = (np.cumsum(counts) - counts)[1:]
        packed = _pack([symbols, begin, begin, counts[1:]])
        columns = [
            pa.array([key[0].as_py()], pa.int64()), pa.array([len(text)], pa.int64()), pa.array([len(symbols)], pa.int64()),
            pa.array([_packed(transform(text, longest - 1))], pa.binary()),
            pa.array([_packed(transform(text[::-1], longest - 1))], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, 1], pa.int32()), packed),
        ]
        return pa.Table.from_arrays(columns, schema=kind)

    grouped = texts.groupBy("shard").cogroup(known.groupBy("shard"))
    kind = f"shard long, length long, symbols long, forward binary, backward binary, alive array<{_PACKED}>"
    return grouped.applyInArrow(work, kind)


_INDEX_TYPES = pa.schema(
    [
        ("shard", pa.int64()), ("length", pa.int64()), ("symbols", pa.int64()), ("forward", pa.binary()), ("backward", pa.binary()),
        ("alive", pa.list_(pa.struct([("n", pa.int64()), *((f, pa.binary()) for f in _FIELDS)]))),
    ]
)


def thin(head: np.ndarray, tail: np.ndarray, size: np.ndarray) -> bytes:
    """Phrases in order of head and tail, packed: steps from one to the next, byte by byte of their places."""
    fresh = np.concatenate(([True], head[1:] != head[:-1]))
    steps = [np.diff(head, prepend=0), np.where(fresh, tail, np.diff(tail, prepend=0)), size]
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T) for c in steps]
    return pa.compress(b"".join(p.tobytes() for p in planes), codec="zstd", asbytes=True)


def thick(data: bytes, n: int) -> list[np.ndarray]:
    """Head, tail and size of ``n`` phrases from :func:`thin`."""
    planes = np.frombuffer(pa.decompress(data, 24 * n, codec="zstd", asbytes=True), np.uint8).reshape(3, 8, n)
    head, tail, size = (np.ascontiguousarray(p.T).view("<i8").reshape(n) for p in planes)
    head = np.cumsum(head)
    first = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
    run = np.cumsum(tail)
    run -= np.repeat(run[first] - tail[first], np.diff(np.append(first, n)))
    return [head, run, size]


def part_of(head: np.ndarray, tail: np.ndarray, parts: int) -> np.ndarray:
    """Which group sums a phrase. The tails of a very common head are dealt over the groups in blocks of neighbours."""
    mixed = head.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed += (tail.astype(np.uint64) >> np.uint64(8)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _summed(counts: DataFrame, least: int, parts: int) -> DataFrame:
    """``head, tail, f, id`` of phrases that occur ``least`` times over all shards, from ``part, shard, n, data``.

    And for each row of ``counts`` that has any of them ``shard, part, n, at, ids``: which they are in it, packed.
    """

    def work(table: pa.Table) -> pa.Table:
        part, sizes = table.column("part")[0].as_py(), table.column("n").to_pylist()
        each = [thick(d, n) for d, n in zip(table.column("data").to_pylist(), sizes)]
        head, tail, size = (np.concatenate([e[c] for e in each]) for c in range(3))
        del each
        order = np.lexsort((tail, head))
        head, tail, size = head[order], tail[order], size[order]
        fresh = np.concatenate(([True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])))
        first = np.flatnonzero(fresh)
        f = np.add.reduceat(size, first)
        often = f >= least
        ids = np.where(often, (np.cumsum(often) - 1) * parts + part, -1)
        found = first[often]
        sums = _filled({"head": head[found], "tail": tail[found], "f": f[often], "id": ids[often]}, len(found), _SUMMED_TYPES)
        given = np.empty(len(order), np.int64)
        given[order] = ids[np.cumsum(fresh) - 1]
        answers, begin = defaultdict(list), 0
        for shard, n in zip(table.column("shard").to_pylist(), sizes):
            mine = given[begin : begin + n]
            at = np.flatnonzero(mine >= 0)
            begin += n
            if len(at):
                row = (shard, part, len(at), _packed(np.diff(at, prepend=0)), _packed(np.diff(mine[at], prepend=0)))
                for c, value in zip(("shard", "part", "n", "at", "ids"), row):
                    answers[c].append(value)
        return pa.concat_tables([sums, _filled(answers, len(answers["n"]), _SUMMED_TYPES)])

    kind = "head long, tail long, f long, id long, shard long, part long, n long, at binary, ids binary"
    return counts.groupBy("part").applyInArrow(work, kind)


_SUMMED_TYPES = pa.schema(
    [
        ("head", pa.int64()), ("tail", pa.int64()), ("f", pa.int64()), ("id", pa.int64()), ("shard", pa.int64()),
        ("part", pa.int64()), ("n", pa.int64()), ("at", pa.binary()), ("ids", pa.binary()),
    ]
)


def _longer(index: DataFrame, right: bool, parts: int, answers: DataFrame | None = None) -> DataFrame:
    """``part, shard, n, data``: a shard's phrases of one word more, head and tail both being alive there, with their sizes.

    They are packed for the groups that sum them. With ``answers`` of those groups ``shard, alive``: the frequent ones among
    them with their ids and intervals. They are made again for that, as keeping all of them takes much room.
    """
    names = ["shard", "length", "symbols", F.col("backward" if right else "forward").alias("data"), "alive"]
    if answers is not None:
        index = index.join(answers, "shard")
        names.append("answers")

    def found(batch: pa.RecordBatch, k: int) -> tuple[int, list[np.ndarray], np.ndarray, np.ndarray]:
        shard, length, symbols, data = (batch.column(c)[k].as_py() for c in range(4))
        ids, lo, rlo, size = _unpack(batch.column(4)[k].values)
        at, other = (rlo, lo) if right else (lo, rlo)
        phrase, _, new_at, new_other, count = extended(_unpacked(data, length, np.int32), at, size, other, symbols)
        met = inside(new_at, at, size)
        keep = met >= 0
        own, beyond = ids[phrase[keep]], ids[met[keep]]
        head, tail = (own, beyond) if right else (beyond, own)
        starts = (new_other[keep], new_at[keep]) if right else (new_at[keep], new_other[keep])
        part = part_of(head, tail, parts)
        order = np.lexsort((tail, head, part))
        return shard, [c[order] for c in (head, tail, count[keep], *starts)], np.searchsorted(part[order], np.arange(parts + 1))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, columns, ends = found(batch, k)
                sizes = np.diff(ends)
                own = np.flatnonzero(sizes)
                data = [thin(*(c[ends[p] : ends[p + 1]] for c in columns[:3])) for p in own]
                arrays = [pa.array(own), pa.array(np.full(len(own), shard)), pa.array(sizes[own]), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "shard", "n", "data"])
                pa.default_memory_pool().release_unused()

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, columns, ends = found(batch, k)
                hits, ids = [], []
                for a in sorted(batch.column(5)[k].as_py(), key=lambda a: a["part"]):
                    hits.append(ends[a["part"]] + np.cumsum(_unpacked(a["at"], a["n"], np.int64)))
                    ids.append(np.cumsum(_unpacked(a["ids"], a["n"], np.int64)))
                hit = np.concatenate(hits)
                size, lo, rlo = (c[hit] for c in columns[2:])
                alive = pa.ListArray.from_arrays(pa.array([0, 1], pa.int32()), _pack([np.concatenate(ids), lo, rlo, size]))
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), alive], ["shard", "alive"])
                pa.default_memory_pool().release_unused()

    if answers is None:
        return index.select(*names).mapInArrow(counted, "part long, shard long, n long, data binary")
    return index.select(*names).mapInArrow(kept, f"shard long, alive array<{_PACKED}>")


def _bucketed(index: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """``index`` written once in buckets by shard, so that what is joined to it moves and it does not; and its table's name."""
    name = f"word_indexes_{uuid4().hex}"
    path = new_folder(index.sparkSession, "word-indexes")
    index.write.bucketBy(buckets, "shard").option("path", path).saveAsTable(name, format="parquet")
    return index.sparkSession.table(name), name


def phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    shard: int = SHARD,
    few: int = FEW,
    share: int = SHARE,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that occur ``least`` times in a language, and ``lang, n`` words in all.

    Phrases are ``id, lang, words, f, heads, tails, head, tail``: ``heads`` has the counts of the first 1, 2, ... words,
    ``tails`` of the last, up to the whole; ``head`` and ``tail`` are the ids of the phrase without its last and first word.
    """
    pieces = stored(_pieces(docs, text_col, lang_col, shard), "pieces")
    totals = pieces.groupBy("lang").agg(F.sum("n").alias("n"))
    shard_of = stored(_shards(pieces, shard), "shards")
    # A shard has no more different phrases than words, which bounds what a group of a sum holds.
    size = pieces.agg(F.sum(F.size("words")).alias("words"), F.sum("n").alias("n")).first()
    known = stored(_known(pieces, shard_of, least, 1 + 8 * (size.words or 0) // share), "frequent-words")
    often = known.filter("word is not null").select("lang", "word", "f", "id")
    parts = 1 + (size.n or 0) // share
    index, table = _bucketed(_indexed(pieces, shard_of, known.filter("word is null"), longest), parts)
    try:
        found = [*_levels(index, often, least, longest, few, parts)]
    finally:
        docs.sparkSession.sql(f"DROP TABLE {table}")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out, totals


def _levels(index: DataFrame, often: DataFrame, least: int, longest: int, few: int, parts: int) -> Iterator[DataFrame]:
    """The frequent phrases of one word, two words and so on, each kept in the shared folder."""
    none = F.lit(None).cast("long")
    level = often.select("id", "lang", F.array("word").alias("words"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"), none.alias("head"), none.alias("tail"))
    yield level
    alive = index
    for words in range(2, longest + 1):
        right = words % 2 == 0
        summed = stored(_summed(_longer(alive, right, parts), least, parts), f"frequent-phrases-of-{words}")
        sums = summed.filter("head is not null").select("head", "tail", "f", "id")
        if sums.isEmpty():
            return
        first = level.select(F.col("id").alias("head"), "lang", "words", "heads")
        last = level.select(F.col("id").alias("tail"), F.element_at("words", -1).alias("word"), "tails")
        whole = F.array("f")
        level = sums.join(first, "head").join(last, "tail").select(
            "id", "lang", F.concat("words", F.array("word")).alias("words"), "f",
            F.concat("heads", whole).alias("heads"), F.concat("tails", whole).alias("tails"), "head", "tail",
        )
        level = stored(level, f"phrases-of-{words}-named")
        yield level
        if words < longest:
            # Dealt as the index is, so that it stays where it is.
            answers = summed.filter("head is null").select("shard", F.struct("part", "n", "at", "ids").alias("answer"))
            answers = answers.repartition(parts, "shard").groupBy("shard").agg(F.collect_list("answer").alias("answers"))
            kept = stored(_longer(alive, right, parts, answers), f"alive-phrases-of-{words}")
            held = kept.select(F.explode("alive.n").alias("n")).agg(F.sum("n")).first()[0] or 0
            kept = F.broadcast(kept) if held <= 4 * few else kept.repartition(parts, "shard")
            alive = index.drop("alive").join(kept, "shard")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    shard: int = SHARD,
    few: int = FEW,
    share: int = SHARE,
) -> DataFrame:
    """The first ``top`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased in A-Z only, cut into pieces at ``. , ; : ! ?`` and line ends, and into words at spaces and tabs. A
    candidate is a phrase of 2 to ``longest`` words within a piece that occurs ``least`` times (``a``) in its language; a
    null language is ``und``. Cut into two, its parts occur ``l`` and ``r`` times; ``score`` is the lowest of floor(1000 a n /
    (l r)) over all cuts, ties to the shortest first part, where ``n`` counts all words. A candidate goes if one that is
    longer holds it and occurs as often. Order: score, then ``a``, falling, then the phrase in bytes. Null and empty texts
    have no words. Repeated rows count each. An empty table gives no rows. Only text and language are read.
    """
    every, totals = phrases(docs, text_col, lang_col, least, longest, shard, few, share)
    longer = every.filter(F.size("words") > 2)
    whole = F.element_at("heads", -1)
    size = F.size("words")  # an id is unique among phrases of its size
    gone = longer.filter(whole == F.element_at("heads", -2)).select(F.col("head").alias("id"), (size - 1).alias("size"))
    ends = longer.filter(whole == F.element_at("tails", -2)).select(F.col("tail").alias("id"), (size - 1).alias("size"))
    gone = gone.unionByName(ends).distinct()
    stay = every.withColumn("size", size).filter("size > 1").join(gone, ["id", "size"], "left_anti")
    cuts = F.expr(
        """transform(sequence(1, size - 1), k -> struct(
             (1000BD * cast(f as decimal(18,0)) * cast(n as decimal(18,0)))
               div (cast(heads[k - 1] as decimal(18,0)) * cast(tails[size - k - 1] as decimal(18,0))) as score,
             k, heads[k - 1] as l, tails[size - k - 1] as r))"""
    )
    scored = stay.join(totals, "lang").withColumn("cut", F.array_min(cuts))
    scored = scored.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
