"""Exact, near and substring deduplication against brute force."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, repeats, simhash
from tidemark.llm.components import connected


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(df):
    return [tuple(r) for r in df.collect()]


def expected_groups(pairs):
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[lowered(text)].append(doc_id)
    found = Counter()
    for doc_id, text in pairs:
        own = groups[lowered(text)]
        keep = max((i for i in own if i is not None), default=None)
        found[(doc_id, keep, len(own), hashlib.sha256(lowered(text).encode()).hexdigest())] += 1
    return found


def check_groups(df, **options):
    pairs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = exact_dedup.exact_groups(df, **options).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected_groups(pairs)
    assert sum(r.kept for r in got) == len({lowered(t) for _, t in pairs})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_groups(edge, corpus):
    check_groups(edge)
    check_groups(corpus)


def test_exact_groups_with_small_blocks_and_clashing_hashes(edge):
    weak = lambda b: F.length(b).cast("long") % 3
    check_groups(edge.filter("length(text) < 100 or text is null"), block=4, block_hash=weak)


def test_exact_stage_keeps_columns(edge, none):
    stay = exact_dedup.without_copies(edge)
    assert stay.columns == edge.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter([2, 4, 5, 6, 7, 8, 9, 10])
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.without_copies(none).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[n : n + 4]) for n in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = list(nodes)
    for n, a in enumerate(nodes):
        for b in nodes[n + 1 :]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def check_near(df):
    pairs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    fps = [plain_fingerprint(t) for _, t in pairs]
    roots = components(set(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    low = defaultdict(list)
    for (doc_id, _), fp in zip(pairs, fps):
        low[roots[fp]].append(doc_id)
    low = {r: min((i for i in ids if i is not None), default=None) for r, ids in low.items()}
    want = Counter((i, fp, low[roots[fp]]) for (i, _), fp in zip(pairs, fps))
    got = simhash.near_groups(df).collect()
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    return len(low)


def test_near_groups(edge, corpus, none):
    check_near(corpus.select("doc_id", "text").unionByName(edge.select("doc_id", "text")))
    groups = check_near(edge)
    stay = simhash.one_of_each_group(edge)
    assert stay.columns == edge.columns and stay.count() == groups
    assert simhash.near_groups(none).count() == 0


def near_prints(seed, n):
    """Clusters of fingerprints a few bits apart, and fingerprints with correlated bits."""
    rng = np.random.default_rng(seed)
    seeds = rng.integers(0, 1 << 63, 12, dtype=np.int64)
    near = [int(s) ^ (1 << int(a)) ^ (1 << int(b)) for s in seeds for a, b in rng.integers(0, 63, (n // 24, 2))]
    return sorted({*near, *(int(x) & ~0xFFFF for x in rng.integers(0, 1 << 63, n // 2, dtype=np.int64))})


def check_links(spark, fps, **options):
    df = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(3)
    found = connected(simhash.links(df, **options)).collect()
    want = components(fps, lambda a, b: (a ^ b).bit_count() <= options.get("limit", 4))
    assert {r.node: r.root for r in found} == {n: r for n, r in want.items() if sum(x == r for x in want.values()) > 1}


def test_links_for_several_plans(spark):
    fps = near_prints(1, 240)
    check_links(spark, fps)
    check_links(spark, fps, block=8)  # large places are cut
    near = np.ones((2, 5), np.int64)
    assert sum(t + 1 for t in simhash.thresholds(10**9, [32, 32], near, 10**6, 4)[1]) == 5
    halves = [[*range(32)], [*range(32, 64)]]
    keys = []
    for k, (t, bits) in enumerate(zip((1, 2), halves)):
        for r in range(t + 1):
            for flip in combinations(bits, r):
                keys.append((k, simhash._signed(simhash._mask(bits)), simhash._signed(simhash._mask(flip))))
    check_links(spark, fps, keys=keys)


def test_connected(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 101), (101, 101), (101, 100)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {n: 0 for n in range(41)} | {100: 100, 101: 100}
    assert {r.node: r.root for r in connected(df).collect()} == want
    assert connected(df.limit(0)).count() == 0


def plain_units(text, least):
    """Units worked out anew: lines, paragraphs, and runs of sentences from each sentence on."""
    size = lambda s: max(len(s.split()), len(s.strip()) // repeats.WIDE_WORD)
    sentences, at = [], 0
    for line in text.split("\n"):
        for m in re.finditer(r"\S.*?(?:[.!?]+(?=\s|$)|$)", line):
            sentences.append((at + m.start(), at + m.start() + len(m[0].rstrip())))
        at += len(line) + 1
    spans = set()
    for n in range(len(sentences)):
        total, k = 0, n
        while k < len(sentences) and total < least:
            total += size(text[slice(*sentences[k])])
            k += 1
        if total >= least:
            spans.add((sentences[n][0], sentences[k - 1][1]))
    for pattern in (r"[^\n]+", r"(?:[^\n]*\S[^\n]*(?:\n|$))+"):
        for m in re.finditer(pattern, text):
            start, end = m.start() + len(m[0]) - len(m[0].lstrip()), m.start() + len(m[0].rstrip())
            if start < end and size(text[start:end]) >= least:
                spans.add((start, end))
    return {(a, b, " ".join(text[a:b].split()).lower()) for a, b in spans}


def plain_removed(pairs, least=repeats.LEAST_WORDS):
    """Per document the positions that go, and what stays of each unit."""
    met = defaultdict(list)
    for n, (doc_id, text) in enumerate(pairs):
        for start, end, words in plain_units(text or "", least):
            met[words].append(((doc_id is None, doc_id or 0, n, start), n, start, end))
    out = defaultdict(set)
    for found in met.values():
        for _, n, start, end in sorted(found)[1:]:
            out[n].update(range(start, end))
    return out


def removed(df):
    got = defaultdict(set)
    for r in repeats.repeated_units(df).collect():
        got[r.doc_id].update(range(r.start, r.end))
    return got


def solid(text, places):
    """Positions that are not white space: joined spans may differ in the space between units."""
    return {p for p in places if not text[p].isspace()}


def test_repeated_units(spark, edge, corpus, none):
    pairs = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").orderBy("doc_id").collect()]
    want, got = plain_removed(pairs), removed(corpus)
    for n, (doc_id, text) in enumerate(pairs):
        assert solid(text or "", got.get(doc_id, ())) == solid(text or "", want.get(n, ())), doc_id
    rows_ = repeats.repeated_units(edge).collect()
    # One row of documents 1, 2, 2 keeps nothing that is long enough; 5, 6 and 7 share all but the last sentence.
    assert {r.doc_id for r in rows_} == {5, 6, 7} and all(r.keep_id == 5 for r in rows_)
    assert repeats.repeated_units(none).count() == 0


def test_spans_are_joined_and_apart(corpus):
    per = defaultdict(list)
    for r in repeats.repeated_units(corpus).collect():
        per[r.doc_id].append((r.start, r.end))
    for spans in per.values():
        spans.sort()
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_repeated_passages_are_covered_and_others_left(spark):
    """Words in 50-word windows that an earlier document holds, and documents that share no 20 words with another."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = removed(docs)
    first, covered, total = {}, 0, 0
    shared = defaultdict(set)
    for doc_id in sorted(texts):
        words = [(m.start(), m[0].lower()) for m in re.finditer(r"\S+", texts[doc_id])]
        marked = set()
        for n in range(len(words) - 49):
            key = hash(tuple(w for _, w in words[n : n + 50]))
            if first.setdefault(key, doc_id) != doc_id:
                marked.update(range(n, n + 50))
        total += len(marked)
        covered += sum(words[n][0] in got[doc_id] for n in marked)
        for n in range(len(words) - 15):
            shared[hash(tuple(w for _, w in words[n : n + 16]))].add(doc_id)
    assert total > 1000 and covered >= 0.9 * total
    alone = set(texts) - {d for ids in shared.values() if len(ids) > 1 for d in ids}
    own = {d for d in alone if len({w for w in re.findall(r"\S+", texts[d])}) > 0.8 * len(texts[d].split())}
    assert len(own) > 100 and not any(got[d] for d in own)


def test_a_passage_within_lines_is_found(spark):
    passage = "Every word of this passage is here twice. So. It was put into the middle of other lines by somebody who had time."
    rows_ = [(1, f"A first line of its own with words. {passage} And more.", "en", "a"),
             (2, f"Something else\nbefore it. {passage}", "en", "a"), (3, "Nothing here is the same as elsewhere at all.", "en", "a"),
             (4, "文" * 300, "zh", "a"), (5, "文" * 300, "zh", "a")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in repeats.repeated_units(docs).collect()}
    assert found.keys() == {2, 5} and found[2].keep_id == 1 and (found[5].start, found[5].end) == (0, 300)
    text = rows_[1][1]
    assert repeats.without_spans(text, [(found[2].start, found[2].end)]) == "Something else\nbefore it."
    assert text[found[2].start : found[2].end] == passage
