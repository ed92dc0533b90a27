"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

from tidemark.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_words(pairs, least=5, least_count=3, every=97):
    counts = Counter()
    for doc_id, text in pairs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= least_count}


def plain_variants(counts):
    near = {w: [] for w in counts}
    words = sorted(counts)
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for size, own in by_length.items():
        for a, b in [*combinations(own, 2), *((a, b) for a in own for b in by_length.get(size + 1, ()))]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return set(rows)


def some_words(seed, n):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abç") for _ in range(rng.randint(1, 7))) for _ in range(n)}
    return sorted(words | {"a" * k for k in range(3, 12)} | {"zürich", "zurich", "zurichs", "zürichs"})


def test_composition_finds_each_pair_once():
    for seed in range(6):
        words = some_words(seed, 150)
        pairs = spelling.one_edit_pairs(words)
        assert len(pairs) == len({frozenset(p) for p in pairs})
        want = {(a, b) for a, b in combinations(range(len(words)), 2) if one_edit(words[a], words[b])}
        assert {tuple(sorted(p)) for p in pairs} == want
    assert spelling.one_edit_pairs([]) == [] and spelling.one_edit_pairs(["one"]) == []
    long = ["x" * 3000 + end for end in ("", "a", "b", "bc")]
    assert len(spelling.one_edit_pairs(long)) == 4  # '' a, '' b, a b, b bc


def test_acceptors_are_minimal():
    machine = spelling.Acceptor(sorted(["taps", "tap", "tops", "top"]))
    assert len(machine.order) == 5 and machine.below[0] == 4


def test_split_states_give_the_same(spark):
    words = some_words(9, 400)
    counts = {w: random.Random(w).choice((3, 5, 8, 20, 50)) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    want = {}
    for w, _, _, _, near, _ in plain_variants(counts):
        if near:
            best = min((o for o in words if one_edit(o, w)), key=lambda o: (-counts[o], o))
            want[w] = (near, -counts[best], best)
    for block in (10_000, 60, 8, 1):
        found = {r.word: (r.n_near, r.best.less, r.best.word) for r in spelling.near_words(df, block).collect()}
        assert found == want, block


def test_variants(spark, corpus, edge, none):
    rng = random.Random(4)
    words = "kitten sitten sittin mitten bitten bittem because becuase becase Müller Mülle ÀBCDEF àbcdef".split()
    made = [(70_000 + n, " ".join(rng.choices(words, [40, 9, 4, 30, 12, 5, 60, 9, 5, 30, 9, 20, 9], k=30))) for n in range(20)]
    more = spark.createDataFrame(made, "doc_id long, text string")
    both = edge.select("doc_id", "text").unionByName(more)
    for df, block in ((both, 4000), (both, 3), (corpus.select("doc_id", "text"), 500)):
        pairs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        want = plain_variants(plain_words(pairs))
        assert any(r[1] and r[2] != r[1] for r in want) or df is not both
        assert got(spelling.variants(df, block=block)) == want
    assert got(spelling.variants(edge, every=3)) == plain_variants(plain_words([(r.doc_id, r.text) for r in edge.collect()], every=3))
    assert spelling.variants(none).count() == 0
