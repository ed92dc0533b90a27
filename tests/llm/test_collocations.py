"""Collocations against counting all phrases, and the index against plain search."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from compare import differences, duckdb_over

from tidemark.llm import collocations as co
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, least, longest=5, top=2000):
    grams, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                grams[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, found in grams.items():
        often = {g: f for g, f in found.items() if f >= least}
        held = {}
        for g, f in often.items():
            for a in range(len(g)):
                for b in range(a + 2, len(g) + 1):
                    if b - a < len(g):
                        held[g[a:b]] = max(held.get(g[a:b], 0), f)
        ranked = []
        for g, a in often.items():
            if len(g) > 1 and held.get(g, 0) < a:
                score, _, l, r = min((1000 * a * totals[lang] // (often[g[:k]] * often[g[k:]]), k, often[g[:k]], often[g[k:]]) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def made(seed, n):
    rng = random.Random(seed)
    words = "the of and New York city hall big red Été ß über a b".split()
    ends = [" ", "\t ", ", ", ". ", "\n", " \r\n", "! ", "\x0b", "   "]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts += [rng.choice(["New York city", "the big red", "a a a a a a", rng.choice(words)]), rng.choice(ends)]
        rows.append((k, "".join(parts), rng.choice(["en", "fr", None, "und"])))
    return rows


def test_extensions_are_those_of_a_plain_search():
    rng = np.random.default_rng(3)
    text = np.concatenate(([0], rng.integers(0, 5, 400), [0])).astype(np.int32)
    both = {True: co.transform(text[::-1], 4), False: co.transform(text, 4)}
    counts = np.bincount(text, minlength=5)
    begin = (np.cumsum(counts) - counts)[1:]
    at = {(w,): (begin[w - 1], begin[w - 1], counts[w]) for w in range(1, 5) if counts[w]}
    for m in range(2, 6):
        for right in (True, False):
            names = list(at)
            lo, rlo, size = (np.array([at[p][c] for p in names]) for c in range(3))
            own, other = (rlo, lo) if right else (lo, rlo)
            phrase, symbol, new_own, new_other, count = co.extended(both[right], own, size, other, 4)
            found = {}
            for p, s, a, b, n in zip(phrase, symbol, new_own, new_other, count):
                name = (*names[p], int(s)) if right else (int(s), *names[p])
                found[name] = ((b, a) if right else (a, b)) + (n,)
            windows = Counter(tuple(text[i : i + m].tolist()) for i in range(len(text) - m + 1))
            assert {p: int(v[2]) for p, v in found.items()} == {p: f for p, f in windows.items() if 0 not in p}
            if right:
                longer = found
            else:
                assert {p: tuple(map(int, v)) for p, v in found.items()} == {p: tuple(map(int, v)) for p, v in longer.items()} or m == 5
        at = longer


def test_collocations(spark, corpus, edge, none):
    rows = made(5, 200)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    want = plain([(r[2], r[1]) for r in rows], 6)
    assert len(want) > 100 and max(len(w[2].split()) for w in want) == 5
    for shard in (co.SHARD, 300, 1):
        assert got(co.collocations(df, least=6, shard=shard, few=0 if shard == 300 else co.FEW)) == want, shard
    assert got(co.collocations(df, least=6, top=7)) == plain([(r[2], r[1]) for r in rows], 6, top=7)
    for table, least in ((corpus, 12), (edge, 3)):
        pairs = [(r.lang, r.text) for r in table.select("lang", "text").collect()]
        assert got(co.collocations(table, least=least)) == plain(pairs, least)
    assert co.collocations(none).count() == 0 and co.collocations(df, least=10**6).count() == 0


def test_counts_meet_packed_in_groups(spark):
    rng = np.random.default_rng(4)
    head, tail = np.divmod(np.unique(rng.integers(0, 10**9, 5000)), 30_000)
    head, tail, size = head * 2**20, tail + 2**33, rng.integers(1, 9, len(head))
    for n in (1, len(head)):
        for given, found in zip((head, tail, size), co.thick(co.thin(head[:n], tail[:n], size[:n]), n)):
            assert (given[:n] == found).all()
    hot = co.part_of(np.full(10**5, 7), np.arange(10**5), 8)
    assert np.bincount(hot, minlength=8).max() < 10**5 / 4, "a common head is spread"
    rows = made(8, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = plain([(r[2], r[1]) for r in rows], 5)
    assert got(co.collocations(df, least=5, shard=400, share=150)) == want
    assert got(co.collocations(df, least=5, shard=400, share=150, few=0)) == want


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_join_per_word_or_phrase_and_no_table_left(spark, monkeypatch):
    plans, stored, bucketed = [], co.stored, co._bucketed
    monkeypatch.setattr(co, "stored", lambda df, purpose: plans.append((purpose, plan(df))) or stored(df, purpose))
    monkeypatch.setattr(co, "_bucketed", lambda df, n: plans.append(("word-indexes", plan(df))) or bucketed(df, n))
    df = spark.createDataFrame(made(9, 40), "doc_id long, text string, lang string").repartition(2)
    co.collocations(df, least=5, shard=200, few=0)
    assert {"word-indexes", "frequent-words", "frequent-phrases-of-2", "alive-phrases-of-2"} <= {p for p, _ in plans}
    for purpose, text in plans:
        joins = [line for line in text.splitlines() if "Join " in line]
        if not purpose.endswith("-named"):
            assert all("(shard#" in j or "(piece#" in j for j in joins) and not any("word#" in j for j in joins), (purpose, joins)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("word_indexes")]


def test_indexes_stay_where_they_are(spark):
    index, table = co._bucketed(spark.range(40).selectExpr("id AS shard", "cast(cast(id AS string) AS binary) AS forward"), 5)
    alive = spark.range(30).selectExpr("id AS shard", "id + 1 AS alive")
    met = index.hint("merge").join(alive.repartition(5, "shard"), "shard")
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r.shard, r.alive) for r in met.collect()) == [(k, k + 1) for k in range(30)]
    spark.sql(f"DROP TABLE {table}")


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(0,)], "x int")
    big = 10**12
    s = df.selectExpr(f"(1000BD * cast({big} as decimal(18,0)) * cast({big * 9} as decimal(18,0))) div (cast({big} as decimal(18,0)) * cast({big} as decimal(18,0))) as s")
    assert s.first().s == 9000


def test_the_query_matches_sql(spark):
    folder = "/root/testdata/sf0.01"
    name = "op11_phrase_collocations"
    assert differences(QUERIES[name](spark, folder), duckdb_over(folder), ORACLE[name]) is None
