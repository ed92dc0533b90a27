"""The pipeline stage by stage against brute force, on whole small tables and on edge cases."""

from collections import Counter, defaultdict

import pytest
from test_deduplication import components, lowered, plain_fingerprint

import corpus_pipeline
from tidemark.llm import mixing, toxicity

SMALL = "/root/testdata/sf0.001"


def exact_survivors(pairs):
    best = {}
    for doc_id, text in pairs:
        key = lowered(text)
        if key not in best or (best[key] is None and doc_id is not None) or (doc_id is not None and doc_id > best[key]):
            best[key] = doc_id
    return Counter(best.values())


def near_survivors(pairs):
    fps = [plain_fingerprint(t) for _, t in pairs]
    roots = components(set(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    groups = defaultdict(list)
    for (doc_id, _), fp in zip(pairs, fps):
        groups[roots[fp]].append(doc_id)
    return Counter(min((i for i in ids if i is not None), default=None) for ids in groups.values())


@pytest.mark.parametrize("name", ["corpus", "edge"])
def test_every_stage(spark, request, tmp_path, name):
    docs = request.getfixturevalue(name)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / f"{name}{n}"))
        before, docs = docs, spark.read.parquet(str(tmp_path / f"{name}{n}"))
        got.append((before, docs))
        if n < 4:
            assert set(docs.columns) == set(before.columns)
    pairs = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    before, after = got[0]
    calm = toxicity.toxicity(before, labels).filter("predicted = 0")
    assert ids(after) == ids(calm)
    before, after = got[1]
    assert ids(after) == exact_survivors(pairs(before))
    before, after = got[2]
    assert ids(after) == near_survivors(pairs(before))
    before, after = got[3]
    taken = Counter({r.doc_id: r.taken // r["size"] for r in mixing.mix(before).filter("size > 0").collect()})
    sized = Counter({i: n for i, n in ids(after).items() if i in taken})
    assert +sized == +taken
    before, after = got[4]
    pieces = after.collect()
    per = defaultdict(list)
    for p in pieces:
        per[p.sequence_id].append((p.offset, p.length))
    for spans in per.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= 2048
    assert ids(before) == Counter(p.doc_id for p in pieces if p.start == 0)


def test_no_documents(spark, none, tmp_path):
    docs = none
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
    assert docs.count() == 0
