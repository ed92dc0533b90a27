"""The chain of lines against enumeration of all labellings, numeric gradients and held-out labels."""

import zlib
from itertools import product

import numpy as np

from tidemark.llm import line_quality as lq


def some_weights(seed):
    return np.random.default_rng(seed).normal(0, 0.4, lq.SIZE)


TEXTS = ["One line only.", "First line.\n\nA | table | here\nA | table | here\nThe end.", "", "\n", "WHAT!! NOW!!\nüber öl #$% x",
         "again and again and again", "last\nbut\none"]


def test_marginals_and_sums_are_those_of_all_labellings():
    ids, _, per_text = lq.line_features(TEXTS)
    w = some_weights(1)
    moves = w[lq.MOVES : lq.MOVES + 4].reshape(2, 2)
    speak = lq.potentials(ids, per_text, w)
    good, (_, pairs), total = lq.forward_backward(speak, per_text, moves, w[lq.START])
    at, n_pairs = 0, 0
    for k, n in enumerate(per_text):
        weighed = {}
        for y in product((0, 1), repeat=int(n)):
            score = sum(speak[at + t] for t in range(n) if y[t]) + y[0] * w[lq.START]
            weighed[y] = np.exp(score + sum(moves[a, b] for a, b in zip(y, y[1:])))
        z = sum(weighed.values())
        assert np.isclose(total[k], np.log(z))
        for t in range(n):
            assert np.isclose(good[at + t], sum(v for y, v in weighed.items() if y[t]) / z)
        for t in range(1, n):
            for a, b in product((0, 1), repeat=2):
                want = sum(v for y, v in weighed.items() if (y[t - 1], y[t]) == (a, b)) / z
                assert np.isclose(pairs[n_pairs, a, b], want)
            n_pairs += 1
        at += n


def test_the_gradient_is_the_slope_of_the_loss():
    ids, _, per_text = lq.line_features(TEXTS)
    labels = np.array([1, 0, 1, 0, 0, 1, 1])
    w = some_weights(2)
    got = lq.gradient(ids, per_text, labels, w)
    for k in [*np.unique(ids)[:20], *(lq.PREVIOUS + np.unique(ids)[:10]), *(lq.NEXT + np.unique(ids)[:10]), *range(lq.FIRST, lq.SIZE)]:
        step = np.zeros(lq.SIZE)
        step[k] = 1e-5
        slope = (lq.gradient(ids, per_text, labels, w + step)[-1] - lq.gradient(ids, per_text, labels, w - step)[-1]) / 2e-5
        assert np.isclose(got[k], slope, atol=1e-6), k


def test_features_of_lines():
    ids, lengths, per_text = lq.line_features(TEXTS)
    assert per_text.tolist() == [t.count("\n") + 1 for t in TEXTS]
    assert lengths.tolist() == [len(x) for t in TEXTS for x in t.split("\n")]
    names = list(lq.BINS)
    bin_of = lambda n, name: int(ids[n, names.index(name)] % lq.WIDTH)
    assert [bin_of(n, "again") for n in range(6)] == [0, 0, 0, 0, 1, 0]
    assert bin_of(9, "upper") == 7 and bin_of(9, "odd ends") == 7 and bin_of(10, "upper") == 0
    assert bin_of(11, "same word") > 3 and bin_of(0, "same word") == 0
    one_by_one = [lq.line_features([t])[0] for t in TEXTS]
    assert np.array_equal(np.concatenate(one_by_one), ids)


def test_cuts():
    assert lq.best_cut([(900, 50, 0), (100, 0, 50)], 1000) == 0.5005
    assert lq.best_cut([(900, 50, 0)], 1000) == 0.5


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = lq.line_quality(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in scored)
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert len(good) > 1000 and len(bad) > 150
    assert sum(s >= 0.5 for s in good) > 0.99 * len(good)
    assert sum(s < 0.5 for s in bad) > 0.9 * len(bad)
    above = sum(np.searchsorted(np.sort(bad), g, side="left") for g in good) / (len(good) * len(bad))
    assert above > 0.95


def test_edges_and_dealing(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (1, 0), (9, 0), (999, 1), (7, 1)], "doc_id long, quality int")
    got = sorted((str(r.doc_id), r.score) for r in lq.line_quality(edge, labels).collect())
    assert len(got) == edge.count() and all(0 <= s <= 1 for _, s in got)
    again = sorted((str(r.doc_id), r.score) for r in lq.line_quality(edge.repartition(5, "text"), labels).collect())
    assert got == again
    assert lq.line_quality(edge, labels.limit(0)).filter("score != 0.5").count() == 0
    assert lq.line_quality(none, labels).count() == 0
    assert lq.line_quality(edge, labels).schema.simpleString() == "struct<doc_id:bigint,held_out:boolean,score:double,predicted:int>"
