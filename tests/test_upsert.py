"""Upserts: idempotence, order independence, and what a batch may not change."""

import itertools
import random
import re
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.changes import change_images
from tidemark.operators.keys import assign_keys
from tidemark.operators.latest import latest_by_key, post_images, snapshot_as_of
from tidemark.operators.upsert import (
    DuplicateKeyError, guarded_merge, guarded_upsert, insert_new, overwrite_by_key, require_unique, updated_or_loaded,
)
from tidemark.sources.id_index import IdIndex

SCHEMA = "k string, v int, updated_at timestamp_ntz, load_ts timestamp_ntz"
T0 = datetime(2026, 1, 1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def day(n):
    return None if n is None else T0 + timedelta(days=n)


def batch(spark, rows):
    return spark.createDataFrame([(k, v, day(u), day(l)) for k, v, u, l in rows], SCHEMA)


def model(target, source):
    """Guarded upsert over dictionaries."""
    out = dict(target)
    for k, (v, u, l) in source.items():
        new = u if u is not None else l
        if k in out:
            old = out[k][1] if out[k][1] is not None else out[k][2]
            if new is None or old is None or new < old:
                continue
        out[k] = (v, u, l)
    return out


ages = st.one_of(st.none(), st.integers(0, 4))
table = st.dictionaries(st.sampled_from("abcdef"), st.tuples(st.integers(0, 9), ages, ages), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table, table)
def test_guarded_upsert_matches_the_model(spark, target, source):
    t = batch(spark, [(k, *row) for k, row in target.items()])
    s = batch(spark, [(k, *row) for k, row in source.items()])
    merged = guarded_upsert(t, s, ["k"], updated_or_loaded)
    expected = batch(spark, [(k, *row) for k, row in model(target, source).items()])
    assert rows_of(merged) == rows_of(expected)


def test_upserts_are_idempotent(spark):
    t = batch(spark, [("a", 1, 1, 1), ("b", 2, 2, 2)])
    s = batch(spark, [("b", 3, 3, 3), ("c", 4, None, 1)])
    once = guarded_upsert(t, s, ["k"], updated_or_loaded)
    assert rows_of(guarded_upsert(once, s, ["k"], updated_or_loaded)) == rows_of(once)
    over = overwrite_by_key(t, s, ["k"])
    assert rows_of(overwrite_by_key(over, s, ["k"])) == rows_of(over)
    assert insert_new(once, s, ["k"]).isEmpty()


def test_result_does_not_depend_on_the_order_of_batches(spark):
    batches = [
        batch(spark, [("a", 1, 3, 1), ("b", 1, 1, 1)]),
        batch(spark, [("a", 2, 5, 2), ("c", 2, None, 2)]),
        batch(spark, [("a", 3, 4, 3), ("b", 3, None, 3)]),
    ]
    results = set()
    for order in itertools.permutations(batches):
        merged = order[0]
        for later in order[1:]:
            merged = guarded_upsert(merged, later, ["k"], updated_or_loaded)
        results.add(str(rows_of(merged)))
    assert len(results) == 1
    assert "('a', 2" in results.pop()


def test_changed_rows_are_exactly_those_taken(spark):
    t = batch(spark, [("a", 1, 5, 1), ("b", 2, 2, 2), ("d", 0, 0, 0)])
    s = batch(spark, [("a", 9, 4, 9), ("b", 3, 2, 3), ("c", 4, 1, 1)])
    merged = guarded_merge(t, s, ["k"], updated_or_loaded)
    assert {r.k for r in merged.filter("_changed").collect()} == {"b", "c"}, "an equal age updates, an older one does not"


def test_unique_key_check(spark):
    require_unique(batch(spark, [("a", 1, 1, 1), ("b", 1, 1, 1)]), ["k"])
    with pytest.raises(DuplicateKeyError):
        require_unique(batch(spark, [("a", 1, 1, 1), ("a", 2, 1, 1)]), ["k"])


def test_latest_of_a_key_with_very_many_copies(spark):
    copies = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v")
    )
    newest = latest_by_key(copies, ["k"], [F.desc("v")])
    assert newest.filter("k = 'hot'").collect()[0].v == 49_998
    assert newest.count() == copies.select("k").distinct().count()


def test_deletes_and_keyless_changes_are_ignored(spark):
    changes = spark.createDataFrame(
        [("a", "INSERT"), ("b", "UPDATE"), ("c", "DELETE"), (None, "INSERT")], "k string, _action string"
    )
    assert rows_of(post_images(changes, "k")) == [("a",), ("b",)]


def test_snapshot_as_of(spark):
    log = batch(spark, [("a", 1, 1, 1), ("a", 2, 2, 5), ("b", 3, 1, 6)])
    at = F.lit(str(day(5))).cast("timestamp_ntz")
    assert [(r.k, r.v) for r in snapshot_as_of(log, ["k"], "load_ts", at).collect()] == [("a", 2)]


def test_keys_are_dense_unique_and_continue(spark):
    names = [f"n{random.Random(3).random()}-{i}" for i in range(2000)]
    rows = spark.createDataFrame([(n,) for n in names], "name string").repartition(13)
    first = assign_keys(rows, ["name"], "sk").collect()
    assert [r.sk for r in sorted(first, key=lambda r: r.name)] == list(range(1, 2001))
    more = spark.createDataFrame([("zz",), ("aa",)], "name string")
    taken = spark.createDataFrame([(41,)], "sk long")
    assert rows_of(assign_keys(more, ["name"], "sk", taken)) == [(42, "aa"), (43, "zz")]
    assert assign_keys(more.limit(0), ["name"], "sk", taken).count() == 0


def test_change_images(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1.0), (3, "c", 2.0), (None, "x", 0.0)], "k long, v string, w double")
    after = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", 2.0), (None, "y", 0.0)], "k long, v string, w double")
    got = sorted(tuple(r) for r in change_images(before, after, ["k"]).select("k", "v", "_action").collect())
    assert got == [(2, "b", "UPDATE"), (2, "b", "UPDATE_BEFORE"), (3, "c", "DELETE"), (4, "d", "INSERT")]
    assert change_images(before, before, ["k"]).isEmpty()
    variant = lambda text: spark.createDataFrame([(1,)], "k long").withColumn("p", F.parse_json(F.lit(text)))
    assert change_images(variant('{"a": 1}'), variant('{"a":1}'), ["k"]).isEmpty()
    assert change_images(variant('{"a": 1}'), variant('{"a": 2}'), ["k"]).count() == 2


def test_an_index_of_ids_is_opened_at_the_prefixes_met(spark, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), "event_id", prefixes=8)
    rows = lambda ids, at="2026-01-01": spark.createDataFrame([(i,) for i in ids], "event_id string").withColumn(
        "load_ts", F.lit(at).cast("timestamp_ntz"))
    assert index.unseen(rows(["a"])).count() == 1
    index.add(rows([f"e{n}" for n in range(500)]), 0)
    index.add(rows([f"e{n}" for n in range(490, 600)], "2026-02-01"), 1)
    index.add(rows([f"e{n}" for n in range(490, 600)], "2026-02-01"), 1)  # again
    assert index.read().count() == 610
    met = index.met_by(rows(["e7"]))
    text = met._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_prefix#\d+ = \d", text), "other prefixes are not opened"
    assert met.select("_prefix").distinct().count() == 1 and met.count() < 200
    batch = rows(["e7", "e550", "new", "e599"])
    assert {r.event_id for r in index.unseen(batch).collect()} == {"new"}
    assert {r.event_id for r in index.unseen(batch, batch=1).collect()} == {"new", "e550", "e599"}
    since = F.lit("2026-01-15").cast("timestamp_ntz")
    assert {r.event_id for r in index.unseen(batch, since=since).collect()} == {"new", "e7"}
