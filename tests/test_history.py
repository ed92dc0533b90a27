"""Versioned dimensions: no overlaps, one current version, batches equal a rebuild."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.functions.time import timestamp
from tidemark.operators import asof, facts, history, quality
from tidemark.operators.sliced import lag_sliced, lead_sliced, running_sum_sliced
from tidemark.schemas import CUSTOMERS, DIM_CUSTOMER, FACT_ORDERS

def run_ts():
    return timestamp("2026-05-01 00:00:00")

T0 = datetime(2026, 1, 1)


def customers(spark, rows):
    """Clean customer rows of (id, email, day)."""
    full = [(i, "F", "L", e, "5", "US", T0, T0 + timedelta(days=d), "t", T0) for i, e, d in rows]
    return spark.createDataFrame(full, CUSTOMERS.clean)


def versions(dim):
    return sorted((r.customer_id, r.email, r.valid_from, r.valid_to, r.is_current) for r in dim.collect())


def test_batches_equal_a_rebuild_and_never_overlap(spark):
    rng = random.Random(5)
    log, dim = [], spark.createDataFrame([], DIM_CUSTOMER)
    for n in range(4):
        rows = [(f"c{i}", rng.choice("xy"), n * 40 + rng.randrange(3)) for i in range(6) if rng.random() < 0.8]
        log += rows
        dim = spark.createDataFrame(history.apply_versions(dim, history.stage_versions(customers(spark, rows)), run_ts()).collect(), DIM_CUSTOMER)
    rebuilt = history.build_history(history.stage_versions(customers(spark, log)), run_ts())
    assert versions(dim) == versions(rebuilt)
    assert quality.overlapping_versions(dim).first().n == 0
    current = dim.filter("is_current").groupBy("customer_id").count()
    assert {r["count"] for r in current.collect()} == {1}
    keys = [r.customer_sk for r in dim.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_unchanged_rows_open_nothing(spark):
    staged = history.stage_versions(customers(spark, [("c", "x", 0)]))
    dim = history.apply_versions(spark.createDataFrame([], DIM_CUSTOMER), staged, run_ts())
    again = history.stage_versions(customers(spark, [("c", "x", 9)]))
    assert history.open_versions(dim, again, run_ts()).isEmpty()
    assert versions(history.close_versions(dim, again, run_ts())) == versions(dim)


def test_null_and_empty_hash_alike(spark):
    pair = spark.createDataFrame(
        [("a", "b", None, "c", "d"), ("a", "b", "", "c", "d")], ", ".join(f"{c} string" for c in history.TRACKED)
    )
    hashes = {r[0] for r in pair.select(history.change_hash(history.TRACKED)).collect()}
    assert len(hashes) == 1 and len(hashes.pop()) == 64


def test_each_fact_finds_at_most_one_version(spark):
    dim = history.build_history(
        history.stage_versions(customers(spark, [("c", e, d) for e, d in zip("xyxy", (0, 10, 20, 30))])), run_ts()
    ).withColumn("customer_sk", F.monotonically_increasing_id())
    orders = spark.createDataFrame(
        [(f"o{d}", "c" if d % 2 else None, T0 + timedelta(days=d)) for d in range(-5, 50)], "order_id string, customer_id string, order_ts timestamp_ntz"
    )
    found = asof.as_of_customer(orders, dim, "customer_id", "order_ts").collect()
    assert len(found) == 55
    assert all((r.customer_sk is None) == (r.customer_id is None or r.order_ts < T0) for r in found)


def test_rekey_keeps_found_keys(spark):
    schema = FACT_ORDERS
    row = lambda i, sk: (i, T0, T0.date(), sk, "s", None, None, None, None, "c", T0)
    fact = spark.createDataFrame([row("a", 1), row("b", None), row("c", None)], schema)
    fresh = spark.createDataFrame([row("a", 7), row("b", 8), row("c", None)], schema)
    keyed = {r.order_id: r.customer_sk for r in facts.rekey(fact, "order_id", fresh).collect()}
    assert keyed == {"a": 1, "b": 8, "c": None}


def test_sliced_windows_equal_plain_ones(spark):
    rng = random.Random(2)
    rows = {}
    while len(rows) < 600:
        rows[(rng.choice("aaab"), rng.randrange(5000))] = rng.randrange(-3, 4)
    data = sorted((k, at, v) for (k, at), v in rows.items())
    df = spark.createDataFrame(data, "k string, at int, v int").withColumn("part", F.floor(F.col("at") / 100))
    df = lag_sliced(df, ["k"], "part", "at", "v", "before")
    df = lead_sliced(df, ["k"], "part", "at", "v", "after")
    df = running_sum_sliced(df, ["k"], "part", ["at"], F.col("v"), "total")
    expected = []
    for key in "ab":
        mine, total = [r for r in data if r[0] == key], 0
        for i, (k, at, v) in enumerate(mine):
            total += v
            expected.append((k, at, mine[i - 1][2] if i else None, mine[i + 1][2] if i + 1 < len(mine) else None, total))
    got = [(r.k, r.at, r.before, r.after, r.total) for r in df.collect()]
    assert sorted(got, key=lambda r: r[:2]) == expected


def _long_dim(spark, n):
    """One customer whose ``n`` versions last a minute each, with gaps, and some others."""
    at = F.lit(str(T0)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int") * 2)
    hot = spark.range(n).select(
        F.col("id").alias("customer_sk"), F.lit("hot").alias("customer_id"), at.alias("valid_from"),
        (at + F.expr("interval 1 minute")).alias("valid_to"),
    )
    few = [(10**6 + i, f"c{i % 7}", T0 + timedelta(days=i), T0 + timedelta(days=i + 7 if i < 50 else 9999)) for i in range(57)]
    few.append((10**7, "c1", T0 + timedelta(days=3), T0 + timedelta(days=1)))  # ends before it begins
    return hot.unionByName(spark.createDataFrame(few, hot.schema))


def _facts_over(spark, n):
    at = F.lit(str(T0)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))
    who = F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 9))
    return spark.range(n).select(
        F.col("id").alias("f"), who.alias("who"), F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(at).alias("at"),
        F.lit("taken").alias("valid_to"), F.lit("taken").alias("_month"),
    )


def test_merged_lookup_equals_the_join(spark):
    dim, rows = _long_dim(spark, 300), _facts_over(spark, 1500)
    far = rows.withColumn("at", F.col("at") + F.expr("interval 400 days"))  # months without versions
    for probe in (rows, far, rows.unionByName(rows), rows.limit(0)):
        want, got = (sorted(map(str, f(probe, dim, "who", "at").collect())) for f in (asof.as_of_customer, asof.as_of_merged))
        assert want == got and len(got) == probe.count()
    assert asof.lookup_for(dim) is asof.as_of_merged
    assert asof.lookup_for(dim.filter("customer_id <> 'hot'")) is asof.as_of_customer
    assert asof.as_of_merged(rows, dim.limit(0), "who", "at").filter("customer_sk is not null").isEmpty()


def test_a_history_of_100000_versions_is_looked_up_in_linear_time(spark):
    dim, rows = _long_dim(spark, 100_000), _facts_over(spark, 200_000)
    found = asof.as_of_merged(rows, dim, "who", "at").filter("who = 'hot'")
    minutes = F.col("f") % 2 == 0  # even minutes lie in a version, odd ones in a gap
    wrong = found.filter("at is not null").filter(
        ~F.when(minutes, F.col("customer_sk") == F.col("f") / 2).otherwise(F.col("customer_sk").isNull())
    )
    assert wrong.isEmpty() and found.count() > 100_000


def test_overlapping_versions_give_one_row_per_fact(spark):
    dim = spark.createDataFrame(
        [(1, "a", T0, T0 + timedelta(days=9)), (2, "a", T0 + timedelta(days=2), T0 + timedelta(days=9))],
        "customer_sk long, customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    rows = spark.createDataFrame([("a", T0 + timedelta(days=d)) for d in (0, 3, 9)], "who string, at timestamp_ntz")
    assert [r.customer_sk for r in asof.as_of_merged(rows, dim, "who", "at").orderBy("at").collect()] == [1, 2, None]
