"""The plans behind the queries: what is pushed down, combined early, and never done."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import facts, recon, session_days, sessions
from tidemark.operators.asof import as_of_customer
from tidemark.operators.joins import left_join, without
from tidemark.operators.latest import latest_by_key
from tidemark.operators.sliced import running_sum_sliced
from tidemark.operators.upsert import insert_new
from tidemark.registry.queries import QUERIES
from tidemark.sources.star import Star

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """Plan as if no table were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Queries that only write and read files plan nothing of interest here.
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("csv_", "json_", "stream_", "dated_", "job_"))))
def test_no_python_no_products_no_forced_broadcast(spark, large_tables, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"Python|ArrowEval|BatchEval|MapInPandas", text)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name not in ("surrogate_keys", "scd2_apply_batch", "dim_product_type1"):  # these broadcast one row per partition
        assert "BroadcastHashJoin" not in text


def test_top_row_per_key_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["dedup_latest"](spark, FOLDER))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning") < partial


def test_scans_read_only_needed_columns_and_filter_early(spark):
    star = Star(spark, FOLDER)
    text = plan(recon.return_totals(star.fact_returns()))
    schema = re.search(r"ReadSchema: struct<([^>]*l_returnflag[^>]*)>", text).group(1)
    assert "l_tax" not in schema and "l_quantity" not in schema
    assert "EqualTo(l_returnflag,R)" in text


def test_recent_partitions_prune(spark, tmp_path):
    QUERIES["fact_orders"](spark, FOLDER).withColumn("m", F.date_format("order_date", "yyyy-MM")).write.partitionBy("m").parquet(
        str(tmp_path / "t")
    )
    text = plan(spark.read.parquet(str(tmp_path / "t")).filter("m >= '2001-07'"))
    assert re.search(r"PartitionFilters: \[[^\]]*2001-07", text)


def test_aggregates_combine_before_the_shuffle(spark, large_tables):
    star = Star(spark, FOLDER)
    text = plan(recon.payment_totals(star.fact_payments()))
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning(order_id")


def test_sessions_shuffle_events_by_customer_and_minute(spark, large_tables):
    text = plan(sessions.computed_sessions(Star(spark, FOLDER).fact_events()))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*(?:\([^)]*\))?[^)]*)\)", text)
    assert any("_minute" in k for k in keys)
    assert "partial_min" in text


def _shuffles(df) -> int:
    return plan(df).count("Exchange hashpartitioning")


def test_session_days_take_few_shuffles(spark, large_tables):
    events = QUERIES["fact_events"](spark, FOLDER)
    own = _shuffles(events)
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    parts = session_days.day_parts(events, stamp)
    assert _shuffles(parts) == own + 2  # one by minute, one by day
    assert _shuffles(session_days.fold_days(parts)) == own + 3
    assert _shuffles(QUERIES["fact_sessions_incremental"](spark, FOLDER)) < 24


def test_a_batch_of_one_customer_reads_and_writes_its_own_days(spark, tmp_path):
    from tidemark.plans.serving import build_events
    from tidemark.plans.warehouse import Warehouse
    from tidemark.schemas import EVENTS, conform

    wh = Warehouse(spark, str(tmp_path), session_buckets=8)
    stamp = F.lit("2026-03-01 00:00:00").cast("timestamp_ntz")
    clicks = _clicks(spark, 7, 3000).withColumns({
        "session_id": F.concat(F.lit("s"), F.col("customer_sk").cast("string")), "payload": F.parse_json(F.lit("{}")),
        "event_ts": F.col("event_ts") + F.make_dt_interval((F.col("event_id").cast("int") % 60)),
        "record_source": F.lit("f"),
    })
    build_events(wh, conform(clicks, EVENTS.clean), 0, stamp)
    before = wh.sessions.snapshot().folders["session_days"]
    assert len(before) > 16
    late = clicks.filter("event_id = '30'").withColumn("event_id", F.lit("late"))
    build_events(wh, conform(late, EVENTS.clean), 1, stamp)
    after = wh.sessions.snapshot().folders["session_days"]
    assert len([p for p in after if after[p] != before.get(p)]) == 1 and before.keys() == after.keys()
    every = wh.fact_events.read().drop("_batch")
    assert sorted(map(str, wh.fact_sessions().collect())) == sorted(map(str, sessions.fact_sessions(every, stamp).collect()))
    days = [r.day for r in session_days.touched_days(every.filter("event_id = 'late'")).collect()]
    text = plan(every.filter(F.col("event_date").isin(days) | F.col("event_date").isNull()))
    assert re.search(r"PushedFilters: \[Or\(EqualTo\(event_date", text)


def test_history_and_audit_take_few_shuffles(spark, large_tables):
    from tidemark.operators import erasure, history

    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    staged = history.stage_versions(spark.createDataFrame(Star(spark, FOLDER).customers().limit(5).collect(), Star(spark, FOLDER).customers().schema))
    assert _shuffles(history.build_history(staged, stamp)) <= 7
    star = Star(spark, FOLDER)
    plain = lambda df: spark.createDataFrame(df.limit(3).collect(), df.schema)
    layer = {n: plain(getattr(star, n)()) for n in ("customers", "orders", "payments", "returns")}
    layer["events"] = plain(star.events().drop("payload"))
    people = plain(star.suppressed()).select("customer_id")
    audit = erasure.audit_rows(layer, layer, plain(star.dim_customer()), people, people, "t", stamp, "r")
    assert _shuffles(audit) <= 19


def test_a_full_check_run_scans_every_table_once(spark, large_tables, tmp_path):
    from tidemark.functions.time import timestamp
    from tidemark.operators import quality

    star = Star(spark, FOLDER)
    made = {"customers": star.customers(), "orders": star.orders(), "payments": star.payments(), "returns": star.returns(),
            "fact_orders": star.fact_orders(), "fact_payments": star.fact_payments(), "fact_events": star.fact_events(),
            "dim_customer": star.dim_customer()}
    tables = {}
    for name, df in made.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # paths in full
    text = plan(quality.run_all(tables, tables, timestamp("2001-08-01 00:10:00"), stored={"orders": tables["orders"]}))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for name in made.keys() - {"dim_customer"}:
        assert len(re.findall(rf"FileScan[^\n]*{tmp_path.name}/{name}\]", text)) == 1, name
    assert text.count("Exchange hashpartitioning") <= 16


def test_a_small_batch_leaves_orders_and_the_dimension_unshuffled(spark, large_tables, monkeypatch):
    from tidemark.plans import serving

    orders = spark.range(300_000).select(F.col("id").cast("string").alias("order_id"), (F.col("id") % 999).cast("string").alias("customer_id"))
    batch = spark.createDataFrame([("7",), ("7",), ("x",), (None,)], "order_id string")
    seen = []
    keep = serving.cut_lineage
    monkeypatch.setattr(serving, "cut_lineage", lambda df: (seen.append(plan(df)), keep(df))[1])
    assert [r.customer_id for r in serving.named_by(batch, "order_id", orders).collect()] == ["7"]
    assert re.search(r"BroadcastHashJoin [^\n]*LeftSemi, BuildRight", seen[-1]) and "Exchange hashpartitioning" not in seen[-1]
    monkeypatch.setattr(serving, "SMALL_BATCH", 1)
    assert serving.named_by(batch, "order_id", orders).count() == 1
    assert "SortMergeJoin" in seen[-1] and "BroadcastHashJoin" not in seen[-1]


def test_a_first_build_meets_no_stored_rows_and_keeps_no_copies(spark, tmp_path, monkeypatch):
    from tidemark.plans import serving
    from tidemark.plans.warehouse import Warehouse
    from tidemark.sources import tables as stores
    from tidemark.sources.star import ORDERS_AS_OF
    from tidemark.sources.tables import BATCH

    star, wh = Star(spark, FOLDER), Warehouse(spark, str(tmp_path / "w"))
    clean = {n: getattr(star, n)() for n in ("customers", "products", "orders", "payments", "returns")}
    snap = wh.clean.snapshot()
    written = {n: wh.clean.write(n, df.withColumn(BATCH, F.lit(1)), 1) for n, df in clean.items()}
    wh.clean.publish(snap, written, {})
    refused = lambda *_: pytest.fail("a first build has no use for this")
    for place, name in ((serving, "change_images"), (serving, "cut_lineage"), (stores, "cut_lineage")):
        monkeypatch.setattr(place, name, refused)
    monkeypatch.setattr(serving, "SMALL_BATCH", 10)
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    result = serving.build_batch(wh, 1, stamp, ORDERS_AS_OF, days=None)
    assert result.updated == list(serving.BUILD_ORDER)
    for name in ("fact_orders", "fact_payments", "fact_returns"):
        want = getattr(facts, name)
        dim = wh.served.read("dim_customer")
        given = [clean["payments"], clean["orders"]] if name == "fact_payments" else [clean[name.removeprefix("fact_")]]
        assert sorted(map(str, wh.served.read(name).collect())) == sorted(map(str, want(*given, dim, stamp).collect()))


def test_partitions_are_written_without_drawing_ranges(spark, tmp_path, monkeypatch):
    from tidemark.sources.tables import Layout, SnapshotTables, month_of

    at = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))
    rows = spark.range(90).select((89 - F.col("id")).alias("k"), at.alias("at"), F.lit(1).cast("long").alias("_batch"))
    monkeypatch.setattr(type(rows), "repartitionByRange", lambda *_: pytest.fail("bounds are drawn by a run of their own"))
    tables = SnapshotTables(spark, str(tmp_path), {"t": rows.drop("_batch").schema}, {"t": Layout(part=month_of("at"), sort=("k",))})
    for folder in tables.write("t", rows, 1).values():
        for file in Path(folder).glob("*.parquet"):
            keys = [r.k for r in spark.read.parquet(str(file)).collect()]
            assert keys == sorted(keys) and keys


def test_new_rows_are_found_without_shuffling_a_large_target(spark):
    target = spark.range(1_000_000).select(F.col("id").cast("string").alias("k"))
    batch = spark.createDataFrame([("5",), ("new",)], "k string")
    found = insert_new(target, batch, ["k"])
    assert [r.k for r in found.collect()] == ["new"]
    text = plan(found)
    # The batch is the build side of the semi join; the target is streamed past it.
    assert re.search(r"BroadcastHashJoin \[k#\d+\], \[k#\d+\], LeftSemi, BuildRight", text)


def _rows_per_task(df) -> list[int]:
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.fixture
def eight_tasks(spark, large_tables):
    """Shuffles of eight partitions, left as they are."""
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.enabled")


def _clicks(spark, hot, n=40_000):
    """Events over a month, a third of them of one customer (or of none, for ``hot`` None)."""
    at = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))
    sk = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("bigint")).otherwise(F.col("id") % 5000 + 10)
    return spark.range(n).select(
        F.col("id").cast("string").alias("event_id"), at.alias("event_ts"), F.to_date(at).alias("event_date"),
        sk.alias("customer_sk"), sk.cast("string").alias("user_id"), F.lit(None).cast("string").alias("session_id"),
        F.lit("page_view").alias("event_name"), F.lit("web").alias("device_type"),
        F.lit(None).cast("string").alias("product_id"), at.alias("load_ts"),
    )


@pytest.mark.parametrize("hot", [7, None])
def test_sessions_of_a_hot_customer_are_spread(spark, eight_tasks, hot):
    tasks = _rows_per_task(sessions.computed_sessions(_clicks(spark, hot)))
    assert sum(tasks) == 40_000 and len(tasks) == 8
    assert max(tasks) < 1.5 * 40_000 / 8


def test_facts_without_a_person_are_spread(spark, eight_tasks):
    dim = Star(spark, FOLDER).dim_customer()
    clicks = _clicks(spark, None)
    assert max(_rows_per_task(as_of_customer(clicks.drop("customer_sk"), dim, "user_id", "event_ts"))) < 1.5 * 40_000 / 8
    nobody = spark.createDataFrame([("x",)], "user_id string")
    assert max(_rows_per_task(without(clicks, "user_id", nobody, "user_id"))) < 1.5 * 40_000 / 8
    assert max(_rows_per_task(left_join(clicks, nobody.withColumn("n", F.lit(1)), "user_id"))) < 1.5 * 40_000 / 8


def test_copies_of_a_hot_key_are_reduced_before_the_shuffle(spark, eight_tasks):
    rows = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    newest = latest_by_key(rows, ["k"], [F.desc("id")])
    assert newest.filter("k = 1").first().id == 29_997
    text = plan(newest)
    assert re.search(r"Exchange hashpartitioning\(k#[\s\S]*WindowGroupLimit \[k#.*Partial", text)


def test_a_long_history_is_walked_in_slices(spark, eight_tasks):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("at"), F.floor(F.col("id") / 500).alias("slice"), F.lit(1).alias("v"),
    )
    assert max(_rows_per_task(running_sum_sliced(rows, ["k"], "slice", ["at"], F.col("v"), "n"))) < 1.5 * 40_000 / 8
