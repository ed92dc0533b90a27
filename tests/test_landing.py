"""Landed files: types, null tokens, rejects, row numbers, layouts."""

import glob
import gzip
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.time import minutes_between, timestamp
from tidemark.schemas import EVENTS, FEEDS, ORDERS, PAYMENTS
from tidemark.sources import landing
from tidemark.sources.scratch import cut_lineage, new_folder
from tidemark.sources.tables import AppendLog, Layout, SnapshotTables, month_of, write_parquet

HEADER = ",".join(ORDERS.columns)


def load_orders(spark, folder):
    return landing.load_csv(landing.read_csv_text(spark, str(folder), ORDERS), ORDERS, timestamp("2026-03-01 00:00:00"))


def test_odd_rows(spark, tmp_path):
    (tmp_path / "my_orders.csv").write_text(
        "\n".join(
            [
                "whatever,names,the,header,has",
                'A,C1,2026-02-06T10:05:00,"on, ""hold""",1.005,NULL,null,2,CARD,2026-02-06T12:00:00,extra,cells',
                "B,C1,2026-02-06T10:05:00",
                "C,C1,2026-02-30T10:05:00,S,1,1,1,1,CARD,",
                "D,C1,2026-02-06 10:05:00,S,1,1,1,1,CARD,",
                "E,C1,,S,1,1,1,12345678901,CARD,",
                ",C1,,S,,,,,,",
            ]
        )
    )
    rows, bad = load_orders(spark, tmp_path)
    got = {r.load_id: r for r in rows.collect()}
    assert set(got) == {f"my_orders.csv:{n}" for n in (1, 2, 6)}
    a, b = got["my_orders.csv:1"], got["my_orders.csv:2"]
    assert (a.status, a.subtotal, a.tax, a.shipping, a.total) == ('on, "hold"', Decimal("1.01"), None, None, Decimal("2.00"))
    assert (b.status, b.total, b.updated_at) == (None, None, None)
    assert got["my_orders.csv:6"].order_id is None
    assert {r.order_id: r.rejected_columns for r in bad.collect()} == {"C": "order_ts", "D": "order_ts", "E": "total"}
    assert rows.schema.fieldNames() == ORDERS.raw.fieldNames()
    assert [f.dataType for f in rows.schema] == [f.dataType for f in ORDERS.raw]


def test_files_are_chosen_by_pattern(spark, tmp_path):
    line = "Y,B,2026-02-06T10:05:00,1,SETTLED,P,\n"
    (tmp_path / "payments.csv").write_text("h\n" + line)
    (tmp_path / "late_arriving_payments.csv").write_text("h\n" + line)
    with gzip.open(tmp_path / "payments_2.csv.gz", "wt") as f:
        f.write("h\n" + line)
    (tmp_path / "orders.csv").write_text("h\n" + line)
    found = landing.read_csv_text(spark, str(tmp_path), PAYMENTS)
    assert {r._file for r in found.collect()} == {"payments.csv", "late_arriving_payments.csv", "payments_2.csv.gz"}


def test_row_numbers_of_a_file_read_in_many_blocks(spark, tmp_path):
    n = 20_000
    (tmp_path / "orders.csv").write_text(HEADER + "\n" + "".join(f"{i},C,,,,,,,,\n" for i in range(1, n + 1)))
    (tmp_path / "orders_small.csv").write_text(HEADER + "\n1,C,,,,,,,,\n2,C,,,,,,,,\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        text = landing.read_csv_text(spark, str(tmp_path), ORDERS)
        assert text.select("_file", "_block").distinct().count() > 5
        assert landing.file_row_numbers(text).filter("cast(order_id as bigint) <> _row").isEmpty()
        assert landing.file_row_numbers(text).count() == n + 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_lines(spark, tmp_path):
    (tmp_path / "events.json").write_text(
        "\n".join(
            [
                '{"event_id":"1","event_ts":"2026-02-08T10:01:00","user_id":"C","payload":{"product_id":"P","n":{"x":[1]}},"new_key":5}',
                '{"event_id":2,"event_ts":null,"user_id":null}',
                '{"event_id":"3","event_ts":"soon"}',
            ]
        )
    )
    lines = landing.read_json_variant(spark, str(tmp_path), EVENTS)
    rows, bad = landing.load_json(lines, EVENTS, timestamp("2026-03-01 00:00:00"))
    got = {r.event_id: r for r in rows.withColumn("payload", F.to_json("payload")).collect()}
    assert set(got) == {"1", "2"}
    assert got["1"].event_ts == datetime(2026, 2, 8, 10, 1)
    assert got["1"].payload == '{"n":{"x":[1]},"product_id":"P"}'
    assert (got["2"].event_ts, got["2"].payload) == (None, None)
    assert bad.count() == 1


def test_minutes_are_boundaries_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        row = spark.range(1).select(
            minutes_between(timestamp("2026-03-08 01:59:59"), timestamp("2026-03-08 03:00:00")).alias("spring"),
            minutes_between(timestamp("2026-01-01 10:00:59"), timestamp("2026-01-01 10:31:01")).alias("edge"),
            minutes_between(timestamp("1969-12-31 23:59:30"), timestamp("1970-01-01 00:00:00")).alias("epoch"),
        ).first()
        assert tuple(row) == (61, 31, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("feed", FEEDS.values(), ids=FEEDS.keys())
def test_keys_are_business_columns(feed):
    assert feed.key in feed.columns
    assert feed.person_column is None or feed.person_column in feed.columns


def test_append_log_replaces_a_replayed_batch(spark, tmp_path):
    ids = lambda n: spark.range(n).select(F.col("id").cast("string"))
    log = AppendLog(spark, str(tmp_path / "log"), ids(0).schema)
    assert log.last_batch() is None and log.rows().count() == 0
    log.append(ids(3), 0)
    log.append(ids(5), 1)
    log.append(ids(4), 1)
    assert (log.last_batch(), log.rows().count(), log.read(after=0).count()) == (1, 7, 4)
    gone = spark.createDataFrame([("0",), ("1",), ("2",)], "id string")
    assert log.remove(gone, "id", str(tmp_path / "spare")) == [0, 1]
    assert [tuple(r) for r in log.read().collect()] == [("3", 1)]


def test_snapshots_rewrite_only_touched_months(spark, tmp_path):
    schema = "k string, at timestamp_ntz"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    tables = SnapshotTables(spark, str(tmp_path), {"t": frame([]).schema}, {"t": Layout(part=month_of("at"), sort=("k",))})
    stamp = lambda df, b: df.withColumn("_batch", F.lit(b).cast("bigint"))
    jan, feb, mar = datetime(2026, 1, 5), datetime(2026, 2, 5), datetime(2026, 3, 5)
    snap = tables.snapshot()
    first = tables.write("t", stamp(frame([("a", jan), ("b", feb), ("c", None)]), 1), 1)
    snap = tables.publish(snap, {"t": first}, {"src": 4})
    assert tables.snapshot() == snap and snap.consumed == {"src": 4}
    assert set(first) == {"2026-01", "2026-02", "undated"}

    moved = stamp(frame([("a", mar)]), 2)  # moves from January to March
    merge = lambda stored, source: stored.join(source.select("k"), "k", "left_anti").unionByName(source)
    listed = tables.rewrite("t", moved, ["k"], snap, 2, merge)
    assert set(listed) == {"2026-02", "2026-03", "undated"}
    assert listed["2026-02"] == first["2026-02"], "an untouched month keeps its folder"
    assert tables.read("t", snap).filter("k = 'a'").first().at == jan, "readers of the old listing are undisturbed"
    new = tables.publish(snap, {"t": listed}, {})
    assert {r.k for r in tables.read("t", since="2026-03").collect()} == {"a", "c"}
    assert [r.k for r in tables.changes("t", new, after=1).collect()] == ["a"]
    assert tables.changes("t", new, after=None).count() == 3


def test_layout_is_sorted_and_has_lookup_filters(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(20_000).select(F.col("id").cast("string").alias("user_id"), (F.col("id") % 7).alias("day"))
    write_parquet(rows, str(tmp_path / "t"), Layout(sort=("day", "user_id"), bloom=("user_id",)))
    files = glob.glob(str(tmp_path / "t" / "*.parquet"))
    spans = []
    for file in files:
        days = pq.read_table(file, columns=["day"])["day"].to_pylist()
        assert days == sorted(days)
        spans.append((days[0], days[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])), "files hold consecutive ranges"
    plain = str(tmp_path / "plain")
    write_parquet(rows, plain, Layout(sort=("day", "user_id")))
    size = lambda p: sum(len(open(f, "rb").read()) for f in glob.glob(p + "/*.parquet"))
    assert size(str(tmp_path / "t")) > size(plain), "the lookup filter is stored"


def test_lineage_is_cut_in_the_shared_folder(spark):
    df = cut_lineage(spark.range(10).repartition(3))
    assert df.count() == 10
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_a_keyed_append_is_never_replaced(spark, tmp_path):
    ids = lambda n: spark.range(n).select(F.col("id").cast("string"))
    log = AppendLog(spark, str(tmp_path / "log"), ids(0).schema)
    log.append_once(ids(3), "request-1")
    log.append_once(ids(0), "request-1")
    log.append_once(ids(2), "request-2")
    log.append(ids(1), 0)
    assert log.rows().count() == 6


def test_a_repeated_run_leaves_published_folders_alone(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "k string, _batch long")
    tables = SnapshotTables(spark, str(tmp_path), {"t": frame([]).select("k").schema}, {})
    first = tables.snapshot()
    published = tables.publish(first, {"t": tables.write("t", frame([("a", 1), ("b", 1)]), first.next)}, {})
    tables.write("t", frame([("c", 1)]), first.next)  # a run under the same number that fails before it publishes
    assert {r.k for r in tables.read("t").collect()} == {"a", "b"}
    assert published.next > first.next


def test_stored_columns_are_the_files_own(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "id string, extra int")
    log = AppendLog(spark, str(tmp_path / "log"), rows.select("id").schema)
    AppendLog(spark, log.path, rows.schema).append(rows, 0)
    assert log.rows().columns == ["id"] and log.stored().columns == ["id", "extra"]


def test_old_files_and_equal_names_are_loaded(spark, tmp_path):
    import os

    from tidemark.plans.ingest import ingest_feed
    from tidemark.plans.warehouse import Warehouse

    feed, landing_folder = FEEDS["products"], tmp_path / "landing"
    header = ",".join(feed.columns)
    cells = ",".join(["P{n}", "s", "n", "c", "1.50", "USD", "2026-01-01T00:00:00", "2026-01-01T00:00:00"])

    def land_file(day: str, first: int, age_days: int) -> None:
        path = landing_folder / day / "products.csv"
        path.parent.mkdir(parents=True)
        path.write_text("\n".join([header, *(cells.format(n=first + k) for k in range(3))]) + "\n")
        stamp = path.stat().st_mtime - age_days * 86_400
        os.utime(path, (stamp, stamp))

    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    clock = lambda: timestamp("2026-03-08 12:00:00")
    land_file("dt=1", 0, 0)
    ingest_feed(wh, str(landing_folder), feed, clock).awaitTermination()
    land_file("dt=2", 10, 30)
    ingest_feed(wh, str(landing_folder), feed, clock).awaitTermination()
    assert wh.rejects["products"].rows().collect() == []
    rows = wh.raw["products"].rows().select("product_id", "load_id").collect()
    assert {r.product_id for r in rows} == {f"P{n}" for n in (0, 1, 2, 10, 11, 12)}
    assert len({r.load_id for r in rows}) == 6
