"""Checks: statuses at their edges, and pair counting against brute force."""

import random
from datetime import date, datetime, timedelta

from tidemark.functions.time import timestamp
from tidemark.operators import quality
from tidemark.schemas import CHECK_RESULTS, DIM_CUSTOMER, FACT_EVENTS, FEEDS, ORDERS

NOON = datetime(2026, 3, 8, 12, 0)
def clock():
    return timestamp(NOON)

T0 = datetime(2026, 1, 1)


def dim(spark, rows):
    full = [(sk, c, None, None, None, None, None, f, t, True, "h", "s", T0) for sk, c, f, t in rows]
    return spark.createDataFrame(full, DIM_CUSTOMER)


def test_overlaps_match_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for sk in range(300):
        start = T0 + timedelta(days=rng.randrange(200))
        length = rng.choice([0, 0, 5, 30, 90, -10])  # empty and backward versions too
        rows.append((sk, rng.choice("aaab"), start, start + timedelta(days=length)))
    expected = sum(
        a[1] == b[1] and a[2] < b[3] and b[2] < a[3] for i, a in enumerate(rows) for b in rows[i + 1 :]
    )
    assert expected > 0
    assert quality.overlapping_versions(dim(spark, rows)).first().n == expected
    assert quality.check_overlap(dim(spark, rows), clock()).first().status == "FAIL"
    assert quality.overlapping_versions(dim(spark, [])).first().n == 0


def volume(spark, counts):
    rows = [
        (f"{d}-{i}", NOON, date(2026, 3, 8) - timedelta(days=d), 1, None, "x", "y", None, NOON)
        for d, n in counts.items()
        for i in range(n)
    ]
    row = quality.check_event_volume(spark.createDataFrame(rows, FACT_EVENTS), clock()).first()
    return row.status, row.observed_value, row.expected_value


def test_event_volume(spark):
    assert volume(spark, {0: 6, 1: 4, 3: 4}) == ("PASS", "6", "4 (7d avg ± 50%)"), "days without events do not count"
    assert volume(spark, {0: 7, 1: 4, 7: 4, 8: 100})[0] == "FAIL"
    assert volume(spark, {1: 5}) == ("FAIL", "0", "5 (7d avg ± 50%)")
    assert volume(spark, {0: 5}) == ("FAIL", "5", None)
    assert volume(spark, {})[:2] == ("FAIL", "0")


def test_orphans_are_counted_row_by_row(spark):
    orders = spark.createDataFrame(
        [("1", "a"), ("2", "x"), ("3", "x"), ("4", None), ("5", None)], "order_id string, customer_id string"
    )
    customers = spark.createDataFrame([("a",)], "customer_id string")
    row = quality.check_orders_customer(orders, customers, clock()).first()
    assert (row.status, row.observed_value) == ("FAIL", "4")
    assert quality.check_orders_customer(orders.filter("customer_id = 'a'"), customers, clock()).first().observed_value == "0"


def test_layer_counts(spark):
    def status(clean, served):
        return quality.check_layer_counts(spark.range(clean), spark.range(served), clock()).first().status

    assert [status(0, 0), status(0, 3), status(100, 99), status(100, 98), status(100, 101)] == ["PASS", "WARN", "PASS", "FAIL", "PASS"]


def test_empty_orders(spark):
    rows = quality.check_orders(spark.createDataFrame([], ORDERS.clean), clock()).collect()
    assert {r.check_name: r.status for r in rows} == {
        "orders_row_count": "FAIL", "orders_freshness_24h": "FAIL",
        "orders_customer_id_not_null": "PASS", "orders_unique_order_id": "PASS",
    }
    assert next(r for r in rows if r.check_name == "orders_freshness_24h").observed_value == "NULL"


def test_freshness_counts_hour_boundaries(spark):
    def status(at):
        row = ("o", "c", at, None, None, None, None, None, None, None, None, None)
        checks = quality.check_orders(spark.createDataFrame([row], ORDERS.clean), clock())
        return checks.filter("check_name = 'orders_freshness_24h'").first().status

    assert status(datetime(2026, 3, 7, 12, 0)) == "PASS"
    assert status(datetime(2026, 3, 7, 11, 59)) == "FAIL"


def test_feed_staleness(spark):
    pending = spark.createDataFrame(
        [("ORDERS_STREAM", datetime(2026, 3, 1, 11, 59)), ("EVENTS_STREAM", datetime(2026, 3, 1, 12, 0)), ("IDLE", None)],
        "feed string, oldest timestamp_ntz",
    )
    rows = {r.check_name: (r.status, r.observed_value) for r in quality.check_feeds(pending, "silver", clock()).collect()}
    assert rows == {
        "stream_staleness_silver_orders_stream": ("FAIL", "2026-03-08 11:59:00"),
        "stream_staleness_silver_events_stream": ("PASS", "2026-03-08 12:00:00"),
        "stream_staleness_silver_idle": ("PASS", "N/A"),
    }


def test_schema_drift(spark):
    assert quality.expected_columns("bronze") == {
        "customers": 11, "products": 11, "orders": 13, "payments": 10, "returns": 11, "events": 10,
    }
    assert quality.expected_columns("silver") == {
        "customers": 10, "products": 10, "orders": 12, "payments": 9, "returns": 10, "events": 9,
    }
    tables = {n: spark.createDataFrame([], f.clean) for n, f in FEEDS.items()}
    tables["orders"] = tables["orders"].drop("tax")
    failed = quality.check_schemas(tables, "silver", clock()).filter("status = 'FAIL'").collect()
    assert [(r.check_name, r.observed_value, r.expected_value) for r in failed] == [("schema_drift_silver_orders", "11", "12")]


def results(spark):
    row = lambda n, s, at: (n, s, "1", "0", "d", at)
    return spark.createDataFrame(
        [
            row("a_fk", "FAIL", NOON - timedelta(minutes=15)),
            row("b_volume", "FAIL", NOON - timedelta(minutes=1)),
            row("b_volume", "PASS", NOON - timedelta(days=1)),
            row("scd2_x", "FAIL", NOON - timedelta(minutes=16)),
            row("scd2_x", "WARN", NOON - timedelta(days=7, hours=12)),
            row("old", "FAIL", NOON - timedelta(days=9)),
        ],
        CHECK_RESULTS,
    )


def test_alert(spark):
    row = quality.alert(results(spark), clock()).first()
    assert (row.fire, row.message) == (True, "a_fk: d (observed=1)\nb_volume: d (observed=1)")
    assert quality.should_alert(results(spark), clock())
    later = timestamp(NOON + timedelta(hours=1))
    quiet = quality.alert(results(spark), later).first()
    assert (quiet.fire, quiet.message) == (False, None)
    assert not quality.should_alert(results(spark), later)


def test_reports(spark):
    log = results(spark)
    assert quality.failures(log).count() == 4
    trend = {(r.check_name, r.check_date): r.failure_rate_pct for r in quality.failure_trend(log, clock()).collect()}
    assert ("old", date(2026, 2, 27)) not in trend
    assert trend["b_volume", date(2026, 3, 7)] == 0.0 and trend["b_volume", date(2026, 3, 8)] == 100.0
    latest = {r.check_name: r.status for r in quality.latest_status(log).collect()}
    assert latest == {"a_fk": "FAIL", "b_volume": "FAIL", "scd2_x": "FAIL", "old": "FAIL"}
    headings = {r.check_category: r.total_checks for r in quality.summary(log).collect()}
    assert headings == {"Referential Integrity": 1, "Freshness & Volume": 1, "Dimension Integrity": 1, "Data Quality": 1}
    assert [r.check_name for r in quality.latest_results(log, 2).collect()] == ["b_volume", "a_fk"]


def _key_tables(spark, seed):
    """Four tables with missing, null and repeated keys, null amounts, and two order facts."""
    rng = random.Random(seed)
    some = lambda n, *more: rng.choice([str(rng.randrange(n)), *more])
    cents = lambda: rng.choice([None, *(rng.randrange(0, 900) / 100 for _ in range(9))])
    make = lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3)
    clean = {
        "customers": make([(some(12, None),) for _ in range(9)], "customer_id string"),
        "orders": make(
            [(some(40, None), some(14, None), NOON - timedelta(hours=rng.randrange(50)), cents()) for _ in range(60)],
            "order_id string, customer_id string, order_ts timestamp_ntz, total double",
        ).selectExpr("order_id", "customer_id", "order_ts", "cast(total as decimal(10,2)) total"),
        "payments": make([(some(99, None), some(50, None)) for _ in range(70)], "payment_id string, order_id string"),
        "returns": make([(some(50, None), cents()) for _ in range(90)], "order_id string, refund_amount double").selectExpr(
            "order_id", "cast(refund_amount as decimal(10,2)) refund_amount"
        ),
    }
    served = {
        "fact_orders": make([(rng.choice([1, None]),) for _ in range(rng.choice([60, 61, 90]))], "customer_sk long"),
        "fact_payments": make([(rng.choice([-1.0, 5.0, None, 1e6]),) for _ in range(20)], "amount double"),
    }
    return clean, served


def _statuses(df):
    return sorted((r.check_name, r.status, r.observed_value, r.expected_value, r.details, r.check_ts) for r in df.collect())


def test_masks_answer_what_each_check_answers(spark):
    cases = [_key_tables(spark, seed) for seed in (1, 2)]
    empty = tuple({n: df.limit(0) for n, df in tables.items()} for tables in cases[0])
    for clean, served in [*cases, empty]:
        orders, payments, returns, facts = clean["orders"], clean["payments"], clean["returns"], served["fact_orders"]
        alone = [
            quality.check_orders(orders, clock()), quality.check_orders_customer(orders, clean["customers"], clock()),
            quality.check_payments_order(payments, orders, clock()), quality.check_returns_order(returns, orders, clock()),
            quality.check_refund_size(returns, orders, clock()), quality.check_unpaid_orders(orders, payments, clock()),
            quality.check_fact_orders(facts, clock()), quality.check_amounts(served["fact_payments"], clock()),
            quality.check_layer_counts(orders, facts, clock()),
        ]
        want = sorted(row for df in alone for row in _statuses(df))
        assert _statuses(quality.check_presence(clean, served, clock())) == want and len(want) == 13


def test_event_checks_in_one_pass(spark):
    for counts in ({0: 6, 1: 4, 3: 4}, {0: 7, 1: 4, 7: 4, 8: 100}, {1: 5}, {0: 5}, {}):
        rows = [
            (f"{d}-{i % 5}", NOON, date(2026, 3, 8) - timedelta(days=d), 1, None, "x", "y", None, NOON)
            for d, n in counts.items() for i in range(n)
        ]
        events = spark.createDataFrame(rows, FACT_EVENTS)
        want = _statuses(quality.check_event_volume(events, clock())) + _statuses(quality.check_event_ids(events, clock()))
        assert _statuses(quality.check_events(events, clock())) == sorted(want)
