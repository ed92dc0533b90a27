"""Both pipelines end to end on landed files, with results worked out by hand."""

import shutil
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions.time import timestamp
from tidemark.operators import recon, sales, sessions
from tidemark.plans.clean import merge_batch, merge_changes
from tidemark.plans.erase import UnknownPeopleError, erase_people, sweep_suppressed
from tidemark.plans.ingest import ingest_batch, ingest_events
from tidemark.plans.jobs import build_all, clean_tables, logged, merge_all, run_batch, run_events, served_tables
from tidemark.plans import views
from tidemark.plans.retention import expire
from tidemark.plans.serving import build_batch, rekey_facts
from tidemark.plans.warehouse import Warehouse

FIXTURES = Path(__file__).parent / "fixtures"
AS_OF = date(2026, 3, 8)


def now():
    return datetime(2026, 3, 8, 12, 0)


def land(source: str, target: Path, prefix: str = "") -> None:
    for file in (FIXTURES / source).iterdir():
        shutil.copy(file, target / f"{prefix}{file.name}")


def column(df, key, value):
    return {r[key]: r[value] for r in df.select(key, value).collect()}


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """The warehouse after the first batch and the first events."""
    root = tmp_path_factory.mktemp("warehouse")
    batch, events = root / "batch", root / "events"
    batch.mkdir()
    events.mkdir()
    wh = Warehouse(spark, str(root / "wh"), session_buckets=4)
    land("first", batch)
    shutil.copy(FIXTURES / "events" / "events_1.json", events)
    checks = column(run_batch(wh, str(batch), 1, now=now), "check_name", "status")
    run_events(wh, str(events), 1, now=now)
    return wh, batch, events, checks


def _recon(wh):
    s = served_tables(wh)
    return recon.reconcile(s["fact_orders"], s["fact_payments"], s["fact_returns"], AS_OF)


def test_first_load(world):
    wh, _, _, checks = world
    clean = clean_tables(wh)
    assert {n: df.count() for n, df in clean.items()} == {
        "customers": 3, "products": 2, "orders": 4, "payments": 4, "returns": 3, "events": 6,
    }
    assert wh.raw["customers"].rows().count() == 6
    assert [(r.order_id, r.rejected_columns, r.load_id) for r in wh.rejects["orders"].rows().collect()] == [
        ("B5", "subtotal", "orders.csv:5")
    ]
    assert wh.rejects["events"].rows().count() == 1
    quoted = clean["customers"].filter("customer_id = 'K3'").first()
    assert (quoted.first_name, quoted.phone) == ("Okafor, Jr", None)

    served = served_tables(wh)
    assert column(served["dim_customer"], "customer_id", "customer_sk") == {"K1": 1, "K2": 2, "K3": 3}
    assert column(served["fact_orders"], "order_id", "customer_sk") == {"B1": 1, "B2": None, "B3": 1, "B4": 3}
    assert column(served["fact_payments"], "payment_id", "customer_sk") == {"Y1": 1, "Y2": None, "Y3": None, "Y4": 1}
    assert column(served["fact_returns"], "return_id", "customer_sk") == {"V1": 1, "V2": 1, "V3": 2}

    status = {r.order_id: (r.recon_status, r.outstanding_balance, r.days_outstanding) for r in _recon(wh).collect()}
    assert status == {
        "B1": ("PAID_WITH_RETURN", D("0.00"), None),
        "B2": ("PARTIAL_PENDING", D("24.00"), 5),
        "B3": ("OVERPAID", D("-3.40"), None),
        "B4": ("NO_PAYMENT", D("10.80"), 3),
    }
    cash = {r.order_date.day: tuple(r)[1:7] for r in served["daily_sales_cash"].collect()}
    assert cash == {
        2: (1, D("110.00"), D("0.00"), D("110.00"), 0, D("110.00")),
        3: (1, D("54.00"), D("0.00"), D("54.00"), 0, D("54.00")),
        5: (2, D("37.40"), D("40.00"), D("-2.60"), 1, D("18.70")),
    }
    accrual = {r.order_date.day: tuple(r)[1:7] for r in served["daily_sales_accrual"].collect()}
    assert accrual == {
        2: (1, D("110.00"), D("40.00"), D("70.00"), 1, D("110.00")),
        3: (1, D("54.00"), D("10.00"), D("44.00"), 1, D("54.00")),
        5: (2, D("37.40"), D("0.00"), D("37.40"), 0, D("18.70")),
    }
    whole = sales.daily_sales_cash(
        served["fact_orders"], served["fact_returns"], AS_OF, timestamp(now()), include_refund_only_days=True
    )
    assert {r.order_date.day: (r.total_orders, r.net_revenue) for r in whole.collect()}[6] == (0, D("-10.00"))

    failed = {n for n, s in checks.items() if s != "PASS"}
    assert failed == {
        "orders_freshness_24h", "fact_orders_customer_sk_not_null", "event_volume_anomaly", "orders_with_no_payment",
    }
    assert checks["orders_with_no_payment"] == "WARN"


def test_first_sessions(world):
    """W3 is 18 minutes after a sourced event, W4 31 minutes after W3, W5 30 after W4; W6 is anonymous."""
    wh = world[0]
    computed = column(sessions.computed_sessions(wh.fact_events.rows()), "event_id", "effective_session_id")
    if len(computed) == 6:  # before the later events
        assert computed == {
            "W1": "Z1", "W2": "Z1", "W3": "COMPUTED_1_0", "W4": "COMPUTED_1_1", "W5": "COMPUTED_1_1", "W6": None,
        }
    rows = {r.session_id: r for r in wh.fact_sessions().collect()}
    assert set(rows) == {"Z1", "COMPUTED_1_0", "COMPUTED_1_1"}
    last = rows["COMPUTED_1_1"]
    assert (last.session_duration_sec, last.is_bounce, last.is_conversion, last.is_computed_session) == (1741, False, True, True)
    assert last.products_viewed == ["G1"]
    assert (rows["Z1"].session_duration_sec, rows["Z1"].page_views, rows["Z1"].product_views) == (90, 1, 1)
    assert rows["COMPUTED_1_0"].is_bounce


def test_nothing_new_changes_nothing(world):
    wh, batch, _, _ = world
    before = wh.clean.snapshot().version, wh.served.snapshot().version
    assert merge_batch(wh, 50, timestamp(now())) == []
    result = build_batch(wh, 50, timestamp(now()), AS_OF)
    assert result.message == "build_batch completed: No streams had data. No-op."
    assert (wh.clean.snapshot().version, wh.served.snapshot().version) == before


def test_views_for_consumers(world, spark):
    wh = world[0]
    names = views.create_views(wh, AS_OF, timestamp(now()), "analyst", "US_EAST")
    assert {"fact_orders", "dim_customer", "recon_summary", "conversion_funnel", "session_kpis", "dq_latest_status"} <= set(names)
    status = {r.order_id: r.recon_status for r in spark.sql("SELECT * FROM revenue_reconciliation").collect()}
    assert status == {"B1": "PAID_WITH_RETURN", "B2": "PARTIAL_PENDING", "B3": "OVERPAID", "B4": "NO_PAYMENT"}
    assert spark.sql("SELECT sum(order_count) FROM recon_summary").first()[0] == 4
    people = spark.table("dim_customer").collect()
    assert all(p.region == "US_EAST" and "*" in p.email for p in people)
    assert {p.customer_id for p in views.customers_for(wh, "admin").collect()} == {"K1", "K2", "K3"}
    assert spark.table("session_kpis").count() > 0 and spark.table("dq_summary").count() > 3
    assert spark.sql("SELECT count(*) FROM dq_latest_status").first()[0] == spark.table("dq_latest_status").select("check_name").distinct().count()
    for name in names:
        spark.catalog.dropTempView(name)


def test_late_batch_and_merging_event(world):
    wh, batch, events, _ = world
    land("late", batch)
    run_batch(wh, str(batch), 2, now=now)
    shutil.copy(FIXTURES / "events" / "events_2.json", events)
    run_events(wh, str(events), 2, now=now)

    payments = {r.payment_id: (r.status, r.amount) for r in clean_tables(wh)["payments"].collect()}
    assert payments["Y3"] == ("SETTLED", D("24.00"))
    assert payments["Y2"] == ("SETTLED", D("30.00")), "an older row never wins"
    assert {r.order_id: r.recon_status for r in _recon(wh).collect()}["B2"] == "PAID_WITH_RETURN"

    versions = served_tables(wh)["dim_customer"].filter("customer_id = 'K1'").orderBy("valid_from").collect()
    assert [(v.customer_sk, v.valid_from, v.valid_to, v.is_current, v.email) for v in versions] == [
        (1, datetime(2026, 3, 1, 9), datetime(2026, 3, 6, 9), False, "mira@shop.example"),
        (4, datetime(2026, 3, 6, 9), datetime(9999, 12, 31), True, "mira@new.example"),
    ]
    products = {r.product_id: (r.product_sk, r.name) for r in served_tables(wh)["dim_product"].collect()}
    assert products == {"G1": (1, "Lamp"), "G2": (2, "Wool rug"), "G3": (3, "Chair")}

    # W8 closes the gap between W3 and W4, so their sessions become one and none is left over.
    assert wh.fact_events.rows().count() == 7
    rows = {r.session_id: r for r in wh.fact_sessions().collect()}
    assert set(rows) == {"Z1", "COMPUTED_1_0"}
    assert (rows["COMPUTED_1_0"].page_views, rows["COMPUTED_1_0"].purchases) == (2, 1)


def test_rekey_fills_only_missing_keys(world):
    wh = world[0]
    before = column(served_tables(wh)["fact_orders"], "order_id", "customer_sk")
    rekey_facts(wh, 60, timestamp(now()))
    assert column(served_tables(wh)["fact_orders"], "order_id", "customer_sk") == before


def test_erasure_survives_a_reload(world, spark):
    wh, batch, events, _ = world
    ids = spark.createDataFrame([("K1",), ("  ",), (None,), ("stranger",)], "customer_id string")
    with pytest.raises(UnknownPeopleError):
        erase_people(wh, ids.filter("customer_id = 'stranger'"), "tester", 70, timestamp(now()))
    erase_people(wh, ids, "tester", 70, timestamp(now()), request_id="r")
    audit = [(r.layer, r.table_name, r.rows_affected) for r in wh.audit.rows().collect()]
    assert sorted(audit) == sorted(
        [
            ("BRONZE", "CUSTOMERS_RAW", 3), ("BRONZE", "ORDERS_RAW", 2), ("BRONZE", "PAYMENTS_RAW", 2),
            ("BRONZE", "RETURNS_RAW", 2), ("BRONZE", "EVENTS_RAW", 7),
            ("SILVER", "CUSTOMERS", 1), ("SILVER", "ORDERS", 2), ("SILVER", "PAYMENTS", 2),
            ("SILVER", "RETURNS", 2), ("SILVER", "EVENTS", 6),
            ("GOLD", "DIM_CUSTOMER", 2), ("UTIL", "GDPR_SUPPRESSION_LIST", 1), ("ALL", "ALL_TABLES", 0),
        ]
    )
    land("first", batch, "again_")
    land("late", batch, "again_")
    land("events", events, "again_")
    run_batch(wh, str(batch), 71, now=now)
    run_events(wh, str(events), 71, now=now)
    for layer in (clean_tables(wh), {n: log.rows() for n, log in wh.raw.items()}):
        for name in ("customers", "orders", "returns"):
            assert layer[name].filter("customer_id = 'K1'").isEmpty(), name
        assert layer["events"].filter("user_id = 'K1'").isEmpty()
        assert layer["payments"].filter("order_id in ('B1', 'B3')").isEmpty()
    people = served_tables(wh)["dim_customer"].filter("customer_id = 'K1'").collect()
    assert {(p.first_name, p.email, p.region) for p in people} == {("REDACTED", "REDACTED", "EU_WEST")}
    assert sorted(p.customer_sk for p in people) == [1, 4]


def test_superseded_folders_expire(world, spark):
    wh = world[0]
    before = {n: sorted(map(str, df.collect())) for n, df in {**clean_tables(wh), **served_tables(wh)}.items()}
    assert expire(wh, datetime(2001, 1, 1)) == []
    gone = expire(wh, datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(hours=1))
    assert gone and expire(wh, datetime.now() + timedelta(hours=1)) == []
    assert {n: sorted(map(str, df.collect())) for n, df in {**clean_tables(wh), **served_tables(wh)}.items()} == before
    for tables, name, column in ((wh.clean, "customers", "customer_id"), (wh.served, "dim_customer", "first_name")):
        every = spark.read.option("recursiveFileLookup", True).schema(tables.schemas[name]).parquet(f"{tables.root}/{name}")
        assert every.filter(F.col(column).isin("K1", "Mira")).isEmpty()


def test_a_payment_loaded_before_its_suppressed_order(world, spark):
    wh, batch, _, _ = world
    header, row = (FIXTURES / "first" / "payments.csv").read_text().splitlines()[:2]
    (batch / "early_payments.csv").write_text(f"{header}\n{row.replace('Y1,B1', 'Y9,B9')}\n")
    run_batch(wh, str(batch), 75, now=now)
    assert not clean_tables(wh)["payments"].filter("order_id = 'B9'").isEmpty()
    header, row = (FIXTURES / "first" / "orders.csv").read_text().splitlines()[:2]
    (batch / "tardy_orders.csv").write_text(f"{header}\n{row.replace('B1,', 'B9,', 1)}\n")
    run_batch(wh, str(batch), 76, now=now)
    sweep_suppressed(wh, 77)
    assert clean_tables(wh)["payments"].filter("order_id = 'B9'").isEmpty()
    assert wh.raw["payments"].rows().filter("order_id = 'B9'").isEmpty()
    assert clean_tables(wh)["payments"].count() == 2


def test_daily_sales_kept_by_changes_equal_a_rebuild(spark, tmp_path):
    """Batches with late, changed and very old rows; every publication equals daily sales of all rows."""
    from tidemark.schemas import ORDERS, RETURNS

    wh = Warehouse(spark, str(tmp_path))
    stamp = timestamp(now())
    day = lambda d: datetime(2023, 1, 1) + timedelta(days=d)

    def publish(orders, returns, n):
        snap, folders = wh.clean.snapshot(), {}
        for name, schema, key, rows in (("orders", ORDERS.clean, "order_id", orders), ("returns", RETURNS.clean, "return_id", returns)):
            if rows:
                df = spark.createDataFrame(rows, schema)
                folders[name] = wh.clean.rewrite(name, df, [key], snap, snap.next, lambda s, b, k=key: merge_changes(s, b, k, snap.next))
        wh.clean.publish(snap, folders, {})
        build_batch(wh, n, stamp, AS_OF, days=None)

    def order(i, d, total, n=0):
        return (f"o{i}", "c", day(d), "x", D(1), D(1), D(1), None if total is None else D(total), "p", day(n), "f", day(n))

    def back(i, o, d, amount, status="APPROVED", n=0):
        return (f"r{i}", f"o{o}", "c", day(d), "why", D(amount), status, day(n), "f", day(n))

    batches = [
        ([order(i, i % 5, 10 * i) for i in range(12)], [back(i, i, 900 + i % 3, 5) for i in range(4)]),
        ([order(3, 400, 7, 1), order(20, 2, None, 1)], [back(9, 5, 950, 3, n=1), back(1, 1, 901, 5, "REJECTED", n=1)]),
        ([], [back(10, 0, 1100, 2, n=2), back(11, 99, 1100, 2, n=2)]),
        ([order(99, 1000, 4, 3), order(0, 0, 1, 3)], []),
    ]
    for n, (orders, returns) in enumerate(batches):
        publish(orders, returns, n)
        s = served_tables(wh)
        for basis, build in (("cash", sales.daily_sales_cash), ("accrual", sales.daily_sales_accrual)):
            want = build(s["fact_orders"], s["fact_returns"], AS_OF, stamp, days=None)
            assert sorted(map(str, s[f"daily_sales_{basis}"].collect())) == sorted(map(str, want.collect())), (n, basis)


def test_jobs_that_end_together_are_all_logged(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))

    def work(n):
        logged(wh, f"TASK_{n}", n, lambda: f"done {n}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(4)))
    with pytest.raises(ZeroDivisionError):
        logged(wh, "TASK_BAD", 9, lambda: 1 / 0)
    assert sorted((r.name, r.state) for r in wh.run_log.rows().collect()) == [
        *[(f"TASK_{n}", "SUCCEEDED") for n in range(4)], ("TASK_BAD", "FAILED"),
    ]


def test_merge_and_build_by_one_call_each(spark, tmp_path):
    batch, events = tmp_path / "batch", tmp_path / "events"
    batch.mkdir()
    events.mkdir()
    wh = Warehouse(spark, str(tmp_path / "wh"), session_buckets=2)
    land("first", batch)
    shutil.copy(FIXTURES / "events" / "events_1.json", events)
    ingest_batch(wh, str(batch), lambda: timestamp(now()), files_per_batch=1)
    ingest_events(wh, str(events), lambda: timestamp(now()))
    merge_all(wh, 1, now)
    build_all(wh, 1, AS_OF, now)
    assert {r.session_id for r in wh.fact_sessions().collect()} == {"Z1", "COMPUTED_1_0", "COMPUTED_1_1"}
    assert wh.served.read("fact_orders").count() == 4
    logged_names = [r.name for r in wh.run_log.rows().collect()]
    assert {"MERGE_SILVER_EVENTS_MICRO_BATCH", "BUILD_GOLD_EVENTS_MICRO_BATCH", "BUILD_GOLD_BATCH"} <= set(logged_names)


def test_a_request_id_used_again_for_other_people(world, spark):
    wh = world[0]
    ids = lambda *who: spark.createDataFrame([(w,) for w in who], "customer_id string")
    for who in (("K2",), ("K2", "K3"), ("K2", "K3")):
        erase_people(wh, ids(*who), "tester", 90, timestamp(now()), request_id="again")
    listed = {r.customer_id for r in wh.suppressed.rows().collect()}
    assert {"K2", "K3"} <= listed
    entries = wh.audit.rows().filter("request_id = 'again'").groupBy("customer_id").count().collect()
    assert {r.customer_id: r["count"] for r in entries} == {"K2": 13, "K3": 13}


def test_no_events_yet(spark, tmp_path):
    (tmp_path / "events").mkdir()
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run_events(wh, str(tmp_path / "events"), 1, now=now)
    assert wh.run_log.rows().count() == 1


def test_failed_merge_publishes_nothing(world, spark, monkeypatch):
    wh, batch, _, _ = world
    land("late", batch, "third_")
    before = wh.clean.snapshot()
    from tidemark.plans import ingest

    ingest.ingest_batch(wh, str(batch), lambda: timestamp(now()))
    original = wh.clean.rewrite

    def fail_on_products(name, *args):
        if name == "products":
            raise RuntimeError("disk full")
        return original(name, *args)

    monkeypatch.setattr(wh.clean, "rewrite", fail_on_products)
    with pytest.raises(RuntimeError):
        merge_batch(wh, 80, timestamp(now()))
    assert wh.clean.snapshot() == before
    failure = wh.check_results.rows().filter("check_name = 'merge_silver_batch_execution'").first()
    assert (failure.status, failure.observed_value) == ("FAIL", "disk full")


def test_run_log(world):
    wh = world[0]
    names = {r.name for r in wh.run_log.rows().filter("state = 'SUCCEEDED'").collect()}
    assert names == {
        "TASK_INGEST_BATCH", "TASK_MERGE_SILVER_BATCH", "TASK_BUILD_GOLD_BATCH", "TASK_DQ_CHECKS",
        "TASK_INGEST_EVENTS", "TASK_MERGE_SILVER_EVENTS", "TASK_BUILD_GOLD_EVENTS",
        "TASK_MERGE_SILVER_EVENTS_MICRO_BATCH", "TASK_BUILD_GOLD_EVENTS_MICRO_BATCH",
    }
