"""Registered queries. Each runs an operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expressions import change_hash
from tidemark.functions.time import timestamp
from tidemark.operators import erasure, facts, governance, history, quality, recon, sales, session_days, sessions, suppression
from tidemark.operators.asof import as_of_customer, as_of_merged
from tidemark.operators.changes import change_images
from tidemark.operators.cleaning import clean_rows
from tidemark.operators.joins import left_join
from tidemark.operators.keys import assign_keys
from tidemark.operators.latest import latest_by_key, post_images, snapshot_as_of
from tidemark.operators.upsert import guarded_merge, guarded_upsert, insert_new, overwrite_by_key, updated_or_loaded
from tidemark.plans import views
from tidemark.plans.clean import merge_batch
from tidemark.plans.erase import record_request
from tidemark.plans.ingest import ingest_feed
from tidemark.plans.jobs import logged
from tidemark.plans.serving import build_batch, build_events, side_by_side
from tidemark.plans.warehouse import Warehouse
from tidemark.schemas import EVENTS, FACT_EVENTS, FACT_ORDERS, FEEDS, ORDERS, conform
from tidemark.sources import landing
from tidemark.sources.id_index import IdIndex
from tidemark.sources.scratch import new_folder
from tidemark.sources.star import EVENTS_AS_OF, ORDERS_AS_OF, RUN_TS, Star
from tidemark.sources.tables import BATCH, AppendLog, Layout, write_parquet
from tidemark.streaming import bounded

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Clocks of the reports, inside the range of the data they look back on.
CHECK_CLOCK = "2001-08-01 00:10:00"
EVENT_CLOCK = "2024-01-30 12:00:00"
SNAPSHOT_AT = "1998-07-01 00:00:00"
SPLIT_AT = "2024-01-20 00:00:00"


def register(function: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """Register ``function(star)`` under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: function(Star(spark, folder))
    return function


def _run_ts():
    return timestamp(RUN_TS)


def _text_payload(events: DataFrame) -> DataFrame:
    # A variant has no order, so results carry the one value it holds as text.
    return events.withColumn("payload", F.try_variant_get("payload", "$.product_id", "string"))


def _late_orders(star: Star) -> DataFrame:
    """The newest of each order's later copies, as a batch that arrives after the order."""
    late = star.raw_orders().filter("source_file <> 'orders-0.csv'")
    nobody = star.suppressed().filter("1 = 0")
    return clean_rows(late, ORDERS, nobody, nobody.withColumnRenamed("customer_id", "order_id"))


# --- keys, deduplication, upserts ---------------------------------------------------------------


@register
def dedup_latest(star):
    lines = star.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    newest = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]
    return latest_by_key(lines, ["l_orderkey", "l_linenumber"], newest)


@register
def clean_orders(star):
    suppressed_orders = suppression.orders_of(star.orders(), star.suppressed())
    return clean_rows(star.raw_orders(), ORDERS, star.suppressed(), suppressed_orders)


@register
def upsert_guarded(star):
    return guarded_upsert(star.orders(), _late_orders(star), ["order_id"], updated_or_loaded)


@register
def upsert_guarded_changes(star):
    merged = guarded_merge(star.orders(), _late_orders(star), ["order_id"], updated_or_loaded)
    return merged.filter("_changed").select("order_id", "status", "updated_at", "load_ts")


def _order_batch(star: Star) -> DataFrame:
    number = F.col("order_id").cast("bigint")
    changed = star.orders().filter(number % 3 != 2)
    return changed.withColumn("order_id", F.when(number % 3 == 1, F.concat(F.lit("N"), "order_id")).otherwise(F.col("order_id"))).withColumn(
        "status", F.lit("BATCH")
    )


@register
def upsert_overwrite(star):
    return overwrite_by_key(star.orders(), _order_batch(star), ["order_id"])


def _events_twice(star: Star) -> DataFrame:
    """Raw events in which every event occurs twice, the second time loaded a day later."""
    copies = star.events().withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = copies.withColumns(
        {
            "ingestion_ts": F.col("load_ts") + F.make_dt_interval(F.col("n")),
            "source_file": F.concat(F.lit("events-"), F.col("n").cast("string"), F.lit(".json")),
            "load_id": F.concat(F.lit("events-"), F.col("n").cast("string"), F.lit(".json:"), "event_id"),
        }
    )
    return conform(rows, EVENTS.raw)


@register
def insert_only_dedup(star):
    """Append to the events before a point in time everything new, from raw rows with repeats."""
    stored = star.events().filter(F.col("event_ts") < timestamp(SPLIT_AT))
    nobody = star.suppressed().filter("1 = 0")
    batch = clean_rows(_events_twice(star), EVENTS, nobody, nobody)
    return _text_payload(insert_new(stored, batch, ["event_id"]).select(*EVENTS.clean.fieldNames()))


@register
def insert_only_indexed(star):
    """The same through an index of ids, opened only at the prefixes that the batch has."""
    index = IdIndex(star.spark, new_folder(star.spark, "ids"), "event_id", prefixes=16)
    index.add(star.events().filter(F.col("event_ts") < timestamp(SPLIT_AT)), 0)
    nobody = star.suppressed().filter("1 = 0")
    batch = clean_rows(_events_twice(star), EVENTS, nobody, nobody)
    return _text_payload(index.unseen(batch).select(*EVENTS.clean.fieldNames()))


@register
def change_images_orders(star):
    """What changed between the orders and a later state: every third gone, some changed, some new."""
    number = F.col("order_id").cast("bigint")
    later = star.orders().filter(number % 3 != 0).withColumns(
        {
            "status": F.when(number % 3 == 1, F.lit("CHANGED")).otherwise(F.col("status")),
            "total": F.when(number % 5 == 0, F.lit(None)).otherwise(F.col("total")),
        }
    )
    added = star.orders().filter(number % 7 == 0).withColumn("order_id", F.concat(F.lit("N"), "order_id"))
    return change_images(star.orders(), later.unionByName(added), ["order_id"])


@register
def merge_change_images(star):
    """Orders merged with change images of which the old ones and the deletions are passed over."""
    number = F.col("order_id").cast("bigint")
    later = star.orders().filter(number % 3 != 0).withColumn("status", F.when(number % 3 == 1, "CHANGED").otherwise(F.col("status")))
    images = post_images(change_images(star.orders(), later, ["order_id"]), "order_id")
    return overwrite_by_key(star.orders(), images, ["order_id"])


@register
def clean_events(star):
    batch = clean_rows(_events_twice(star), EVENTS, star.suppressed(), star.suppressed())
    return _text_payload(batch)


@register
def surrogate_keys(star):
    return assign_keys(star.orders().select("order_id", "customer_id"), ["order_id"], "order_sk")


@register
def snapshot_as_of_orders(star):
    versions = star.raw_orders().select("order_id", "status", "ingestion_ts")
    return snapshot_as_of(versions, ["order_id"], "ingestion_ts", timestamp(SNAPSHOT_AT))


# --- dimensions -----------------------------------------------------------------------------------


@register
def change_hashes(star):
    return star.customer_versions().select("customer_id", "v", change_hash(history.TRACKED).alias("hash_diff"))


@register
def scd2_build(star):
    """History of a change log in which every version is stated twice."""
    stated = star.customer_versions().drop("v")
    again = stated.withColumn("updated_at", F.col("updated_at") + F.expr("interval 100 days"))
    return history.build_history(history.stage_versions(stated.unionByName(again)), _run_ts())


def _first_versions(star: Star) -> DataFrame:
    """The dimension as it was after each customer's first version, three in four customers known."""
    known = star.dim_customer().filter((F.col("customer_sk") % 10 == 0) & (F.col("customer_id").cast("bigint") % 4 != 0))
    return known.withColumns({"valid_to": timestamp("9999-12-31 00:00:00"), "is_current": F.lit(True)})


def _without_keys(dim: DataFrame) -> DataFrame:
    return dim.drop("customer_sk")


@register
def scd2_close(star):
    return _without_keys(history.close_versions(_first_versions(star), history.stage_versions(star.customers()), _run_ts()))


@register
def scd2_open(star):
    return history.open_versions(_first_versions(star), history.stage_versions(star.customers()), _run_ts())


@register
def scd2_apply_batch(star):
    return history.apply_versions(_first_versions(star), history.stage_versions(star.customers()), _run_ts())


@register
def scd2_first_from_created(star):
    staged = history.stage_versions(star.customers(), first_version_from="created_at")
    return history.open_versions(_first_versions(star), staged, _run_ts())


@register
def scd2_rehash(star):
    """Hashes recomputed over a dimension whose suppressed people are redacted."""
    dim = erasure.anonymise(star.dim_customer(), star.suppressed(), _run_ts()).withColumn(
        "hash_diff", F.when(F.col("first_name") == history.REDACTED, F.col("hash_diff")).otherwise("old")
    )
    return history.rehash(dim).select("customer_id", "valid_from", "hash_diff")


@register
def dim_product_type1(star):
    known = star.products().withColumn("product_sk", F.substring("product_id", 2, 20).cast("bigint")).filter("product_sk % 2 = 0")
    dim = known.withColumn("name", F.lit("old")).select(
        "product_sk", "product_id", "sku", "name", "category", "price", "currency", "record_source", "load_ts"
    )
    return history.overwrite_products(dim, star.products(), _run_ts())


# --- point-in-time joins and facts ----------------------------------------------------------------


@register
def asof_orders(star):
    return as_of_customer(star.orders().select("order_id", "customer_id", "order_ts"), star.dim_customer(), "customer_id", "order_ts")


@register
def asof_payments(star):
    payer = star.orders().select("order_id", "customer_id")
    paid = left_join(star.payments().select("payment_id", "order_id", "payment_ts"), payer, "order_id")
    return as_of_customer(paid, star.dim_customer(), "customer_id", "payment_ts")


@register
def asof_returns(star):
    returned = star.returns().select("return_id", "customer_id", "return_ts")
    return as_of_customer(returned, star.dim_customer(), "customer_id", "return_ts")


@register
def asof_events(star):
    return as_of_customer(star.events().select("event_id", "user_id", "event_ts"), star.dim_customer(), "user_id", "event_ts")


@register
def asof_merged_orders(star):
    return as_of_merged(star.orders().select("order_id", "customer_id", "order_ts"), star.dim_customer(), "customer_id", "order_ts")


@register
def asof_merged_returns(star):
    returned = star.returns().select("return_id", "customer_id", "return_ts")
    return as_of_merged(returned, star.dim_customer(), "customer_id", "return_ts")


@register
def asof_merged_payments(star):
    """Payment facts by the lookup for long histories."""
    return facts.fact_payments(star.payments(), star.orders(), star.dim_customer(), _run_ts(), as_of_merged)


@register
def asof_merged_events(star):
    return as_of_merged(star.events().select("event_id", "user_id", "event_ts"), star.dim_customer(), "user_id", "event_ts")


@register
def fact_orders(star):
    return facts.fact_orders(star.orders(), star.dim_customer(), _run_ts())


@register
def fact_payments(star):
    return facts.fact_payments(star.payments(), star.orders(), star.dim_customer(), _run_ts())


@register
def fact_returns(star):
    return facts.fact_returns(star.returns(), star.dim_customer(), _run_ts())


@register
def fact_events(star):
    return facts.fact_events(star.events(), star.dim_customer(), _run_ts())


@register
def rekey_orders(star):
    """Order facts built before most customers arrived, keyed again once all are known."""
    early = star.dim_customer().filter(F.col("customer_id").cast("bigint") % 2 == 0)
    built = facts.fact_orders(star.orders(), early, _run_ts())
    fresh = facts.fact_orders(star.orders(), star.dim_customer(), _run_ts())
    return facts.rekey(built, "order_id", fresh).select("order_id", "customer_sk")


# --- sessions -------------------------------------------------------------------------------------


@register
def sessions_computed(star):
    return sessions.computed_sessions(star.fact_events())


def _joined_products(df: DataFrame) -> DataFrame:
    return df.withColumn("products_viewed", F.array_join("products_viewed", ","))


@register
def fact_sessions(star):
    return _joined_products(sessions.fact_sessions(star.fact_events(), _run_ts()))


@register
def fact_sessions_incremental(star):
    """Sessions of the earlier events, refreshed with the later ones."""
    events = star.fact_events()
    earlier, later = events.filter(F.col("event_ts") < timestamp(SPLIT_AT)), events.filter(F.col("event_ts") >= timestamp(SPLIT_AT))
    stored = session_days.day_parts(earlier, _run_ts())
    parts = session_days.redo_days(stored, events, session_days.touched_days(later), _run_ts())
    return _joined_products(session_days.fold_days(parts))


@register
def session_day_parts(star):
    """What each session had of each day, with the day's own numbering."""
    parts = session_days.day_parts(star.fact_events(), _run_ts())
    return parts.withColumn("products", F.array_join("products", ","))


@register
def conversion_funnel(star):
    return sessions.conversion_funnel(sessions.session_steps(star.fact_events()))


@register
def conversion_funnel_sourced(star):
    return sessions.conversion_funnel(sessions.session_steps(star.fact_events(), sourced_only=True))


@register
def session_kpis(star):
    return sessions.session_kpis(sessions.fact_sessions(star.fact_events(), _run_ts()))


@register
def session_windows(star):
    return bounded.session_windows(star.events().filter("user_id is not null"))


# --- sales and reconciliation ---------------------------------------------------------------------


@register
def daily_sales_cash(star):
    return sales.daily_sales_cash(star.fact_orders(), star.fact_returns(), ORDERS_AS_OF, _run_ts(), days=None)


@register
def daily_sales_cash_recent(star):
    return sales.daily_sales_cash(star.fact_orders(), star.fact_returns(), ORDERS_AS_OF, _run_ts())


@register
def daily_sales_cash_all_days(star):
    return sales.daily_sales_cash(
        star.fact_orders(), star.fact_returns(), ORDERS_AS_OF, _run_ts(), days=None, include_refund_only_days=True
    )


@register
def daily_sales_accrual(star):
    return sales.daily_sales_accrual(star.fact_orders(), star.fact_returns(), ORDERS_AS_OF, _run_ts(), days=None)


@register
def daily_sales_accrual_recent(star):
    return sales.daily_sales_accrual(star.fact_orders(), star.fact_returns(), ORDERS_AS_OF, _run_ts())


def _sales_by_deltas(star: Star, accrual: bool) -> DataFrame:
    """Daily sales of an earlier state, brought up to date by the changes since: late, changed and withdrawn rows."""
    orders, returns = star.fact_orders(), star.fact_returns()
    number = F.col("order_id").try_cast("bigint")
    was = orders.filter(number % 7 != 0).withColumns(
        {
            "order_date": F.when(number % 5 == 0, F.date_sub("order_date", 3)).otherwise(F.col("order_date")),
            "total": F.when(number % 4 == 0, F.lit(None)).otherwise(F.col("total")),
        }
    )
    gone = orders.filter(number % 11 == 0).withColumn("order_id", F.concat(F.lit("W"), "order_id"))
    before = was.unionByName(gone), returns.filter(number % 3 != 0).withColumn(
        "status", F.when(number % 2 == 0, F.lit("REJECTED")).otherwise(F.col("status"))
    )
    after = orders, returns
    images = [change_images(old, new, [key]) for old, new, key in zip(before, after, ("order_id", "return_id"))]
    sums = sales.sales_sums(*before, accrual)
    return sales.daily_from_sums(sales.add_sums(sums, sales.sales_delta(*images, accrual, before, after)), _run_ts())


@register
def daily_sales_cash_deltas(star):
    return _sales_by_deltas(star, accrual=False)


@register
def daily_sales_accrual_deltas(star):
    return _sales_by_deltas(star, accrual=True)


@register
def payment_totals(star):
    return recon.payment_totals(star.fact_payments())


@register
def return_totals(star):
    return recon.return_totals(star.fact_returns())


def _reconciled(star: Star) -> DataFrame:
    return recon.reconcile(star.fact_orders(), star.fact_payments(), star.fact_returns(), ORDERS_AS_OF)


@register
def revenue_reconciliation(star):
    return _reconciled(star)


@register
def recon_summary(star):
    return recon.by_value(recon.summarise(_reconciled(star)))


# --- checks ---------------------------------------------------------------------------------------


def _clock():
    return timestamp(CHECK_CLOCK)


CHECKS: dict[str, Callable[[Star], DataFrame]] = {
    "orders_row_count": lambda s: quality.check_orders(s.orders(), _clock()),
    "orders_freshness_24h": lambda s: quality.check_orders(s.orders(), _clock()),
    "orders_customer_id_not_null": lambda s: quality.check_orders(s.orders(), _clock()),
    "orders_unique_order_id": lambda s: quality.check_orders(s.raw_orders(), _clock()),
    "orders_customer_fk": lambda s: quality.check_orders_customer(
        s.orders(), suppression.purge(s.customers(), "customer_id", s.suppressed(), "customer_id"), _clock()
    ),
    "payments_order_fk": lambda s: quality.check_payments_order(
        s.payments(), suppression.purge(s.orders(), "customer_id", s.suppressed(), "customer_id"), _clock()
    ),
    "returns_order_fk": lambda s: quality.check_returns_order(
        s.returns(), suppression.purge(s.orders(), "customer_id", s.suppressed(), "customer_id"), _clock()
    ),
    "returns_refund_not_exceeding_order": lambda s: quality.check_refund_size(s.returns(), s.orders(), _clock()),
    "orders_with_no_payment": lambda s: quality.check_unpaid_orders(s.orders(), s.payments(), _clock()),
    "gold_fact_orders_row_count": lambda s: quality.check_fact_orders(s.fact_orders(), _clock()),
    "fact_orders_customer_sk_not_null": lambda s: quality.check_fact_orders(
        facts.fact_orders(s.orders(), s.dim_customer().filter("is_current"), _run_ts()), _clock()
    ),
    "payment_amount_range": lambda s: quality.check_amounts(s.fact_payments(), _clock()),
    "event_volume_anomaly": lambda s: quality.check_event_volume(s.fact_events(), timestamp(EVENT_CLOCK)),
    "gold_silver_order_count_recon": lambda s: quality.check_layer_counts(
        s.orders(), suppression.purge(s.fact_orders(), "order_id", s.orders().filter("status = 'P'"), "order_id"), _clock()
    ),
    "dim_customer_scd2_no_overlap": lambda s: quality.check_overlap(_overlapping(s), _clock()),
    "gold_events_unique_event_id": lambda s: quality.check_event_ids(conform(_served_twice(s), FACT_EVENTS), _clock()),
}


def _overlapping(star: Star) -> DataFrame:
    """The dimension with the versions of every fifth customer ending 800 days late."""
    late = (F.col("customer_id").cast("bigint") % 5 == 0) & ~F.col("is_current")
    return star.dim_customer().withColumn(
        "valid_to", F.when(late, F.col("valid_to") + F.expr("interval 800 days")).otherwise(F.col("valid_to"))
    )


def _served_twice(star: Star) -> DataFrame:
    events = star.fact_events()
    return events.unionByName(events.filter("event_name = 'purchase'"))


def _check(name: str) -> Query:
    return lambda spark, folder: CHECKS[name](Star(spark, folder)).filter(F.col("check_name") == name)


for _name in CHECKS:
    QUERIES[f"dq_{_name}"] = _check(_name)


@register
def dq_feed_staleness(star):
    """Feeds by order priority, each pending since its oldest order."""
    pending = star.orders().groupBy(F.col("payment_method").alias("feed")).agg(F.max("load_ts").alias("oldest"))
    return quality.check_feeds(pending, "bronze", timestamp("2001-08-11 00:00:00"))


@register
def dq_run_all(star):
    clean = {
        "customers": star.customers(),
        "products": star.products(),
        "orders": star.orders(),
        "payments": star.payments(),
        "returns": star.returns(),
        "events": star.events(),
    }
    served = {
        "fact_orders": star.fact_orders(),
        "fact_payments": star.fact_payments(),
        "fact_events": star.fact_events(),
        "dim_customer": star.dim_customer(),
    }
    raw = {name: _as_raw(df, name) for name, df in clean.items()} | {"orders": star.raw_orders()}
    oldest = [df.agg(F.min("load_ts").alias("oldest")).withColumn("feed", F.lit(name)) for name, df in clean.items()]
    waiting = reduce(DataFrame.unionByName, oldest)
    pending = {
        layer: waiting.withColumn("feed", F.concat("feed", F.lit(ending)))
        for layer, ending in (("bronze", "_raw_stream"), ("silver", "_stream"))
    }
    return quality.run_all(clean, served, _clock(), raw=raw, pending=pending)


def _as_raw(clean: DataFrame, name: str) -> DataFrame:
    """Clean rows with the lineage columns of a raw table."""
    lineage = [F.col("load_ts").alias("ingestion_ts"), F.col("record_source").alias("source_file"), F.lit("1").alias("load_id")]
    return clean.select(*FEEDS[name].columns, *lineage)


def _drifted(star: Star, layer: str) -> DataFrame:
    """Checks of stored tables, one of which has lost a column and one gained one since they were declared."""
    tables = {"orders": star.orders(), "payments": star.payments(), "returns": star.returns()}
    found = {}
    for name, df in tables.items():
        df = _as_raw(df, name) if layer == "bronze" else df
        df = df.drop("provider") if name == "payments" else df.withColumn("extra", F.lit(1)) if name == "returns" else df
        log = AppendLog(star.spark, new_folder(star.spark, "drift"), df.schema)
        log.append(df, 0)
        found[name] = AppendLog(star.spark, log.path, FEEDS[name].raw if layer == "bronze" else FEEDS[name].clean).stored()
    return quality.check_schemas(found, layer, _clock())


@register
def dq_schema_drift_bronze(star):
    return _drifted(star, "bronze")


@register
def dq_schema_drift_silver(star):
    return _drifted(star, "silver")


@register
def dq_failures(star):
    return quality.failures(star.check_log())


@register
def dq_latest_results(star):
    return quality.latest_results(star.check_log())


@register
def dq_trend(star):
    return quality.failure_trend(star.check_log(), _clock())


@register
def dq_latest(star):
    return quality.latest_status(star.check_log())


@register
def dq_summary(star):
    return quality.summary(star.check_log())


@register
def dq_alert(star):
    return quality.alert(star.check_log(), _clock(), minutes=60 * 24 * 7)


@register
def job_run_log(star):
    """The log that four jobs left which ran at the same time; each counts a table, and one fails."""
    wh = Warehouse(star.spark, new_folder(star.spark, "runs"))

    def work(name: str) -> None:
        def count() -> str:
            n = star.table(name).count()
            if name == "region":
                raise RuntimeError(f"{n} rows are too few")
            return f"{n} rows"

        with suppress(RuntimeError):
            logged(wh, f"TASK_{name.upper()}", 1, count)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, ("orders", "customer", "events", "region")))
    return wh.run_log.rows().select("name", "state", "run_id", "message", "error_message")


@register
def recent_runs(star):
    return quality.recent_runs(star.run_log(), timestamp(EVENT_CLOCK)).drop("message")


# --- governance and erasure -----------------------------------------------------------------------


@register
def mask_analyst(star):
    return governance.masked_view(star.dim_customer(), "analyst")


@register
def mask_admin(star):
    return governance.masked_view(star.dim_customer(), "admin")


@register
def region_filter(star):
    view = governance.masked_view(star.dim_customer(), "analyst")
    return governance.region_view(view, "analyst", "EUROPE", tags=("AMERICA", "ASIA", "EUROPE", "ALL"))


def _layer(star: Star) -> dict[str, DataFrame]:
    return {
        "customers": star.customers(),
        "orders": star.orders(),
        "payments": star.payments(),
        "returns": star.returns(),
        "events": star.events(),
    }


@register
def suppression_filter(star):
    return suppression.not_in(star.events(), "user_id", star.suppressed(), "customer_id").select("event_id", "user_id")


@register
def suppression_filter_empty(star):
    nobody = star.suppressed().filter("customer_id = ''")
    return suppression.not_in(star.events(), "user_id", nobody, "customer_id").select("event_id", "user_id")


@register
def suppression_payments(star):
    listed = suppression.orders_of(star.orders(), star.suppressed())
    return suppression.not_in(star.payments(), "order_id", listed, "order_id")


@register
def purge_raw_payments(star):
    feeds = {"orders": star.orders(), "payments": star.payments()}
    earlier = star.orders().select("order_id").filter("1 = 0")
    return suppression.purge_feeds(feeds, star.suppressed(), earlier)["payments"]


@register
def erase_silver(star):
    """What is left of each clean table, as row counts and sums that any leak would change."""
    kept = erasure.erase(_layer(star), star.suppressed())
    parts = [
        kept["customers"].agg(F.count("*").alias("kept"), F.countDistinct("customer_id").alias("ids")),
        kept["orders"].agg(F.count("*").alias("kept"), F.countDistinct("order_id").alias("ids")),
        kept["payments"].agg(F.count("*").alias("kept"), F.countDistinct("payment_id").alias("ids")),
        kept["returns"].agg(F.count("*").alias("kept"), F.countDistinct("return_id").alias("ids")),
        kept["events"].agg(F.count("*").alias("kept"), F.countDistinct("event_id").alias("ids")),
    ]
    named = [p.withColumn("feed", F.lit(n)) for n, p in zip(("customers", "orders", "payments", "returns", "events"), parts)]
    result = named[0]
    for part in named[1:]:
        result = result.unionByName(part)
    return result


@register
def erase_orders(star):
    return erasure.erase(_layer(star), star.suppressed())["orders"]


@register
def erase_payments(star):
    return erasure.erase(_layer(star), star.suppressed())["payments"]


@register
def erase_dim(star):
    return erasure.anonymise(star.dim_customer(), star.suppressed(), _run_ts())


@register
def erase_audit(star):
    layer = _layer(star)
    people = erasure.requests(star.suppressed())
    listed = star.suppressed().filter("cast(customer_id as bigint) % 2 = 0")
    rows = erasure.audit_rows(layer, layer, star.dim_customer(), listed, people, "tester", _run_ts(), request_id="r1")
    return rows


@register
def suppression_list(star):
    listed = star.suppressed().filter("cast(customer_id as bigint) % 2 = 0")
    return erasure.suppression_rows(listed, star.suppressed(), "tester", _run_ts())


@register
def erase_replay(star):
    """Who is on the list and in the audit after a request came three times under one id: for some, for all, for all again."""
    wh = Warehouse(star.spark, new_folder(star.spark, "replay"))
    layer, dim = _layer(star), star.dim_customer()
    people = erasure.requests(star.suppressed())
    for asked in (people.filter("cast(customer_id as bigint) % 2 = 0"), people, people):
        fresh = erasure.not_audited(asked, wh.audit.rows(), "r1")
        audit = erasure.audit_rows(layer, layer, dim, wh.suppressed.rows(), fresh, "tester", _run_ts(), "r1")
        record_request(wh, asked, suppression.orders_of(star.orders(), asked), audit, "tester", _run_ts(), "r1")
    entries = wh.audit.rows().groupBy("customer_id").agg(
        F.count("*").alias("entries"), F.sum("rows_affected").alias("rows_affected")
    )
    listed = wh.suppressed.rows().groupBy("customer_id").agg(F.count("*").alias("listed"))
    return listed.join(entries, "customer_id", "full_outer")


@register
def erase_found(star):
    """Requested people who are known, from a request list with blanks and strangers."""
    asked = star.suppressed().withColumn("n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    asked = asked.withColumn(
        "customer_id", F.when(F.col("n") == 0, F.col("customer_id")).when(F.col("n") == 1, F.lit(" ")).otherwise(
            F.concat(F.lit("X"), "customer_id"))
    )
    people = erasure.requests(asked)
    return erasure.found_in(people, star.customers(), star.customers(), star.dim_customer())


# --- jobs over a warehouse --------------------------------------------------------------------------


def _built_warehouse(star: Star) -> Warehouse:
    """A warehouse whose clean tables hold the star's feeds, served by the batch job."""
    wh = Warehouse(star.spark, new_folder(star.spark, "warehouse"))
    snap = wh.clean.snapshot()
    clean = {"customers": star.customers(), "products": star.products(), **{n: t for n, t in _layer(star).items() if n in ("orders", "payments", "returns")}}
    folders = {}

    def write(name: str, df: DataFrame) -> None:
        folders[name] = wh.clean.write(name, df.withColumn(BATCH, F.lit(snap.next)), snap.next)

    side_by_side(*[partial(write, name, df) for name, df in clean.items()])
    wh.clean.publish(snap, folders, {})
    build_batch(wh, 1, _run_ts(), ORDERS_AS_OF, days=None)
    return wh


@register
def job_daily_sales(star):
    """Daily sales on both bases as the batch job leaves them."""
    wh = _built_warehouse(star)
    parts = [wh.served.read(f"daily_sales_{basis}").withColumn("basis", F.lit(basis)) for basis in ("cash", "accrual")]
    return parts[0].unionByName(parts[1])


@register
def job_recon_summary(star):
    """The reconciliation summary that consumers see after the batch job."""
    return views.recon_summary(_built_warehouse(star), ORDERS_AS_OF)


@register
def job_merge_orders(star):
    """Clean orders after the merge job ran over a first load and then over all later copies."""
    wh = Warehouse(star.spark, new_folder(star.spark, "warehouse"))
    raw = star.raw_orders()
    for batch, rows in enumerate((raw.filter("source_file = 'orders-0.csv'"), raw.filter("source_file <> 'orders-0.csv'"))):
        wh.raw["orders"].append(rows, batch)
        merge_batch(wh, batch, _run_ts())
    return wh.clean.read("orders")


@register
def job_sessions(star):
    """Sessions after the events job served the earlier events and then the later ones."""
    wh = Warehouse(star.spark, new_folder(star.spark, "warehouse"), session_buckets=8)
    snap, dim = wh.served.snapshot(), star.dim_customer()
    wh.served.publish(snap, {"dim_customer": wh.served.write("dim_customer", dim.withColumn(BATCH, F.lit(snap.next)), snap.next)}, {})
    early = F.col("event_ts") < timestamp(SPLIT_AT)
    for batch, rows in enumerate((star.events().filter(early), star.events().filter(~early))):
        build_events(wh, rows, batch, _run_ts())
    return _joined_products(wh.fact_sessions())


# --- files and layouts ----------------------------------------------------------------------------


@register
def csv_ingest_orders(star):
    """Orders written as CSV files and loaded back with types, rejects and lineage."""
    folder = new_folder(star.spark, "csv")
    stamp = "yyyy-MM-dd'T'HH:mm:ss"
    text = star.orders().select(
        *[F.date_format(c, stamp).alias(c) if c in ("order_ts", "updated_at") else F.col(c).cast("string") for c in ORDERS.columns]
    )
    broken = F.when(F.col("order_id").endswith("9"), F.concat("total", F.lit("x"))).otherwise(F.col("total"))
    gone = F.when(F.col("order_id").endswith("8"), F.lit("NULL")).otherwise(F.col("payment_method"))
    text.withColumns({"total": broken, "payment_method": gone}).write.option("header", True).csv(f"{folder}/orders.csv")
    rows, _ = landing.load_csv(landing.read_csv_text(star.spark, f"{folder}/orders.csv", _any_file(ORDERS)), ORDERS, _run_ts())
    return rows.select(*ORDERS.columns, "ingestion_ts")


@register
def csv_rejects(star):
    """Rows of the same kind of file that a cast would have emptied."""
    folder = new_folder(star.spark, "csv")
    text = star.orders().select(*[F.col(c).cast("string") for c in ORDERS.columns])
    text.select("order_id", "customer_id", F.lit("yesterday").alias("order_ts"), *ORDERS.columns[3:9], F.lit("").alias("updated_at")) \
        .write.option("header", True).csv(f"{folder}/orders.csv")
    _, bad = landing.load_csv(landing.read_csv_text(star.spark, f"{folder}/orders.csv", _any_file(ORDERS)), ORDERS, _run_ts())
    return bad.select("order_id", "order_ts", "total", "rejected_columns")


@register
def csv_row_numbers(star):
    """Row numbers within each landed file run from 1 to the file's row count."""
    folder = new_folder(star.spark, "csv")
    star.orders().select("order_id").write.option("header", True).csv(f"{folder}/orders.csv")
    text = landing.read_csv_text(star.spark, f"{folder}/orders.csv", _any_file(ORDERS))
    numbered = landing.file_row_numbers(text).groupBy("_file").agg(
        F.count("*").alias("n"), F.count_distinct("_row").alias("d"), F.min("_row").alias("lo"), F.max("_row").alias("hi")
    )
    sound = (F.col("n") == F.col("d")) & (F.col("lo") == 1) & (F.col("hi") == F.col("n"))
    return numbered.agg(F.sum("n").alias("order_rows"), F.bool_and(sound).alias("dense"))


@register
def csv_ingest_in_batches(star):
    """Ten order files loaded three at a time by a query that stops when all are in; with the number of micro-batches."""
    root = new_folder(star.spark, "batches")
    stamp = "yyyy-MM-dd'T'HH:mm:ss"
    text = star.orders().select(
        *[F.date_format(c, stamp).alias(c) if c in ("order_ts", "updated_at") else F.col(c).cast("string") for c in ORDERS.columns]
    )
    text.repartition(10).write.option("header", True).csv(f"{root}/landing")
    wh = Warehouse(star.spark, f"{root}/warehouse")
    ingest_feed(wh, f"{root}/landing", _any_file(ORDERS), _run_ts, files_per_batch=3).awaitTermination()
    batches = wh.raw["orders"].read().select(BATCH).distinct().count()
    return wh.raw["orders"].rows().select(*ORDERS.columns, "ingestion_ts", F.lit(batches).alias("batches"))


@register
def json_ingest_events(star):
    """Events written as JSON lines and loaded back by key path."""
    folder = new_folder(star.spark, "json")
    star.events().select(
        "event_id", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_ts"), "user_id", "session_id",
        "event_name", "device_type",
        F.struct(F.try_variant_get("payload", "$.product_id", "string").alias("product_id")).alias("payload"),
    ).write.json(f"{folder}/events.json")
    rows, _ = landing.load_json(landing.read_json_variant(star.spark, f"{folder}/events.json", _any_file(EVENTS)), EVENTS, _run_ts())
    return _text_payload(rows.select(*EVENTS.columns, "ingestion_ts"))


def _any_file(feed):
    return replace(feed, file_glob="part-*")


@register
def stream_ingest_events(star):
    """Event files delivered by a streaming query that remembers what it loaded, run twice."""
    folder = new_folder(star.spark, "stream")
    schema = star.table("events").schema
    for _ in range(2):
        stream = star.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(star.folder)
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/checkpoint"
        ).trigger(availableNow=True).start()
        query.awaitTermination()
    return star.spark.read.schema(schema).parquet(f"{folder}/out").select("event_id", "ts", "user_id", "event_type")


@register
def stream_dedup_events(star):
    """Repeats of an event id dropped by a streaming query with bounded state."""
    folder = new_folder(star.spark, "stream")
    _events_twice(star).select("event_id", "event_ts").write.parquet(f"{folder}/in")
    stream = star.spark.readStream.schema("event_id string, event_ts timestamp_ntz").parquet(f"{folder}/in")
    once = bounded.dedup_within(stream, delay="60 days").select("event_id", "event_ts")
    query = once.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    return star.spark.read.schema("event_id string, event_ts timestamp_ntz").parquet(f"{folder}/out")


@register
def dated_layout_orders(star):
    """Order facts written by month and sorted by date, read back for one quarter."""
    folder = new_folder(star.spark, "layout")
    month = F.date_format("order_date", "yyyy-MM")
    layout = Layout(sort=("order_date", "order_id"), bloom=("order_id",))
    write_parquet(star.fact_orders().withColumn("order_month", month), folder, layout, ["order_month"])
    stored = star.spark.read.schema(T.StructType([*FACT_ORDERS.fields, T.StructField("order_month", T.StringType())])).parquet(folder)
    return stored.filter(F.col("order_month").between("1998-01", "1998-03"))
