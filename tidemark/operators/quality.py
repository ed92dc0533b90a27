"""Data-quality checks. Every check yields rows of one result schema.

Checks on the same table share one aggregation, so a full run scans each table
once per grouping instead of once per check.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import ratio_pct, rounded_mean
from tidemark.functions.time import hours_between
from tidemark.operators.latest import latest_by_key
from tidemark.operators.sliced import running_sum_sliced
from tidemark.schemas import CHECK_RESULTS, FEEDS, conform

# Limits of the checks.
FRESH_HOURS = 24
AMOUNT_MIN, AMOUNT_MAX = 0, 100000
VOLUME_DAYS, VOLUME_TOLERANCE = 7, 0.5
COUNT_TOLERANCE = 0.01
FEED_RETENTION_DAYS = 7
TREND_DAYS = 7
ALERT_MINUTES = 15

# Expected value and explanation of each check, as they appear in results.
TEXT = {
    "orders_row_count": ("> 0", "SILVER.ORDERS should not be empty"),
    "orders_freshness_24h": ("max(order_ts) within 24 hours", "Detect stale ingestion"),
    "orders_customer_id_not_null": ("0", "Customer IDs must be populated"),
    "orders_unique_order_id": ("count == distinct(order_id)", "Detect duplicate order IDs"),
    "orders_customer_fk": ("0", "Orders must have existing customers"),
    "payments_order_fk": ("0", "Payments must map to existing orders"),
    "returns_order_fk": ("0", "Returns must map to existing orders"),
    "returns_refund_not_exceeding_order": ("0", "Refund amount should not exceed order total"),
    "orders_with_no_payment": ("0", "Orders should have at least one payment"),
    "gold_fact_orders_row_count": ("> 0", "GOLD.FACT_ORDERS should not be empty"),
    "fact_orders_customer_sk_not_null": (
        "0",
        "FACT_ORDERS should have no NULL customer_sk (dimension lookup failure)",
    ),
    "payment_amount_range": (
        "0 (all amounts in 0-100000 range)",
        "Payments outside valid range (0 to 100,000) may indicate data corruption",
    ),
    "event_volume_anomaly": (None, "Event volume deviation > 50% from 7-day rolling average"),
    "gold_silver_order_count_recon": ("Counts within 1% tolerance", "Silver vs Gold order count reconciliation"),
    "dim_customer_scd2_no_overlap": (
        "0",
        "DIM_CUSTOMER SCD2 records should have non-overlapping valid_from/valid_to per customer_id",
    ),
    "gold_events_unique_event_id": (
        "count == distinct(event_id)",
        "GOLD.FACT_EVENTS should have no duplicate event_ids",
    ),
}


def verdict(ok: Column, otherwise: str = "FAIL") -> Column:
    """PASS where ``ok`` holds; false and null do not."""
    return F.when(ok, "PASS").otherwise(otherwise)


def _result(name: str, status: Column, observed: Column, expected: Column | None = None) -> Column:
    fixed, details = TEXT[name]
    return F.struct(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        observed.cast("string").alias("observed_value"),
        (F.lit(fixed) if expected is None else expected).alias("expected_value"),
        F.lit(details).alias("details"),
    )


def _rows(measured: DataFrame, results: Sequence[Column], clock: Column) -> DataFrame:
    stacked = measured.select(F.explode(F.array(*results)).alias("r")).select("r.*", clock.alias("check_ts"))
    return conform(stacked, CHECK_RESULTS)


# --- clean layer -----------------------------------------------------------------------------


def check_orders(orders: DataFrame, clock: Column) -> DataFrame:
    """Row count, freshness, customer ids and key uniqueness of clean orders, in one pass."""
    measured = orders.agg(
        F.count("*").alias("n"),
        F.max("order_ts").alias("newest"),
        F.count_if(F.col("customer_id").isNull()).alias("no_customer"),
        F.count_distinct("order_id").alias("ids"),
    )
    return _rows(measured, _order_results(clock), clock)


def _order_results(clock: Column) -> list[Column]:
    n, age = F.col("n"), hours_between("newest", clock)
    return [
        _result("orders_row_count", verdict(n > 0), n),
        _result("orders_freshness_24h", verdict(age <= FRESH_HOURS), F.coalesce(F.col("newest").cast("string"), F.lit("NULL"))),
        _result("orders_customer_id_not_null", verdict(F.col("no_customer") == 0), F.col("no_customer")),
        _result("orders_unique_order_id", verdict(n == F.col("ids")), n),
    ]


def _count_is_zero(
    name: str, offending: DataFrame, clock: Column, otherwise: str = "FAIL", count: Column | None = None
) -> DataFrame:
    n = F.col("n")
    counted = offending.agg((F.count("*") if count is None else F.coalesce(F.sum(count), F.lit(0))).alias("n"))
    return _rows(counted, [_result(name, verdict(n == 0, otherwise), n)], clock)


def _orphans(name: str, child: DataFrame, key: str, parent: DataFrame, clock: Column, otherwise: str = "FAIL") -> DataFrame:
    """Number of child rows whose key the parent lacks, or that have none.

    Child rows are counted per key before the join, which needs the same shuffle anyway,
    so a key that very many rows share is one row.
    """
    counted = child.groupBy(key).agg(F.count("*").alias("rows"))
    return _count_is_zero(name, counted.join(parent.select(key), key, "left_anti"), clock, otherwise, F.col("rows"))


def check_orders_customer(orders: DataFrame, customers: DataFrame, clock: Column) -> DataFrame:
    return _orphans("orders_customer_fk", orders, "customer_id", customers, clock)


def check_payments_order(payments: DataFrame, orders: DataFrame, clock: Column) -> DataFrame:
    return _orphans("payments_order_fk", payments, "order_id", orders, clock)


def check_returns_order(returns: DataFrame, orders: DataFrame, clock: Column) -> DataFrame:
    return _orphans("returns_order_fk", returns, "order_id", orders, clock)


def check_refund_size(returns: DataFrame, orders: DataFrame, clock: Column) -> DataFrame:
    priced = returns.select("order_id", "refund_amount").join(orders.select("order_id", "total"), "order_id")
    return _count_is_zero("returns_refund_not_exceeding_order", priced.filter("refund_amount > total"), clock)


def check_unpaid_orders(orders: DataFrame, payments: DataFrame, clock: Column) -> DataFrame:
    paid = payments.filter("payment_id is not null")
    return _orphans("orders_with_no_payment", orders, "order_id", paid, clock, otherwise="WARN")


# --- serving layer ---------------------------------------------------------------------------


def check_fact_orders(fact_orders: DataFrame, clock: Column) -> DataFrame:
    """Row count and customer-key coverage of the order fact, in one pass."""
    measured = fact_orders.agg(
        F.count("*").alias("n"), F.count_if(F.col("customer_sk").isNull()).alias("unkeyed")
    )
    n, unkeyed = F.col("n"), F.col("unkeyed")
    return _rows(
        measured,
        [
            _result("gold_fact_orders_row_count", verdict(n > 0), n),
            _result("fact_orders_customer_sk_not_null", verdict(unkeyed == 0), unkeyed),
        ],
        clock,
    )


def check_amounts(fact_payments: DataFrame, clock: Column) -> DataFrame:
    return _count_is_zero("payment_amount_range", fact_payments.filter(_outside(F.col("amount"))), clock)


def _outside(amount: Column) -> Column:
    return (amount < AMOUNT_MIN) | (amount > AMOUNT_MAX)


def check_event_volume(fact_events: DataFrame, clock: Column) -> DataFrame:
    """Today's events against the mean of the previous days that had any."""
    today = clock.cast("date")
    recent = fact_events.filter(F.col("event_date").between(F.date_sub(today, VOLUME_DAYS), today))
    daily = recent.groupBy("event_date").agg(F.count("*").alias("n"))
    past = F.col("event_date") < today
    measured = daily.agg(
        F.coalesce(F.sum(F.when(~past, F.col("n"))), F.lit(0)).alias("now"),
        rounded_mean(F.sum(F.when(past, F.col("n"))), F.count_if(past), 10).alias("mean"),
    )
    return _rows(measured, [_volume_result(F.col("now"), F.col("mean"))], clock)


def _volume_result(now: Column, mean: Column) -> Column:
    status = F.when(mean == 0, "WARN").otherwise(verdict(F.try_divide(F.abs(now - mean), mean) <= VOLUME_TOLERANCE))
    expected = F.concat(F.round(mean, 0).cast("decimal(18,0)").cast("string"), F.lit(" (7d avg ± 50%)"))
    return _result("event_volume_anomaly", status, now, expected)


def check_layer_counts(orders: DataFrame, fact_orders: DataFrame, clock: Column) -> DataFrame:
    """Clean against serving order counts, counted in one aggregation over both."""
    tagged = orders.select(F.lit(1).alias("clean")).unionAll(fact_orders.select(F.lit(0).alias("clean")))
    measured = tagged.agg(
        F.count_if(F.col("clean") == 1).alias("clean"), F.count_if(F.col("clean") == 0).alias("served")
    )
    return _rows(measured, [_layer_result(F.col("clean"), F.col("served"))], clock)


def _layer_result(clean: Column, served: Column) -> Column:
    close = F.try_divide(F.abs(clean - served), clean) <= COUNT_TOLERANCE
    status = F.when((clean == 0) & (served == 0), "PASS").when(clean == 0, "WARN").otherwise(verdict(close))
    observed = F.concat(F.lit("silver="), clean.cast("string"), F.lit(", gold="), served.cast("string"))
    return _result("gold_silver_order_count_recon", status, observed)


def overlapping_versions(dim: DataFrame) -> DataFrame:
    """Number of overlapping version pairs, as one row ``n``.

    Two versions of a customer overlap if each starts before the other ends. Pairs
    are counted without being formed: walking a customer's starts and ends in time
    order, each version overlaps the ones then open. At equal times ends go first,
    then empty versions (start = end), then starts. Versions that end before they
    start cannot be walked; those few are compared by a join.
    """
    spans = dim.select("customer_id", "customer_sk", "valid_from", "valid_to").filter(
        "customer_id is not null and valid_from is not null and valid_to is not null"
    )
    forward = spans.filter("valid_from <= valid_to")
    proper = F.col("valid_from") < F.col("valid_to")
    moment = lambda at, rank, step, meets: F.struct(
        F.col(at).alias("at"), F.lit(rank).alias("rank"), F.lit(step).alias("step"), F.lit(meets).alias("meets")
    )
    moments = F.when(proper, F.array(moment("valid_to", 0, -1, 0), moment("valid_from", 2, 1, 1))).otherwise(
        F.array(moment("valid_from", 1, 0, 1))
    )
    walk = forward.select("customer_id", F.explode(moments).alias("m")).select("customer_id", "m.*")
    walk = walk.withColumn("_month", F.trunc("at", "month"))
    opened = running_sum_sliced(walk, ["customer_id"], "_month", ["at", "rank"], F.col("step"), "open")
    # A start counts itself among the open versions.
    met = F.when(F.col("meets") == 1, F.col("open") - F.col("step")).otherwise(F.lit(0))
    walked = opened.agg(F.coalesce(F.sum(met), F.lit(0)).alias("n"))
    backward = spans.filter("valid_from > valid_to")
    pairs = backward.alias("a").join(
        spans.alias("b"),
        (F.col("a.customer_id") == F.col("b.customer_id"))
        & ((F.col("a.customer_sk") < F.col("b.customer_sk")) | (F.col("b.valid_from") <= F.col("b.valid_to")))
        & (F.col("a.customer_sk") != F.col("b.customer_sk"))
        & (F.col("a.valid_from") < F.col("b.valid_to"))
        & (F.col("b.valid_from") < F.col("a.valid_to")),
    )
    return walked.unionAll(pairs.agg(F.count("*").alias("n"))).agg(F.sum("n").alias("n"))


def check_overlap(dim: DataFrame, clock: Column) -> DataFrame:
    n = F.col("n")
    return _rows(overlapping_versions(dim), [_result("dim_customer_scd2_no_overlap", verdict(n == 0), n)], clock)


def check_event_ids(fact_events: DataFrame, clock: Column) -> DataFrame:
    measured = fact_events.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))
    return _rows(measured, [_event_id_result()], clock)


def _event_id_result() -> Column:
    n, ids = F.col("n"), F.col("ids")
    observed = F.concat(F.lit("total="), n.cast("string"), F.lit(", distinct="), ids.cast("string"))
    return _result("gold_events_unique_event_id", verdict(n == ids), observed)


# --- feeds and schemas -----------------------------------------------------------------------


def check_feeds(pending: DataFrame, layer: str, clock: Column) -> DataFrame:
    """Staleness of change feeds.

    ``pending`` has one row per feed: its ``feed`` name and the time of its ``oldest``
    batch not yet consumed, null if there is none. A feed is stale once that batch is
    older than the retention period.
    """
    stale_after = F.col("oldest") + F.expr(f"interval {FEED_RETENTION_DAYS} days")
    shown = F.coalesce(stale_after.cast("string"), F.lit("N/A"))
    rows = pending.select(
        F.concat(F.lit(f"stream_staleness_{layer}_"), F.lower("feed")).alias("check_name"),
        F.when(stale_after < clock, "FAIL").otherwise("PASS").alias("status"),
        shown.alias("observed_value"),
        F.lit("Not stale").alias("expected_value"),
        F.concat(F.lit(f"{layer.capitalize()} stream: "), "feed", F.lit(" (stale_after: "), shown, F.lit(")")).alias("details"),
        clock.alias("check_ts"),
    )
    return conform(rows, CHECK_RESULTS)


def expected_columns(layer: str) -> dict[str, int]:
    """Declared column counts of a layer's tables."""
    return {f.name: len((f.raw if layer == "bronze" else f.clean).fields) for f in FEEDS.values()}


def check_schemas(tables: dict[str, DataFrame], layer: str, clock: Column) -> DataFrame:
    """Column count of each table against its declared schema. Reads no data.

    Tables must come with the columns their files have; a read with a declared schema imposed cannot drift.
    """
    spark = next(iter(tables.values())).sparkSession
    declared = expected_columns(layer)
    found = [(name, len(df.columns), declared[name]) for name, df in tables.items()]
    measured = spark.createDataFrame(found, "feed string, columns int, declared int")
    prefix, suffix, owner = (
        ("schema_drift_", "_raw", "") if layer == "bronze" else ("schema_drift_silver_", "", "SILVER.")
    )
    rows = measured.select(
        F.concat(F.lit(prefix), "feed", F.lit(suffix)).alias("check_name"),
        verdict(F.col("columns") == F.col("declared")).alias("status"),
        F.col("columns").cast("string").alias("observed_value"),
        F.col("declared").cast("string").alias("expected_value"),
        F.concat(
            F.lit(f"Schema drift detected in {owner}"), F.upper(F.concat("feed", F.lit(suffix))),
            F.lit(": expected column count mismatch"),
        ).alias("details"),
        clock.alias("check_ts"),
    )
    return conform(rows, CHECK_RESULTS)


# --- all together ----------------------------------------------------------------------------


def _presence(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, returns: DataFrame, fact_orders: DataFrame, fact_payments: DataFrame
) -> DataFrame:
    """One row with all that the checks on keys, and on the order and payment facts, ask for.

    Rows of the four tables are tagged and meet by key: customers and orders by customer id, orders, payments and returns
    by order id. Which tables a key occurs in answers every check on keys at once, so each table is scanned once. Rows of
    one key and amount are summed per task first; within a key refunds are then ranked among the order totals. The facts
    come as one row of counts.
    """
    marks = ("customers", "orders", "payments", "paid", "returns", "ordered", "nobody", "served", "unkeyed", "outside")

    def tagged(kind: str, key: str, amount: Column | None = None, newest: Column | None = None, **counts: Column) -> Column:
        known = F.col(key).isNotNull()
        return F.struct(
            F.lit(kind).alias("kind"), F.col(key).alias("key"),
            F.when(known, F.lit(None) if amount is None else amount).cast("decimal(20,4)").alias("amount"),
            (F.lit(None).cast("timestamp_ntz") if newest is None else newest).alias("newest"),
            *[counts.get(m, F.lit(0)).cast("bigint").alias(m) for m in marks],
        )

    one = F.lit(1)
    by_order = tagged(
        "order", "order_id", F.col("total"), F.col("order_ts"), orders=one, nobody=F.col("customer_id").isNull().cast("int")
    )
    nothing = F.lit(None).cast("string").alias("none")
    counted = fact_orders.agg(
        F.count("*").alias("served"), F.count_if(F.col("customer_sk").isNull()).alias("unkeyed"), nothing
    ).select(tagged("fact", "none", served=F.col("served"), unkeyed=F.col("unkeyed")).alias("r"))
    outside = fact_payments.agg(F.count_if(_outside(F.col("amount"))).alias("n"), nothing)
    parts = [
        customers.select(tagged("customer", "customer_id", customers=one).alias("r")),
        orders.select(F.explode(F.array(tagged("customer", "customer_id", ordered=one), by_order)).alias("r")),
        payments.select(
            tagged("order", "order_id", payments=one, paid=F.col("payment_id").isNotNull().cast("int")).alias("r")
        ),
        returns.select(tagged("order", "order_id", F.col("refund_amount"), returns=one).alias("r")),
        counted,
        outside.select(tagged("fact", "none", outside=F.col("n")).alias("r")),
    ]
    keyed = reduce(DataFrame.unionByName, parts).select("r.*").groupBy("kind", "key", "amount")
    summed = keyed.agg(F.max("newest").alias("newest"), *[F.sum(m).alias(m) for m in marks])
    key = Window.partitionBy("kind", "key")
    ranked = key.orderBy("amount")
    priced = F.when(F.col("amount").isNotNull(), F.col("orders"))
    seen = summed.select(
        "*",
        (F.row_number().over(ranked) == 1).alias("leads"),
        F.coalesce(F.sum(priced).over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("cheaper"),
        *[(F.sum(m).over(key) > 0).alias(f"has_{m}") for m in ("customers", "orders", "paid")],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    known, of_order = F.col("key").isNotNull(), F.col("kind") == "order"
    without_order = of_order & ~(known & F.col("has_orders"))
    return seen.agg(
        total("orders").alias("n"),
        F.max("newest").alias("newest"),
        total("nobody").alias("no_customer"),
        F.count_if(of_order & known & F.col("leads") & F.col("has_orders")).alias("ids"),
        total(F.when(~(known & F.col("has_customers")), F.col("ordered"))).alias("strangers"),
        total(F.when(without_order, F.col("payments"))).alias("lost_payments"),
        total(F.when(without_order, F.col("returns"))).alias("lost_returns"),
        total(F.when(known & F.col("amount").isNotNull(), F.col("returns") * F.col("cheaper"))).alias("refunds"),
        total(F.when(of_order & ~(known & F.col("has_paid")), F.col("orders"))).alias("unpaid"),
        *[total(m).alias(m) for m in ("served", "unkeyed", "outside")],
    )


def check_presence(clean: dict[str, DataFrame], served: dict[str, DataFrame], clock: Column) -> DataFrame:
    """The checks on keys and on the order and payment facts, from one scan of each table."""
    feeds = [clean[name] for name in ("customers", "orders", "payments", "returns")]
    measured = _presence(*feeds, served["fact_orders"], served["fact_payments"])
    zero = lambda name, column, otherwise="FAIL": _result(name, verdict(F.col(column) == 0, otherwise), F.col(column))
    results = [
        *_order_results(clock),
        zero("orders_customer_fk", "strangers"),
        zero("payments_order_fk", "lost_payments"),
        zero("returns_order_fk", "lost_returns"),
        zero("returns_refund_not_exceeding_order", "refunds"),
        zero("orders_with_no_payment", "unpaid", "WARN"),
        _result("gold_fact_orders_row_count", verdict(F.col("served") > 0), F.col("served")),
        zero("fact_orders_customer_sk_not_null", "unkeyed"),
        zero("payment_amount_range", "outside"),
        _layer_result(F.col("n"), F.col("served")),
    ]
    return _rows(measured, results, clock)


def check_events(fact_events: DataFrame, clock: Column) -> DataFrame:
    """Volume and key uniqueness of the event fact, in one pass."""
    today = clock.cast("date")
    on = lambda back: F.count_if(F.col("event_date") == F.date_sub(today, back))
    days = [on(back).alias(f"d{back}") for back in range(VOLUME_DAYS + 1)]
    counted = fact_events.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), *days)
    past = [F.col(f"d{back}") for back in range(1, VOLUME_DAYS + 1)]
    met = reduce(Column.__add__, [(p > 0).cast("bigint") for p in past])
    measured = counted.select("*", rounded_mean(F.nullif(reduce(Column.__add__, past), F.lit(0)), met, 10).alias("mean"))
    return _rows(measured, [_volume_result(F.col("d0"), F.col("mean")), _event_id_result()], clock)


def run_all(
    clean: dict[str, DataFrame],
    served: dict[str, DataFrame],
    clock: Column,
    raw: dict[str, DataFrame] | None = None,
    pending: dict[str, DataFrame] | None = None,
    stored: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Result rows of every check, ready for one append. Every table is scanned once.

    ``stored`` and ``raw`` are the clean and raw tables with the columns their files have.
    """
    parts = [
        check_presence(clean, served, clock),
        check_events(served["fact_events"], clock),
        check_overlap(served["dim_customer"], clock),
        check_schemas(stored or clean, "silver", clock),
    ]
    if raw:
        parts.append(check_schemas(raw, "bronze", clock))
    for layer, feeds in (pending or {}).items():
        parts.append(check_feeds(feeds, layer, clock))
    return reduce(DataFrame.unionByName, parts)


def failure_row(spark, job: str, error: str, clock: Column) -> DataFrame:
    """The result row a job leaves behind when it fails and publishes nothing."""
    # The texts of the row.
    rows = spark.createDataFrame([(job, error)], "job string, error string").select(
        F.concat("job", F.lit("_execution")).alias("check_name"),
        F.lit("FAIL").alias("status"),
        F.col("error").alias("observed_value"),
        F.lit("No errors").alias("expected_value"),
        F.concat(F.lit("SP_"), F.upper("job"), F.lit(" failed and rolled back")).alias("details"),
        clock.alias("check_ts"),
    )
    return conform(rows, CHECK_RESULTS)


# --- reports on results ----------------------------------------------------------------------


def failures(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == "FAIL")


def latest_results(results: DataFrame, limit: int = 30) -> DataFrame:
    """The most recent result rows, newest first."""
    return results.orderBy(F.desc("check_ts"), "check_name").limit(limit)


def _with_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def failure_trend(results: DataFrame, clock: Column) -> DataFrame:
    """Runs, failures and failure rate per check and day of the last week."""
    recent = results.filter(F.col("check_ts") >= F.date_sub(clock.cast("date"), TREND_DAYS).cast("timestamp_ntz"))
    counts = recent.groupBy(F.to_date("check_ts").alias("check_date"), "check_name").agg(
        F.count("*").alias("total_runs"), _with_status("FAIL").alias("fail_count"), _with_status("PASS").alias("pass_count")
    )
    return counts.withColumn("failure_rate_pct", ratio_pct(F.col("fail_count"), F.col("total_runs")))


def latest_status(results: DataFrame) -> DataFrame:
    """The newest result of each check."""
    newest = [F.desc_nulls_last("check_ts"), F.asc("status"), F.asc("observed_value")]
    return latest_by_key(results, ["check_name"], newest).withColumn("rn", F.lit(1))


def category(name: Column) -> Column:
    """Report heading of a check, by the first pattern its name matches."""
    # The patterns and headings, in the order they are tried.
    return (
        F.when(name.like("stream_staleness%"), "Stream Health")
        .when(name.like("schema_drift%"), "Schema Drift")
        .when(name.like("%_fk") | name.like("%_recon%"), "Referential Integrity")
        .when(name.like("%freshness%") | name.like("%volume%"), "Freshness & Volume")
        .when(name.like("%scd2%") | name.like("%customer_sk%"), "Dimension Integrity")
        .otherwise("Data Quality")
    )


def summary(results: DataFrame) -> DataFrame:
    """Checks per heading by their newest status."""
    return latest_status(results).groupBy(category(F.col("check_name")).alias("check_category")).agg(
        F.count_distinct("check_name").alias("total_checks"),
        _with_status("PASS").alias("passing"),
        _with_status("FAIL").alias("failing"),
        _with_status("WARN").alias("warnings"),
    )


def alert(results: DataFrame, clock: Column, minutes: int = ALERT_MINUTES) -> DataFrame:
    """One row: whether to alert, and the message listing the recent failures."""
    since = clock - F.expr(f"interval {minutes} minutes")
    recent = failures(results).filter(F.col("check_ts") >= since)
    line = F.concat("check_name", F.lit(": "), "details", F.lit(" (observed="), "observed_value", F.lit(")"))
    listed = recent.withColumn("line", line).agg(
        F.count("*").alias("n"), F.expr("listagg(line, '\n') within group (order by line)").alias("message")
    )
    return listed.select((F.col("n") > 0).alias("fire"), "message")


def should_alert(results: DataFrame, clock: Column, minutes: int = ALERT_MINUTES) -> bool:
    """Whether any check failed recently; stops at the first such row."""
    since = clock - F.expr(f"interval {minutes} minutes")
    return not failures(results).filter(F.col("check_ts") >= since).limit(1).isEmpty()


def recent_runs(run_log: DataFrame, clock: Column, pattern: str = "TASK_%", days: int = 7) -> DataFrame:
    """Runs of the last days whose name matches, newest first."""
    since = clock - F.lit(timedelta(days=days))
    return run_log.filter(F.col("name").ilike(pattern) & (F.col("scheduled_time") >= since)).orderBy(
        F.desc("scheduled_time"), "name"
    )
