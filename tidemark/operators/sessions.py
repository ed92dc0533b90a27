"""Sessions from clickstream events, and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import ratio_pct, rounded_mean
from tidemark.functions.time import minute_index, seconds_between
from tidemark.schemas import FACT_SESSIONS, conform

# The inactivity limit, the prefix of computed ids, and the event names of the funnel.
GAP_MINUTES = 30
COMPUTED_PREFIX = "COMPUTED_"
STEPS = ("page_view", "product_view", "add_to_cart", "checkout_start", "purchase")

UNTIMED = 1 << 62  # minute number of events without a timestamp: they come last


def computed_sessions(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Fact events with ``is_new_session`` and ``effective_session_id``.

    A sourced session id is kept. Otherwise an event opens a session if it is the
    customer's first or comes more than ``gap_minutes`` minute boundaries after the
    previous one, sourced or not; the session number counts the customer's openings.

    Only the first event of a customer's minute can open a session, so every event of
    that minute shares a session number. Numbers are therefore computed on one row per
    customer and minute, which keeps the ordered window as long as the clock, not as
    the event count, and events are spread over tasks by customer and minute. Events
    without a timestamp form one last minute of their customer.
    """
    timed = events.withColumn("_minute", _minute("event_ts"))
    minutes = timed.groupBy(F.col("customer_sk").alias("_sk"), F.col("_minute").alias("_at")).agg(
        F.min(F.struct("event_ts", "event_id", F.col("session_id").isNull().alias("free"))).alias("_first")
    )
    line = Window.partitionBy("_sk").orderBy("_at")
    before = F.lag("_at").over(line)
    gap = (F.col("_at") != UNTIMED) & (F.col("_at") - before > gap_minutes)
    opened = F.col("_first.free") & (before.isNull() | gap)
    numbered = minutes.withColumn("_opened", opened.cast("bigint")).withColumn(
        "_group", F.sum("_opened").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    numbered = numbered.select("_sk", "_at", "_opened", "_group", F.col("_first.event_id").alias("_first_id"))
    match = F.col("customer_sk").eqNullSafe(F.col("_sk")) & (F.col("_minute") == F.col("_at"))
    opener = (F.col("_opened") == 1) & (F.col("event_id") == F.col("_first_id"))
    return timed.join(numbered, match).select(
        "event_id",
        "event_ts",
        "event_date",
        "customer_sk",
        F.col("session_id").alias("original_session_id"),
        "event_name",
        "device_type",
        "product_id",
        "load_ts",
        opener.cast("int").alias("is_new_session"),
        F.coalesce("session_id", _computed_id(F.col("_group"))).alias("effective_session_id"),
    )


def _minute(ts: str) -> Column:
    return F.coalesce(minute_index(ts), F.lit(UNTIMED))


def _computed_id(number: Column) -> Column:
    return F.concat(F.lit(COMPUTED_PREFIX), F.col("customer_sk").cast("string"), F.lit("_"), number.cast("string"))


def identifiable(events: DataFrame) -> DataFrame:
    """Events that can belong to a session: anonymous ones need a sourced id."""
    return events.filter(F.col("customer_sk").isNotNull() | F.col("session_id").isNotNull())


def _times(name: str) -> Column:
    return F.count_if(F.col("event_name") == name)


def fact_sessions(events: DataFrame, run_ts: Column) -> DataFrame:
    """One row per session, customer and device."""
    return summarise_sessions(computed_sessions(identifiable(events)), run_ts)


def summarise_sessions(located: DataFrame, run_ts: Column) -> DataFrame:
    """Session rows of events that carry their ``effective_session_id``."""
    rows = located.groupBy("effective_session_id", "customer_sk", "device_type").agg(
        F.min("event_ts").alias("session_start"),
        F.max("event_ts").alias("session_end"),
        *[_times(step).alias(column) for step, column in zip(
            STEPS, ("page_views", "product_views", "add_to_carts", "checkouts_started", "purchases"))],
        F.count("*").alias("_events"),
        F.sort_array(F.collect_set("product_id")).alias("products_viewed"),
    )
    wide = rows.select(
        "*",
        F.col("effective_session_id").alias("session_id"),
        seconds_between("session_start", "session_end").alias("session_duration_sec"),
        (F.col("_events") == 1).alias("is_bounce"),
        (F.col("purchases") > 0).alias("is_conversion"),
        F.col("effective_session_id").like("COMPUTED_%").alias("is_computed_session"),
        run_ts.alias("load_ts"),
    )
    return conform(wide, FACT_SESSIONS)


def session_steps(events: DataFrame, sourced_only: bool = False) -> DataFrame:
    """Which funnel steps each session reached, dated by its first event.

    ``sourced_only`` groups by the source's session id and leaves events without one
    in a group per customer and device.
    """
    if sourced_only:
        located = events.withColumn("_session", F.col("session_id"))
    else:
        located = computed_sessions(identifiable(events)).withColumn("_session", F.col("effective_session_id"))
    columns = ("hit_page_view", "hit_product_view", "hit_add_to_cart", "hit_checkout", "hit_purchase")
    return (
        located.groupBy(F.col("_session").alias("session_id"), "customer_sk", "device_type")
        .agg(
            F.to_date(F.min("event_ts")).alias("session_date"),
            *[F.max((F.col("event_name") == step).cast("int")).alias(c) for step, c in zip(STEPS, columns)],
        )
    )


def conversion_funnel(steps: DataFrame) -> DataFrame:
    """Sessions reaching each step, and step-to-step rates, per day and device."""
    reached = steps.groupBy("session_date", "device_type").agg(
        F.count("*").alias("total_sessions"),
        F.sum("hit_page_view").alias("step_1_page_view"),
        F.sum("hit_product_view").alias("step_2_product_view"),
        F.sum("hit_add_to_cart").alias("step_3_add_to_cart"),
        F.sum("hit_checkout").alias("step_4_checkout"),
        F.sum("hit_purchase").alias("step_5_purchase"),
    )
    rates = {
        "pv_to_pdp_pct": ("step_2_product_view", "step_1_page_view"),
        "pdp_to_atc_pct": ("step_3_add_to_cart", "step_2_product_view"),
        "atc_to_checkout_pct": ("step_4_checkout", "step_3_add_to_cart"),
        "checkout_to_purchase_pct": ("step_5_purchase", "step_4_checkout"),
        "overall_conversion_pct": ("step_5_purchase", "total_sessions"),
    }
    return reached.select("*", *[ratio_pct(F.col(a), F.col(b)).alias(c) for c, (a, b) in rates.items()])


def session_kpis(sessions: DataFrame) -> DataFrame:
    """Bounce, conversion and engagement per day and device."""
    counts = sessions.groupBy(F.to_date("session_start").alias("session_date"), "device_type").agg(
        F.count("*").alias("total_sessions"),
        F.count_if("is_bounce").alias("bounce_sessions"),
        F.count_if("is_conversion").alias("converting_sessions"),
        *[
            rounded_mean(F.sum(c), F.count(c), scale).cast("double").alias(f"avg_{c}")
            for c, scale in (("session_duration_sec", 0), ("page_views", 1), ("product_views", 1))
        ],
    )
    return counts.select(
        "session_date",
        "device_type",
        "total_sessions",
        "bounce_sessions",
        ratio_pct(F.col("bounce_sessions"), F.col("total_sessions")).alias("bounce_rate_pct"),
        "converting_sessions",
        ratio_pct(F.col("converting_sessions"), F.col("total_sessions")).alias("conversion_rate_pct"),
        "avg_session_duration_sec",
        "avg_page_views",
        "avg_product_views",
    )
