"""Sessions kept as parts of days, which fold into sessions.

A customer's day is summarised on its own: its parts (what each session had of that day), its first and last minute, and
how many sessions opened within it. Whether the first minute of a day opens a session, and which number it gets, follows
from the days before; that is left to the fold, which orders one line of days per customer. So a late event redoes its
own day, and the sessions after it are renumbered without being read or written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import minute_index, seconds_between
from tidemark.operators.sessions import COMPUTED_PREFIX, GAP_MINUTES, STEPS, UNTIMED, identifiable
from tidemark.schemas import FACT_SESSIONS, SESSION_DAYS, conform

COUNTS = ("page_views", "product_views", "add_to_carts", "checkouts_started", "purchases")
#: The day of events without a timestamp, after all others; a fixed value.
UNDATED = "9999-12-31"


def line_of() -> Column:
    """Whose sessions an event belongs to: its customer's, else those of its sourced session."""
    return F.coalesce(
        F.concat(F.lit("c"), F.col("customer_sk").cast("string")), F.concat(F.lit("s"), F.col("session_id"))
    )


def day_of() -> Column:
    return F.coalesce(F.to_date("event_ts"), F.lit(UNDATED).cast("date"))


def touched_days(events: DataFrame) -> DataFrame:
    """``line, day`` of the days that a batch of fact events changes."""
    return identifiable(events).select(line_of().alias("line"), day_of().alias("day")).distinct()


def day_parts(events: DataFrame, run_ts: Column, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """The parts of whole days of fact events.

    Events are summed per minute before they meet the others of their day, so a day of one customer is as long as the
    clock. Events without a session id count as ``local`` sessions 0, 1, ... of the day; 0 may go on from the day before.
    """
    minute = F.coalesce(minute_index("event_ts"), F.lit(UNTIMED))
    first = F.min(F.struct("event_ts", "event_id", F.col("session_id").isNull().alias("free")))
    steps = [F.count_if(F.col("event_name") == step).alias(c) for step, c in zip(STEPS, COUNTS)]
    located = identifiable(events).select("*", line_of().alias("line"), day_of().alias("day"), minute.alias("minute"))
    keys = ["line", "customer_sk", "day", "session_id", "device_type"]
    minutes = located.groupBy(*keys, "minute").agg(
        first.alias("first"), F.min("event_ts").alias("session_start"), F.max("event_ts").alias("session_end"), *steps,
        F.count("*").alias("events"), F.collect_set("product_id").alias("products"),
    )
    whole = Window.partitionBy("line", "day")
    clock = whole.orderBy("minute")
    row = whole.orderBy("minute", "first")
    here, earlier = clock.rangeBetween(0, 0), clock.rangeBetween(Window.unboundedPreceding, -1)
    leads = ~F.col("minute").eqNullSafe(F.lag("minute").over(row))  # one row of each minute
    opens = F.min("first").over(here)["free"] & (F.col("minute") - F.max("minute").over(earlier) > gap_minutes)
    marked = minutes.withColumn("opened", F.when(leads & opens, 1).otherwise(0))
    local = F.sum("opened").over(clock.rangeBetween(Window.unboundedPreceding, 0))
    lined = marked.select(
        "*",
        F.when(F.col("session_id").isNull(), local).alias("local"),
        F.min("minute").over(whole).alias("day_first"),
        F.max("minute").over(whole).alias("day_last"),
        F.min(F.struct("minute", "first")).over(whole)["first"]["free"].alias("day_free"),
        F.sum("opened").over(whole).alias("day_opened"),
    )
    day = ["day_first", "day_last", "day_free", "day_opened"]
    parts = lined.groupBy(*keys, "local").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        *[F.sum(c).alias(c) for c in (*COUNTS, "events")],
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("products")))).alias("products"),
        *[F.first(c).alias(c) for c in day],
    )
    return conform(parts.withColumn("load_ts", run_ts), SESSION_DAYS)


def redo_days(parts: DataFrame, events: DataFrame, touched: DataFrame, run_ts: Column, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Parts after the ``touched`` days were summarised anew from ``events``, which holds all events of those days."""
    return without_days(parts, touched).unionByName(fresh_days(events, touched, run_ts, gap_minutes))


def without_days(parts: DataFrame, touched: DataFrame) -> DataFrame:
    return parts.join(touched, ["line", "day"], "left_anti").select(parts.columns)


def fresh_days(events: DataFrame, touched: DataFrame, run_ts: Column, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    of_days = events.select("*", line_of().alias("line"), day_of().alias("day")).join(touched, ["line", "day"], "left_semi")
    return day_parts(of_days.drop("line", "day"), run_ts, gap_minutes)


def fold_days(parts: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Sessions of all parts, in one shuffle by line.

    A session's ``load_ts`` is that of its newest part.
    """
    line = Window.partitionBy("line")
    days = line.orderBy("day_first")
    row = line.orderBy("day_first", "local", "session_id", "device_type")
    earlier = days.rangeBetween(Window.unboundedPreceding, -1)
    before = F.max("day_last").over(earlier)
    gap = (F.col("day_first") != UNTIMED) & (F.col("day_first") - before > gap_minutes)
    leads = ~F.col("day_first").eqNullSafe(F.lag("day_first").over(row))  # one row of each day
    starts = F.when(F.col("day_free") & (before.isNull() | gap), 1).otherwise(0)
    marked = parts.withColumn("_starts", starts).withColumn(
        "_opened", F.when(leads, F.col("_starts") + F.col("day_opened")).otherwise(0)
    )
    number = F.coalesce(F.sum("_opened").over(earlier), F.lit(0)) + F.col("_starts") + F.col("local")
    computed = F.concat(F.lit(COMPUTED_PREFIX), F.col("customer_sk").cast("string"), F.lit("_"), number.cast("string"))
    named = marked.withColumn("_id", F.coalesce("session_id", computed))
    rows = named.groupBy("line", "_id", "customer_sk", "device_type").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        *[F.sum(c).alias(c) for c in (*COUNTS, "events")],
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("products")))).alias("products_viewed"),
        F.max("load_ts").alias("load_ts"),
    )
    wide = rows.select(
        "*",
        F.col("_id").alias("session_id"),
        seconds_between("session_start", "session_end").alias("session_duration_sec"),
        (F.col("events") == 1).alias("is_bounce"),
        (F.col("purchases") > 0).alias("is_conversion"),
        F.col("_id").like(f"{COMPUTED_PREFIX}%").alias("is_computed_session"),
    )
    return conform(wide, FACT_SESSIONS)
