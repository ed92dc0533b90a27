"""Streaming forms that bound their state by a watermark, at the price of exactness.

Both need event time as an instant: a timestamp without zone cannot carry a
watermark, so it is read as UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_instant(events: DataFrame, column: str = "event_ts") -> DataFrame:
    """Add ``event_time``, the instant of a zoneless timestamp in UTC."""
    return events.withColumn("event_time", F.from_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone()))


def utc_clock(instant: str):
    """The zoneless UTC time of an instant: the reverse of :func:`with_instant`."""
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def dedup_within(events: DataFrame, key: str = "event_id", delay: str = "7 days") -> DataFrame:
    """Drop repeats of an event id that arrive within ``delay`` of the newest event seen."""
    return with_instant(events).withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])


def session_windows(events: DataFrame, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Sessions per user by inactivity gap, each emitted once it can no longer grow.

    Unlike the exact operator this measures elapsed time, starts a new session at a gap
    equal to the limit, and ignores session ids the source supplied.
    """
    timed = with_instant(events).withWatermark("event_time", delay)
    windows = timed.groupBy("user_id", F.session_window("event_time", gap).alias("w")).agg(
        F.count("*").alias("events"), F.count_if(F.col("event_name") == "purchase").alias("purchases")
    )
    return windows.select(
        "user_id", utc_clock("w.start").alias("window_start"), utc_clock("w.end").alias("window_end"), "events", "purchases"
    )
