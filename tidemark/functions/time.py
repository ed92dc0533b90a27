"""Clock arithmetic that counts unit boundaries crossed.

``10:00:59 -> 10:31:01`` crosses 31 minute boundaries though only 30 whole
minutes elapse. Each helper numbers the units since 1970-01-01 from the date and
clock fields, so the result does not depend on the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp(value: datetime | str) -> Column:
    """A timestamp literal without time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def day_index(ts) -> Column:
    return F.unix_date(_col(ts).cast("date")).cast("bigint")


def hour_index(ts) -> Column:
    return day_index(ts) * 24 + F.hour(_col(ts))


def minute_index(ts) -> Column:
    return hour_index(ts) * 60 + F.minute(_col(ts))


def second_index(ts) -> Column:
    return minute_index(ts) * 60 + F.second(_col(ts))


def days_between(start, end) -> Column:
    return day_index(end) - day_index(start)


def hours_between(start, end) -> Column:
    return hour_index(end) - hour_index(start)


def minutes_between(start, end) -> Column:
    return minute_index(end) - minute_index(start)


def seconds_between(start, end) -> Column:
    return second_index(end) - second_index(start)
