"""Dates of review feeds and epoch seconds."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Three letters of a month's name, as Spark's parser wants them.
_MONTH = r"([A-Z][a-z]{2})[a-z]*"


def parse_feed_date(c: Column) -> Column:
    """Timestamp of texts like ``Tue Oct 03 10:28:16 -0700 2017``; other texts are an error.

    Names of days and months may be short or full.
    """
    rest = F.regexp_replace(F.substring_index(F.trim(c), " ", -5), f"^{_MONTH} ", "$1 ")
    return F.to_timestamp(rest, "MMM d HH:mm:ss Z yyyy")


def feed_seconds(c: Column) -> Column:
    """Epoch seconds as a 32-bit float, the precision of the interaction tables."""
    return F.unix_timestamp(parse_feed_date(c)).cast("float")


def float_seconds_to_long(c: Column) -> Column:
    return c.cast("float").cast("long")


def epoch(day: date) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp())


def year_range(year: int) -> tuple[int, int]:
    """Epoch seconds of a year: first included, last excluded."""
    return epoch(date(year, 1, 1)), epoch(date(year + 1, 1, 1))
