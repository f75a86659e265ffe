"""Timestamp parsing, formatting and date arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A zone or offset after the time of day.
_ZONED = r":\d{2}(\.\d+)?\s*(Z|UTC|GMT|UT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_]+)\s*$"


def _wall_clock(instant: Column) -> Column:
    """An instant as UTC wall-clock time without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def parse_timestamp(c: Column, fmt: str | None = None) -> Column:
    """Text -> UTC wall-clock time without zone (``timestamp_ntz``); unparseable text gives NULL.

    Text with a zone or offset ('Z') is an instant and is expressed in UTC; text without one is
    UTC wall clock already. The session time zone plays no part, so a partition day is the same
    in every session. ``fmt`` (a datetime pattern) names the form that the whole text must have;
    without it the text is ISO-like.
    """
    if fmt is None:
        return F.when(c.rlike(_ZONED), _wall_clock(F.try_to_timestamp(c))).otherwise(c.try_cast("timestamp_ntz"))
    if re.search("[VzOXxZ]", re.sub("'[^']*'", "", fmt)):
        return _wall_clock(F.try_to_timestamp(c, F.lit(fmt)))
    return _wall_clock(F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(f"{fmt} xx")))


def format_timestamp(ts: Column, fmt: str) -> Column:
    """Wall-clock time (or a date) as text by a datetime pattern, e.g. for names of files and folders of a day."""
    return F.date_format(ts.cast("timestamp_ntz"), fmt)


def settlement_day(ts: Column) -> Column:
    """The calendar day of a settlement timestamp (partition value)."""
    return F.to_date(ts)
