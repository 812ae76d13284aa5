"""Event-time text, calendar keys and row keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the telemetry contract.
DAY_FORMAT = "yyyyMMdd"
MONTH_FORMAT = "yyyyMM"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(duration: str) -> int:
    """``"5 minutes"`` -> microseconds."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration.lower())
    if not match or match.group(2) not in _UNIT_US:
        raise ValueError(f"not a duration: {duration!r}")
    return int(match.group(1)) * _UNIT_US[match.group(2)]


def day(ts: Column) -> Column:
    return F.date_format(ts, DAY_FORMAT)


def month_suffix(ts: Column) -> Column:
    return F.date_format(ts, MONTH_FORMAT)


def second_text(ts: Column) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def parse_second_text(text: Column) -> Column:
    """Text to timestamp; unparsable text gives null."""
    return F.try_to_timestamp(text, F.lit(SECOND_FORMAT))


def day_key(ts: Column, vehicle: Column) -> Column:
    return F.concat_ws("-", day(ts), vehicle)


def previous_day_key(ts: Column, vehicle: Column) -> Column:
    return day_key(ts - F.expr("INTERVAL 24 HOURS"), vehicle)


def millis_key(ts: Column, vehicle: Column) -> Column:
    return F.concat_ws("-", F.unix_millis(ts).cast("string"), vehicle)


def episode_unid(*parts: Column) -> Column:
    """32 upper-case hex digits, the same for the same parts, so a replay writes the same id."""
    return F.upper(F.md5(F.concat_ws("#", *[p.cast("string") for p in parts])))
