"""Time expressions on ``timestamp_ntz`` columns.

Spark's timestamp arithmetic passes through the session time zone, so the session must run in
UTC, where that changes nothing (``tripkit.session.apply_settings`` sees to it). In a zone with
daylight saving, times in the skipped hour would shift.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOUR_US = 3_600_000_000


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 as bigint."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ts.cast("timestamp_ntz"))


def from_micros(value: Column) -> Column:
    return F.timestamp_add("MICROSECOND", value, _epoch())


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def round_to_hour(ts: Column) -> Column:
    """Nearest full hour; exactly half past goes to the even hour.

    Integer arithmetic only, so the tie is decided exactly.
    """
    us = micros(ts)
    rest = F.pmod(us, F.lit(_HOUR_US))
    hour = ((us - rest) / F.lit(_HOUR_US)).cast("bigint")
    half = F.lit(_HOUR_US // 2)
    up = (rest > half) | ((rest == half) & (F.pmod(hour, F.lit(2)) == 1))
    return F.timestamp_add("HOUR", (hour + up.cast("bigint")).cast("int"), _epoch())


def utc_to_local(ts: Column, zone: str = "America/New_York") -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def parse_datetime(value: Column, strict: bool = True) -> Column:
    """Text or timestamp to ``timestamp_ntz``; bad text raises, or is null if not strict."""
    return value.cast("timestamp_ntz") if strict else value.try_cast("timestamp_ntz")


def weekday_monday_zero(ts: Column) -> Column:
    return F.weekday(ts)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def in_nanosecond_range(ts: Column) -> Column:
    """Inside the span that 64-bit nanosecond timestamps can hold."""
    low = F.lit("1677-09-21 00:12:43.145225").cast("timestamp_ntz")
    high = F.lit("2262-04-11 23:47:16.854775").cast("timestamp_ntz")
    return F.coalesce(ts.between(low, high), F.lit(False))
