"""Time arithmetic as column expressions (lake time is naive UTC)."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tidewick.config import DEFAULTS

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp of either kind."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(col.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def floor_div(value: Column, width: int) -> Column:
    """Integer division rounding down, for longs of either sign."""
    return ((value - F.pmod(value, F.lit(width))) / F.lit(width)).cast("long")


def trunc(unit: str, ts: Column | str) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end``."""
    return floor_div(micros(end), MINUTE) - floor_div(micros(start), MINUTE)


def minutes_elapsed(start: Column, end: Column) -> Column:
    """Second boundaries crossed, in minutes with fraction."""
    return (floor_div(micros(end), SECOND) - floor_div(micros(start), SECOND)) / F.lit(60.0)


def whole_days(start: Column, end: Column) -> Column:
    """Day part of the interval, truncated toward zero."""
    return ((micros(end) - micros(start)) / F.lit(DAY)).cast("long")


def shift(ts: Column, *, days: int = 0, hours: int = 0, minutes: int = 0) -> Column:
    return ts + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes))


def local(ts: Column | str, offset_h: int = DEFAULTS.local_offset_h) -> Column:
    col = F.col(ts) if isinstance(ts, str) else ts
    return shift(col, hours=offset_h)


def local_hour(ts: Column | str) -> Column:
    return F.hour(local(ts)).cast("int")


def iso_weekday(ts: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday, in local time."""
    return (F.weekday(local(ts)) + 1).cast("int")


def cyclic(ts: Column | str) -> list[Column]:
    """Local hour on the unit circle plus weekday with Monday = 0."""
    angle = F.lit(2.0 * math.pi) * F.hour(local(ts)) / F.lit(24.0)
    return [
        F.sin(angle).alias("hour_sin"),
        F.cos(angle).alias("hour_cos"),
        F.weekday(local(ts)).cast("int").alias("dow"),
    ]
