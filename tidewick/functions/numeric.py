"""Null-safe arithmetic: a missing or zero divisor gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0.0))


def change(now: Column, before: Column) -> Column:
    return ratio(now, before) - F.lit(1.0)


def pearson(a: str, b: str) -> Column:
    """Pearson correlation that is NULL when either side does not vary."""
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.try_divide(F.covar_pop(a, b), spread)
