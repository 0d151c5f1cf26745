"""Interval joins on a shared time bin, so that the join has an equality key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewick.functions.timefn import HOUR, floor_div


def range_join(
    spans: DataFrame, points: DataFrame, keys: list[str], lo: str, hi: str, at: str, bin_us: int = HOUR
) -> DataFrame:
    """Rows of ``points`` with lo <= at <= hi, joined to each span of the same keys.

    A point sits in one bin and a span in every bin it touches, so each match appears
    once. The hash key (keys, bin) also spreads a dominant key over its time bins.
    """
    binned = spans.withColumn("_bin", F.explode(F.sequence(floor_div(F.col(lo), bin_us), floor_div(F.col(hi), bin_us))))
    placed = points.withColumn("_bin", floor_div(F.col(at), bin_us))
    return binned.join(placed, [*keys, "_bin"]).where(F.col(at).between(F.col(lo), F.col(hi))).drop("_bin")
