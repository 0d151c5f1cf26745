"""Dense hourly grids and the lag features computed on them.

An hourly series has at most one row per symbol and hour, whatever the candle volume, so
windows by symbol stay small here: about 8,800 rows per symbol and year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidewick.functions.timefn import cyclic, trunc

LAGS = (1, 2, 3, 24)


def complete_hours(hourly: DataFrame, as_of) -> DataFrame:
    """Drop the hour that is still filling at ``as_of``."""
    return hourly.where(F.col("hour_utc") < trunc("hour", as_of))


def densify(series: DataFrame, values: list[str], fill: float | None) -> DataFrame:
    """Every clock hour between a symbol's first and last row; gaps get ``fill``."""
    bounds = series.groupBy("symbol").agg(F.min("hour_utc").alias("_a"), F.max("hour_utc").alias("_b"))
    hours = bounds.select("symbol", F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 HOUR"))).alias("hour_utc"))
    known = series.select("symbol", "hour_utc", *values, F.lit(True).alias("_known"))
    joined = hours.join(known, ["symbol", "hour_utc"], "left")
    return joined.select("symbol", "hour_utc", *[
        F.when(F.col("_known"), F.col(v)).otherwise(F.lit(fill).cast("double")).alias(v) for v in values])


def lagged(dense: DataFrame, min_roll: int) -> DataFrame:
    """Lags 1, 2, 3 and 24, and the mean of the 24 hours before (NULLs skipped)."""
    w = Window.partitionBy("symbol").orderBy("hour_utc")
    day = w.rowsBetween(-24, -1)
    return dense.withColumns({f"lag{k}": F.lag("y", k).over(w) for k in LAGS}).withColumn(
        "roll24", F.when(F.count("y").over(day) >= min_roll, F.avg("y").over(day)))


def with_clock(df: DataFrame, ts: str = "hour_utc") -> DataFrame:
    return df.select("*", *cyclic(ts))
