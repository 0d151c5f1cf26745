"""Hourly, market-wide and per-symbol summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewick.functions.numeric import change
from tidewick.functions.timefn import minutes_between, shift, trunc


def symbol_hourly(silver: DataFrame) -> DataFrame:
    squares = F.pow(F.coalesce(F.col("ret_1m"), F.lit(0.0)), F.lit(2.0))
    return silver.groupBy("symbol", trunc("hour", "ts").alias("hour_utc")).agg(
        F.count("*").alias("candles"),
        F.sum("vol_thb").alias("vol_thb"),
        F.min_by("open", F.when(F.col("open").isNotNull(), F.col("ts"))).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col("ts"))).alias("close"),
        (F.sqrt(F.sum(squares)) * 100).alias("rv_pct"),
        (change(F.max("high"), F.min("low")) * 100).alias("range_pct"),
    )


def market_hourly(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("hour_utc").agg(
        F.count("*").alias("symbols"),
        F.sum("candles").alias("candles"),
        F.sum("vol_thb").alias("vol_thb"),
        F.avg("rv_pct").alias("avg_rv_pct"),
    )


def coin_stats(silver: DataFrame) -> DataFrame:
    recent = F.col("ts") >= shift(silver.agg(F.max("ts")).scalar(), days=-30)
    return silver.groupBy("symbol").agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count("*").alias("candles"),
        (F.count("*") / (minutes_between(F.min("ts"), F.max("ts")) + F.lit(1.0))).alias("active_share"),
        (F.sum(F.when(recent, F.col("vol_thb"))) / F.lit(30.0)).alias("avg_daily_vol_thb_30d"),
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col("ts"))).alias("last_close"),
    )


def rebucket(hourly: DataFrame, unit: str) -> DataFrame:
    """Hourly rows of one symbol to ``unit`` buckets: last close, extremes, sum, mean."""
    return hourly.groupBy(trunc(unit, "hour_utc").alias("t")).agg(
        F.max_by("close", "hour_utc").alias("close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("vol_thb").alias("vol_thb"),
        F.avg("rv_pct").alias("rv_pct"),
    )
