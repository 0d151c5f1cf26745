"""Bronze to silver: latest-wins dedupe, per-minute features, data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.config import BASELINE_MINUTES, DAY_MINUTES, DEFAULTS, Settings
from tidewick.functions.numeric import change, ratio
from tidewick.functions.timefn import DAY, MINUTE, floor_div, from_micros, micros
from tidewick.operators.blocks import BLOCK, in_block, owned, with_halo

VALUES = ["open", "high", "low", "close", "volume"]


def latest_candles(bronze: DataFrame) -> DataFrame:
    """One row per (symbol, ts): the latest pull wins, equal pulls resolve by value.

    A grouped max, so copies of one candle combine before the shuffle.
    """
    newest = F.max(F.struct("ingested_at", *VALUES)).alias("_v")
    return bronze.groupBy("symbol", "ts").agg(newest).select("symbol", "ts", *[f"_v.{c}" for c in VALUES])


def merge_pulls(*pulls: DataFrame) -> DataFrame:
    """Concatenate pulls by column name; overlaps are settled by ``latest_candles``."""
    out = pulls[0]
    for pull in pulls[1:]:
        out = out.unionByName(pull)
    return out


def with_quote_volume(candles: DataFrame) -> DataFrame:
    return candles.withColumn("vol_thb", F.col("volume") * F.col("close"))


def block_summary(candles: DataFrame, settings: Settings = DEFAULTS, version: str | None = None) -> DataFrame:
    """First ts and last candle per (symbol, block): all that later blocks need to know.

    ``version`` names the column that decides between copies of the same minute; equal ones resolve by value, as in
    ``latest_candles``. seen_at and last_values are those of the row at hi.
    """
    recency = F.struct("ts", *[F.col(version).alias("seen_at")] if version else [], *VALUES)
    last = candles.groupBy("symbol", floor_div(micros("ts"), settings.block_days * DAY).alias(BLOCK)).agg(
        F.min("ts").alias("lo"), F.max(recency).alias("_last"))
    return last.select(
        "symbol", BLOCK, "lo", F.col("_last.ts").alias("hi"), F.col("_last.close").alias("last_close"),
        (F.col("_last.seen_at") if version else F.lit(None).cast("timestamp_ntz")).alias("seen_at"),
        F.struct(*[F.col(f"_last.{c}") for c in VALUES]).alias("last_values"))


def edges(summary: DataFrame) -> DataFrame:
    """Per (symbol, block): the last candle of earlier blocks and the symbol's first ts.

    ``summary`` may hold several rows per block, one per pull.
    """
    newest = F.max_by("last_close", F.struct("hi", "seen_at", "last_values"))
    per_block = summary.groupBy("symbol", BLOCK).agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"), newest.alias("_close"))
    by_block = Window.partitionBy("symbol").orderBy(BLOCK)
    return per_block.select(
        "symbol", BLOCK,
        F.lag("_hi").over(by_block).alias("_edge_ts"),
        F.lag("_close").over(by_block).alias("_edge_close"),
        F.min("_lo").over(Window.partitionBy("symbol")).alias("first_ts"),
    )


def _between(up_to: Column, before: Column) -> Column:
    """Difference of two prefix aggregates; a missing earlier prefix counts as zero."""
    return F.coalesce(up_to, F.lit(0)) - F.coalesce(before, F.lit(0))


def minute_features(candles: DataFrame, settings: Settings = DEFAULTS, summary: DataFrame | None = None) -> DataFrame:
    """Every per-minute feature from one shuffle on (symbol, block).

    ``summary`` describes the whole history when ``candles`` is only its tail.

    Frames of an hour or less are plain RANGE frames. The 7-day sum and the 1-day count
    are differences of frames that start at the block, which Spark extends row by row
    instead of rescanning; sums there are decimal, so the difference is exact. Only the
    candle itself is shuffled; everything derived from it is computed behind the shuffle.
    """
    block_us = settings.block_days * DAY
    known = edges(block_summary(candles, settings) if summary is None else summary)
    slim = candles.select("symbol", micros("ts").alias("_us"), *VALUES)
    laid = with_halo(slim, "_us", block_us, back_us=7 * DAY, ahead_us=60 * MINUTE)
    # a fixed number of partitions: the frames are CPU-bound, so small blocks of bytes are not merged
    width = int(candles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = laid.repartition(width, "symbol", BLOCK)
    laid = with_quote_volume(laid).withColumn("_exact", F.col("vol_thb").cast("decimal(28,10)"))

    w = in_block(["symbol"], "_us")
    start = Window.unboundedPreceding
    last5 = w.rangeBetween(-4 * MINUTE, 0)
    next60 = w.rangeBetween(MINUTE, 60 * MINUTE)
    next15 = w.rangeBetween(14 * MINUTE, 15 * MINUTE)
    upto_5m_ago = w.rangeBetween(start, -5 * MINUTE)
    before_7d = w.rangeBetween(start, -7 * DAY - 1)
    before_1d = w.rangeBetween(start, -DAY - 1)

    framed = laid.select(
        "symbol", BLOCK, "_us", *VALUES, "vol_thb",
        F.lag("_us").over(w).alias("_prev_us"),
        F.lag("close").over(w).alias("_prev_close"),
        F.first("open").over(last5).alias("open_5m"),
        F.sum("vol_thb").over(last5).alias("vol5_thb"),
        _between(F.sum("_exact").over(upto_5m_ago), F.sum("_exact").over(before_7d)).alias("_base_sum"),
        _between(F.count("_exact").over(upto_5m_ago), F.count("_exact").over(before_7d)).alias("_base_n"),
        (F.row_number().over(w) - F.count("*").over(before_1d)).alias("_day_n"),
        F.max("high").over(next60).alias("max_high_next60"),
        F.min("low").over(next60).alias("min_low_next60"),
        F.last("close").over(next15).alias("close_next15"),
    ).where(owned("_us", block_us)).join(known, ["symbol", BLOCK])

    # the previous candle lies before the halo only after a pause of more than a week
    inside = F.col("_prev_us").isNotNull()
    prev_us = F.when(inside, F.col("_prev_us")).otherwise(micros("_edge_ts"))
    prev_close = F.when(inside, F.col("_prev_close")).otherwise(F.col("_edge_close"))
    base_vpm = F.when(F.col("_base_n") > 0, F.col("_base_sum").cast("double") / F.lit(float(BASELINE_MINUTES)))
    mature = F.col("_us") >= micros("first_ts") + DAY
    return framed.withColumn("base_vpm_thb", base_vpm).select(
        "symbol", from_micros(F.col("_us")).alias("ts"), *VALUES, "vol_thb",
        change(F.col("close"), prev_close).alias("ret_1m"),
        (floor_div(F.col("_us"), MINUTE) - floor_div(prev_us, MINUTE)).alias("gap_min"),
        "open_5m",
        change(F.col("close"), F.col("open_5m")).alias("chg_5m"),
        "vol5_thb",
        "base_vpm_thb",
        (F.col("_day_n") / F.lit(float(DAY_MINUTES))).alias("active_share_1d"),
        ratio(F.col("high") - F.col("low"), F.col("low")).alias("range_1m"),
        "max_high_next60", "min_low_next60", "close_next15",
        F.when(mature, ratio(F.col("vol5_thb"), F.col("base_vpm_thb") * 5)).alias("vol_x_5m"),
    )


def build_silver(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return minute_features(latest_candles(bronze), settings)


def first_seen(candles: DataFrame) -> DataFrame:
    """Each candle with the first ts of its symbol, by a small aggregate joined back."""
    firsts = candles.groupBy("symbol").agg(F.min("ts").alias("first_ts"))
    return candles.join(firsts, "symbol")


def data_quality(bronze: DataFrame, pull_key: str = "ingested_at") -> DataFrame:
    """Files, raw rows, duplicates and coverage per symbol.

    Copies are counted per (symbol, ts) first, so no distinct count over raw rows is
    shuffled. ``pull_key`` identifies a file: one pull of a symbol is one file.
    """
    per_candle = bronze.groupBy("symbol", "ts").agg(F.count("*").alias("_copies"))
    span_min = F.greatest((micros(F.max("ts")) - micros(F.min("ts"))) / F.lit(60e6) + 1, F.lit(1.0))
    per_symbol = per_candle.groupBy("symbol").agg(
        F.sum("_copies").alias("bronze_rows"),
        (F.sum("_copies") - F.count("*")).alias("duplicates"),
        F.count("*").alias("candles"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        (F.count("*") / span_min).alias("active_share"),
    )
    files = bronze.select("symbol", pull_key).distinct().groupBy("symbol").agg(F.count("*").alias("bronze_files"))
    return per_symbol.join(files, "symbol").select(
        "symbol", "bronze_files", "bronze_rows", "duplicates", "candles", "first_ts", "last_ts", "active_share")
