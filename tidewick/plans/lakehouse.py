"""Bronze to silver to gold as stored tables: the flagship pipeline."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F

from tidewick.config import DEFAULTS, Settings
from tidewick.operators import candles, events, rollups
from tidewick.session import written
from tidewick.sources.lake import LakeTables

def gold_events(silver: DataFrame, scored: DataFrame | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Sessions, their paths and concurrency. ``silver`` is read three times, so pass a stored
    table; the measured events are stored as well, because concurrency reads them twice."""
    facts = events.session_facts(events.sessions(events.candidates(silver, settings), settings))
    measured = written(events.measured(events.event_paths(facts, silver, settings)), "measured")
    counted = events.with_concurrency(measured, settings)
    return events.carry_scores(counted, scored).select(*events.EVENT, "concurrent_symbols", "anomaly_score")


def refresh_silver(lake: LakeTables, settings: Settings = DEFAULTS) -> None:
    """Recompute silver from bronze, one folder per symbol, sorted by time within files.

    Features leave their shuffle grouped by symbol and block already, so writing adds a sort
    inside each task but no second shuffle; a long history becomes one file per block."""
    if not lake.landed("bronze_candles"):
        return
    bronze = lake.read("bronze_candles")
    silver = candles.build_silver(bronze, settings)
    lake.replace_slices("silver_features", silver, sort=["ts"])
    quality = candles.data_quality(bronze.withColumn("_file", F.input_file_name()), "_file")
    lake.replace("dq_symbol", quality)


def refresh_gold(lake: LakeTables, settings: Settings = DEFAULTS) -> dict[str, int]:
    """Recompute all gold tables, keep earlier anomaly scores, log the refresh."""
    if not lake.exists(lake.path("silver_features")):
        return {}
    began = time.monotonic()
    silver = lake.read("silver_features")
    counts = {"events": lake.replace("events", gold_events(silver, lake.read("events"), settings))}
    counts["event_candles"] = lake.replace("event_candles", events.event_candles(lake.read("events"), silver))
    counts["symbol_hourly"] = lake.replace("symbol_hourly", rollups.symbol_hourly(silver))
    counts["market_hourly"] = lake.replace("market_hourly", rollups.market_hourly(lake.read("symbol_hourly")))
    counts["coin_stats"] = lake.replace("coin_stats", rollups.coin_stats(silver))
    lake.append("gold_refresh_log", silver.agg(
        F.current_timestamp().cast("timestamp_ntz").alias("refreshed_at"), F.count("*").alias("silver_rows"),
        F.lit(counts["events"]).cast("bigint").alias("events"), F.lit(time.monotonic() - began).alias("duration_s")))
    return counts


def gold_from(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Gold events from bronze, silver stored on the way."""
    return gold_events(written(candles.build_silver(bronze, settings), "silver"), settings=settings)
