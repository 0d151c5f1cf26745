"""Headline timings. Prints one JSON line; BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import catalog, tables  # noqa: E402
from tidewick.session import build_session  # noqa: E402

# Straight from raw rows: dedupe, features and event detection in one plan each.
FROM_RAW = ["w1_latest_wins", "a8_data_quality", "silver_features", "w5_volume_baseline", "flagship_gold_events", "u1_merge_pulls"]
# From the stored silver and gold tables, whose build is timed as lake_build.
FROM_TABLES = [
    "p2_candidates", "w10_sessions", "w11_refractory", "j1_peak_range_join", "a4_event_measures", "j4_concurrent_symbols_market",
    "j5_event_candles", "a5_symbol_hourly", "a7_coin_stats", "m2_volatility_frame", "t6_hash_sample", "a23_error_band",
    "q1_overview", "q2_event_list", "q12_price_board", "q13_coin_series", "q14_correlation_matrix",
]


def clocked(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def drain(key: str) -> None:
        catalog.QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()

    spark.read.parquet(f"{folder}/events.parquet").count()  # start-up is not a query
    seconds = {key: clocked(lambda k=key: drain(k)) for key in FROM_RAW}

    def build() -> None:
        for name in ("events", "symbol_hourly", "market_hourly", "coin_stats", "pairs", "market_ticker"):
            tables.Tables(spark, folder)[name]
        tables.gold(spark, folder)

    seconds["lake_build"] = clocked(build)
    seconds |= {key: clocked(lambda k=key: drain(k)) for key in FROM_TABLES}
    print(json.dumps({
        "metric": "total seconds of the headline queries, one run each", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
