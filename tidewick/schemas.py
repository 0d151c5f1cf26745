"""Declared table schemas; a missing table reads as an empty frame of its schema."""

from __future__ import annotations

SCHEMAS = {
    "bronze_candles": "ts timestamp_ntz, open double, high double, low double, close double, volume double, "
                      "ingested_at timestamp_ntz, symbol string",
    "bronze_ticker": "symbol string, last double, percent_change double, high_24h double, low_24h double, "
                     "volume_thb_24h double, snapshot_at timestamp_ntz, dt date",
    "silver_features": "ts timestamp_ntz, open double, high double, low double, close double, volume double, "
                       "vol_thb double, ret_1m double, gap_min bigint, open_5m double, chg_5m double, vol5_thb double, "
                       "base_vpm_thb double, active_share_1d double, range_1m double, max_high_next60 double, "
                       "min_low_next60 double, close_next15 double, vol_x_5m double, symbol string",
    "pairs": "symbol string, name string, listed_at timestamp_ntz, volume_thb_24h double, rank_24h int, "
             "selected boolean, updated_at timestamp_ntz",
    "market_ticker": "symbol string, last double, percent_change double, high_24h double, low_24h double, "
                     "volume_thb_24h double, snapshot_at timestamp_ntz",
    "ingest_state": "symbol string, last_ts bigint, rows_total bigint, files int, updated_at timestamp_ntz",
    "ingest_log": "run_at timestamp_ntz, symbol string, from_ts timestamp_ntz, to_ts timestamp_ntz, api_calls int, "
                  "rows bigint, duration_ms int, object_key string, is_backfill boolean",
    "dq_symbol": "symbol string, bronze_files bigint, bronze_rows bigint, duplicates bigint, candles bigint, "
                 "first_ts timestamp_ntz, last_ts timestamp_ntz, active_share double",
    "events": "event_id string, symbol string, start_ts timestamp_ntz, peak_ts timestamp_ntz, "
              "last_signal_ts timestamp_ntz, base_price double, peak_price double, pump_pct double, max_vol_x double, "
              "max_chg_5m_pct double, signal_minutes bigint, min_low_after double, dump_pct double, "
              "retrace_share double, minutes_to_peak double, minutes_to_half_retrace double, is_pump_dump boolean, "
              "active_share_1d double, vol_thb_event double, hour_local int, dow_local int, concurrent_symbols int, "
              "anomaly_score double",
    "event_candles": "event_id string, ts timestamp_ntz, open double, high double, low double, close double, vol_thb double",
    "symbol_hourly": "symbol string, hour_utc timestamp_ntz, candles bigint, vol_thb double, open double, high double, "
                     "low double, close double, rv_pct double, range_pct double",
    "market_hourly": "hour_utc timestamp_ntz, symbols bigint, candles bigint, vol_thb double, avg_rv_pct double",
    "coin_stats": "symbol string, first_ts timestamp_ntz, last_ts timestamp_ntz, candles bigint, active_share double, "
                  "avg_daily_vol_thb_30d double, last_close double",
    "gold_refresh_log": "refreshed_at timestamp_ntz, silver_rows bigint, events bigint, duration_s double",
    "model_metrics": "model_name string, metric string, value double, baseline double, higher_is_better boolean, "
                     "deployed boolean, train_rows bigint, test_rows bigint, extra string, run_at timestamp_ntz",
    "forecasts": "symbol string, target_hour_utc timestamp_ntz, predicted double, generated_at timestamp_ntz, "
                 "lower double, upper double, model_name string",
    "forecast_backtest": "symbol string, hour_utc timestamp_ntz, actual double, predicted double, baseline double, "
                         "run_id string, model_name string",
    "forecast_history": "model_name string, symbol string, target_hour_utc timestamp_ntz, predicted double, "
                        "generated_at timestamp_ntz, lower double, upper double",
    "early_warnings": "symbol string, ts timestamp_ntz, probability double, chg_5m_pct double, vol_x_5m double, "
                      "outcome string, generated_at timestamp_ntz",
}

# Hive-style partition columns, by table.
PARTITIONS = {
    "bronze_candles": ["symbol"],
    "bronze_ticker": ["dt"],
    "silver_features": ["symbol"],
    "forecasts": ["model_name"],
    "forecast_backtest": ["model_name"],
}
