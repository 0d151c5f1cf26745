"""Thresholds and business rules, gathered in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

# These must be what they are for results to be right.
STABLECOINS = (
    "USDT", "USDC", "DAI", "BUSD", "TUSD", "FDUSD", "PYUSD", "RLUSD", "USD1", "USDP", "USDE",
)
QUOTE_SUFFIX = "_THB"
MARKET_SYMBOL = "MARKET"
OUTCOME_PUMP = "pump"
OUTCOME_NO_PUMP = "no"
OUTCOME_TRACKING = "tracking"
TAG_NEW_LISTING = "new listing"
TAG_LOW_LIQUIDITY = "low liquidity"
BASELINE_MINUTES = 7 * 24 * 60
DAY_MINUTES = 24 * 60


@dataclass(frozen=True)
class Settings:
    # detection
    candidate_pump_pct: float = 5.0
    candidate_vol_x: float = 5.0
    default_pump_pct: float = 10.0
    default_vol_x: float = 10.0
    dump_window_min: int = 60
    event_gap_min: int = 30
    concurrent_min: int = 10
    local_offset_h: int = 7
    # learning
    test_share: float = 0.2
    horizon_h: int = 6
    top_symbols: int = 10
    early_chg: float = 0.03
    early_vol_x: float = 3.0
    target_pump: float = 0.10
    band_low: float = 0.10
    band_high: float = 0.90
    band_min_samples: int = 50
    min_hours: int = 24 * 14
    min_triggers: int = 200
    min_positives: int = 20
    min_direction_rows: int = 5000
    min_anomaly_events: int = 30
    direction_sample: int = 300_000
    rule_vol_x: float = 10.0
    fee_round_trip_pct: float = 0.5
    regress_rounds: int = 300
    warn_rounds: int = 250
    direction_rounds: int = 200
    learning_rate: float = 0.05
    seed: int = 42
    forest_trees: int = 300
    forest_sample: int = 256
    # serving
    new_listing_days: int = 90
    low_liquidity_share: float = 0.5
    # ingest
    top_n: int = 50
    backfill_days: int = 365
    chunk_days: int = 30
    # physical: one window group spans this many days of one symbol
    block_days: int = 28


DEFAULTS = Settings()
