"""Early warnings as a stream: each trigger is told when it is sure, and again with its outcome an hour later.

State is kept by symbol and day. A row also goes to the following day if it lies within the quiet period before it, and to
the day before if it lies within the hour after it, so a day decides alone about its triggers and their outcome. A group
holds a day and a half hour and an hour of minutes at most, however much of the data one symbol owns, and ends with its day.

Rows may arrive in any order within ``delay_min`` minutes of the newest one of earlier batches. What has passed that
watermark is decided; rows that come later are left out here, and the recomputed triggers of ``jobs.refractory_triggers``
take them in. "Now" is the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewick.config import DEFAULTS, OUTCOME_NO_PUMP, OUTCOME_PUMP, OUTCOME_TRACKING, Settings
from tidewick.functions.timefn import DAY, MINUTE, micros, shift
from tidewick.learning.warning import MATURE_MIN, QUIET_MIN

TOLD = "symbol string, ts timestamp_ntz, chg_5m double, vol_x_5m double, outcome string"
FIELDS = ("us", "high", "open_5m", "chg_5m", "vol_x_5m")
# Rows that wait for the watermark, triggers that wait for their outcome, and the last signal before the watermark.
STATE = ", ".join([f"row_{f} array<{'bigint' if f == 'us' else 'double'}>" for f in FIELDS]
                  + [f"open_{f} array<{'bigint' if f == 'us' else 'double'}>" for f in FIELDS] + ["last_signal bigint"])
NEVER = -(2**62)


def outcomes(silver: DataFrame, delay_min: int = 0, settings: Settings = DEFAULTS) -> DataFrame:
    """Triggers of a stream of silver rows (symbol, ts, high, open_5m, chg_5m, vol_x_5m), once as tracking and once with
    their outcome. A null symbol is a symbol like others; null features are no signal; of rows that repeat a minute before
    it is decided, the one with the greatest values counts. A trigger without a higher price in its hour, or without a
    base price, is no pump."""
    day = F.to_date("ts")
    reached = F.array_distinct(F.array(day, F.to_date(shift(F.col("ts"), minutes=QUIET_MIN)), F.to_date(shift(F.col("ts"), minutes=-MATURE_MIN))))
    rows = silver.where("ts IS NOT NULL").select(
        "symbol", F.col("ts").cast("timestamp").alias("event_time"), micros("ts").alias("us"),
        *[F.col(f).cast("double").alias(f) for f in FIELDS[1:]], F.explode(reached).alias("day"))
    watched = rows.withWatermark("event_time", f"{delay_min} minutes").groupBy("symbol", "day")
    return watched.applyInPandasWithState(_decide(settings), TOLD, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def current(told: DataFrame) -> DataFrame:
    """The last word on each trigger."""
    final = F.col("outcome") != OUTCOME_TRACKING
    return told.groupBy("symbol", "ts").agg(F.max_by(F.struct("chg_5m", "vol_x_5m", "outcome"), final).alias("t")).select("symbol", "ts", "t.*")


def _decide(settings: Settings):
    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        symbol, day = key
        now = state.getCurrentWatermarkMs() * 1000
        starts = (np.datetime64(day) - np.datetime64("1970-01-01")).astype("timedelta64[us]").astype(int).item()
        held = list(state.get) if state.exists else [[]] * (2 * len(FIELDS)) + [NEVER]
        pieces = [_table([p[f] for f in FIELDS]) for p in parts]
        arrived = [p[p["us"] > now] for p in pieces]
        rows, last = _newest(np.concatenate([_table(held[:len(FIELDS)]), *arrived])), held[-1]
        ready, rows = rows[rows["us"] <= now], rows[rows["us"] > now]
        signal = ready[(ready["chg_5m"] >= settings.early_chg) & (ready["vol_x_5m"] >= settings.early_vol_x)]
        since = np.diff(signal["us"], prepend=last)
        own = (signal["us"] >= starts) & (signal["us"] < starts + DAY)
        fresh = signal[own & (since > QUIET_MIN * MINUTE)]
        told = [_told(symbol, fresh, OUTCOME_TRACKING)]

        # a trigger's high is what its hour has seen so far; nothing is seen at first
        fresh["high"] = np.nan
        waiting = np.concatenate([_table(held[len(FIELDS):-1]), fresh])
        for row in waiting:
            within = (ready["us"] > row["us"]) & (ready["us"] <= row["us"] + MATURE_MIN * MINUTE)
            row["high"] = np.fmax(row["high"], np.fmax.reduce(ready["high"][within], initial=np.nan))
        done = waiting["us"] + MATURE_MIN * MINUTE <= now
        ripe, waiting = waiting[done], waiting[~done]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ripe["open_5m"] != 0, ripe["high"] / ripe["open_5m"] - 1, np.nan)
        told.append(_told(symbol, ripe, np.where(gain >= settings.target_pump, OUTCOME_PUMP, OUTCOME_NO_PUMP)))

        ends = starts + DAY + MATURE_MIN * MINUTE
        if now < ends:
            last = int(signal["us"][-1]) if len(signal) else last
            state.update((*[rows[f].tolist() for f in FIELDS], *[waiting[f].tolist() for f in FIELDS], last))
            due = min([ends, *rows["us"].tolist(), *(waiting["us"] + MATURE_MIN * MINUTE).tolist()])
            state.setTimeoutTimestamp(max(due // 1000 - 1, now // 1000 + 1))
        elif state.exists:
            state.remove()
        yield from (t for t in told if len(t))

    return step


_ROW = np.dtype([(f, "i8" if f == "us" else "f8") for f in FIELDS])


def _table(columns) -> np.ndarray:
    table = np.empty(len(columns[0]), _ROW)
    for field, values in zip(FIELDS, columns):
        table[field] = np.asarray(values, table.dtype[field])
    return table


def _newest(rows: np.ndarray) -> np.ndarray:
    """In order of time, one row a minute: of repeated ones the greatest, missing values lowest."""
    ranked = [np.where(np.isnan(rows[f]), -np.inf, rows[f]) for f in reversed(FIELDS[1:])]
    rows = rows[np.lexsort([*ranked, rows["us"]])]
    return rows[np.append(rows["us"][1:] != rows["us"][:-1], True)] if len(rows) else rows


def _told(symbol, rows: np.ndarray, outcome) -> pd.DataFrame:
    return pd.DataFrame({"symbol": [symbol] * len(rows), "ts": rows["us"].astype("datetime64[us]"), "chg_5m": rows["chg_5m"],
                         "vol_x_5m": rows["vol_x_5m"], "outcome": np.broadcast_to(np.asarray(outcome, object), len(rows))})
