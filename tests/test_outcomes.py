"""Outcomes told by the stream against brute force over all rows that came in time."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import T0, minute
from tidewick.schemas import SCHEMAS
from tidewick.session import fresh_path
from tidewick.streaming import jobs, outcomes

COLUMNS = "symbol string, ts timestamp_ntz, high double, open_5m double, chg_5m double, vol_x_5m double"


def told(spark, batches, delay=0):
    """(symbol, minute, high, open_5m, chg_5m, vol_x_5m) per batch; every word of the stream."""
    landing, out = fresh_path(spark, "landing"), fresh_path(spark, "told")
    for rows in batches:
        spark.createDataFrame([(s, minute(m), *rest) for s, m, *rest in rows], COLUMNS).coalesce(1).write.mode("append").parquet(landing)
    stream = outcomes.outcomes(jobs.landed(spark, landing, "silver_features", files_per_batch=1), delay)
    jobs.to_table(stream, out, fresh_path(spark, "mark")).awaitTermination()
    return spark.read.schema(outcomes.TOLD).parquet(out)


def words(frame):
    return sorted(((r["symbol"] or "", int((r["ts"] - T0).total_seconds() // 60), r["outcome"]) for r in frame.collect()))


def slow(rows, now):
    """Last word on each trigger, from all rows up to ``now``."""
    result = []
    for symbol in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == symbol and r[1] <= now)
        signals = [r for r in mine if r[4] is not None and r[5] is not None and r[4] >= 0.03 and r[5] >= 3]
        for i, (_, m, _, base, _, _) in enumerate(signals):
            if i and m - signals[i - 1][1] <= 30:
                continue
            highs = [r[2] for r in mine if m < r[1] <= m + 60]
            pumped = bool(highs) and bool(base) and max(highs) / base - 1 >= 0.10
            result.append((symbol, m, "tracking" if now - m < 60 else "pump" if pumped else "no"))
    return sorted(result)


def test_a_trigger_is_told_twice(spark):
    rows = [("A", 0, 1.0, 1.0, 0.05, 4.0), ("A", 10, 1.2, 1.0, 0.05, 4.0), ("B", 1, 1.0, 1.0, 0.05, 4.0)]
    got = words(told(spark, [rows, [("A", 60, 1.0, 1.0, 0.0, 0.0)], [("B", 200, 9.0, 1.0, 0.0, 0.0)]]))
    assert got == [("A", 0, "pump"), ("A", 0, "tracking"), ("B", 1, "no"), ("B", 1, "tracking")]


def test_young_trigger_stays_tracking(spark):
    assert words(told(spark, [[("A", 0, 1.0, 1.0, 0.05, 4.0), ("A", 59, 2.0, 1.0, 0.0, 0.0)]])) == [("A", 0, "tracking")]


def test_missing_values_and_null_symbol(spark):
    rows = [(None, 0, None, None, 0.05, 4.0), ("A", 0, 1.0, 1.0, None, 4.0), ("A", 1, None, 0.0, 0.05, 4.0), ("A", 2, 5.0, 1.0, 0.0, None), ("C", 99, 1.0, 1.0, 0.0, 0.0)]
    assert words(outcomes.current(told(spark, [rows]))) == [("", 0, "no"), ("A", 1, "no")]


def test_empty_stream(spark):
    assert words(told(spark, [[]])) == []


def test_repeated_minutes_count_once(spark):
    row = ("A", 0, 1.0, 1.0, 0.05, 4.0)
    assert words(told(spark, [[row, row, ("A", 5, 1.0, 1.0, 0.0, 0.0), ("A", 5, 2.0, 1.0, 0.0, 0.0), ("A", 70, 1.0, 1.0, 0.0, 0.0)]])) == [
        ("A", 0, "pump"), ("A", 0, "tracking")]


@pytest.mark.parametrize("delay", [0, 45])
def test_random_streams_across_midnight(spark, delay):
    """Rows shuffled within the delay, triggers around day ends, several symbols."""
    rng = np.random.default_rng(delay)
    rows = []
    for symbol in "ABC":
        for m in np.unique(rng.integers(1200, 1700, 160)):
            hot = rng.random() < 0.2
            rows.append((symbol, int(m), float(rng.choice([0.9, 1.0, 1.12])), 1.0, 0.05 if hot else 0.0, 4.0))
    arrival = {id(r): r[1] + (rng.uniform(0, delay) if delay else 0) for r in rows}
    rows.sort(key=lambda r: arrival[id(r)])
    cuts = [0, *sorted(rng.choice(len(rows), 3, replace=False)), len(rows)]
    batches = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    if not delay:  # without a delay batches follow each other in time
        batches = [[r for r in rows if lo <= r[1] < hi] for lo, hi in ((0, 1400), (1400, 1440), (1440, 1500), (1500, 2000))]
    now = max(r[1] for r in rows) - delay
    frame = told(spark, batches, delay)
    assert words(outcomes.current(frame)) == slow(rows, now)
    assert frame.groupBy("symbol", "ts", "outcome").count().where("count > 1").count() == 0


def test_late_rows_change_nothing_told(spark):
    first, late = [("A", 0, 1.0, 1.0, 0.05, 4.0), ("A", 100, 1.0, 1.0, 0.0, 0.0)], [("A", 30, 9.0, 1.0, 0.05, 4.0), ("A", 160, 1.0, 1.0, 0.0, 0.0)]
    got = words(told(spark, [first, [("A", 110, 1.0, 1.0, 0.0, 0.0)], late]))
    assert got == [("A", 0, "no"), ("A", 0, "tracking")]
