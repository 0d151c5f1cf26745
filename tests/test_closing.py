"""Closed sessions against brute force over all signals, late ones included."""

import numpy as np
import pytest

from tests.conftest import T0, minute
from tidewick.session import fresh_path
from tidewick.sources.lake import LakeTables
from tidewick.streaming import closing, jobs


def run(spark, batches, delay=0):
    landing, job = fresh_path(spark, "landing"), closing.ClosingSessions(LakeTables(spark, fresh_path(spark, "lake")), delay_min=delay)
    for rows in batches:
        made = [(s, minute(m), 1.0 + m, 0.10 if hot else 0.0, 20.0, 0.5) for s, m, hot in rows]
        spark.createDataFrame(made, closing.SIGNAL).coalesce(1).write.mode("append").parquet(landing)
    job.run(jobs.landed(spark, landing, "silver_features", files_per_batch=1))
    return job


def told(job):
    at = lambda ts: int((ts - T0).total_seconds() // 60)
    return sorted((r["symbol"], at(r["start_ts"]), at(r["last_signal_ts"]), r["signal_minutes"], r["base_price"]) for r in job.current().collect())


def slow(rows, passed):
    result = []
    for symbol in {r[0] for r in rows}:
        runs = []
        for m in sorted(r[1] for r in rows if r[0] == symbol and r[2]):
            if runs and m - runs[-1][-1] <= 30:
                runs[-1].append(m)
            else:
                runs.append([m])
        result += [(symbol, r[0], r[-1], len(r), 1.0 + r[0]) for r in runs if r[-1] + 30 < passed]
    return sorted(result)


def test_gap_end_belongs_to_the_session(spark):
    rows = [("A", 0, True), ("A", 30, True), ("A", 61, True), ("A", 200, False)]
    assert told(run(spark, [rows])) == [("A", 0, 30, 2, 1.0), ("A", 61, 61, 1, 62.0)]


def test_open_session_is_not_told(spark):
    assert told(run(spark, [[("A", 0, True), ("A", 30, False)]])) == []


def test_empty_batch_and_no_signals(spark):
    assert told(run(spark, [[]])) == [] and told(run(spark, [[("A", 0, False)], []])) == []


def test_late_signal_joins_two_sessions(spark):
    job = run(spark, [[("A", 0, True), ("A", 50, True), ("B", 3, True)], [("A", 300, False)], [("A", 25, True), ("C", 5, False)]])
    assert job.late().count() == 1
    assert told(job) == [("A", 0, 50, 3, 1.0), ("B", 3, 3, 1, 4.0)]


@pytest.mark.parametrize("delay", [0, 40])
def test_random_landings_lose_no_signal(spark, delay):
    rng = np.random.default_rng(delay)
    rows = [(s, int(m), bool(rng.random() < 0.3)) for s in "ABCDE" for m in np.unique(rng.integers(0, 900, 120))]
    order = sorted(rows, key=lambda r: r[1] + (r[0] < "D") * rng.uniform(0, 120))
    cuts = [0, *sorted(rng.choice(len(rows), 3, replace=False)), len(rows)]
    job = run(spark, [order[a:b] for a, b in zip(cuts, cuts[1:])], delay)
    assert job.late().count() > 0
    assert told(job) == slow(rows, max(r[1] for r in rows) - delay)
