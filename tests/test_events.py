import datetime as dt
import itertools
import random

from tests.conftest import bars, minute
from tidewick.config import Settings
from tidewick.functions.timefn import MINUTE, micros
from tidewick.operators import candles, events, ranges

SIGNAL = "symbol string, ts timestamp_ntz, open_5m double, chg_5m double, vol_x_5m double, active_share_1d double, vol5_thb double"


def signals(spark, minutes, symbol="A"):
    return spark.createDataFrame([(symbol, minute(m), 10.0, 0.06, 6.0, 0.5, 1.0) for m in minutes], SIGNAL)


def silver(spark, rows, symbol="A"):
    """Features without detection: enough to measure paths on."""
    return candles.minute_features(bars(spark, rows, symbol))


def facts(spark, start, last, base=10.0, symbol="A"):
    return spark.createDataFrame(
        [(symbol, 1, minute(start), minute(last), base, 6.0, 6.0, 1, 0.5)],
        "symbol string, eid long, start_ts timestamp_ntz, last_signal_ts timestamp_ntz, base_price double, max_vol_x double, "
        "max_chg_5m_pct double, signal_minutes long, active_share_1d double")


def test_gap_of_exactly_thirty_minutes_merges(spark):
    got = events.session_facts(events.sessions(signals(spark, [0, 30, 61]))).orderBy("eid").collect()
    assert [(r["eid"], r["start_ts"], r["last_signal_ts"]) for r in got] == [(1, minute(0), minute(30)), (2, minute(61), minute(61))]


def test_sessions_across_blocks(spark):
    """A chain of signals over many blocks is one session, whatever the block length."""
    chain = [28 * k for k in range(2000)] + [2000 * 28 + 100]
    for days in (1, 7, 28):
        got = events.session_facts(events.sessions(signals(spark, chain), Settings(block_days=days))).collect()
        assert sorted((r["eid"], r["signal_minutes"]) for r in got) == [(1, 2000), (2, 1)]


def test_refractory_keeps_by_gap_not_by_last_kept(spark):
    got = events.refractory_triggers(signals(spark, [0, 20, 40, 71, 101, 132]), 30).orderBy("ts").collect()
    assert [r["ts"] for r in got] == [minute(0), minute(71), minute(132)]


def test_peak_tie_takes_the_earliest(spark):
    sv = silver(spark, [(0, 10), (1, 12), (2, 12), (3, 11)])
    for df in (events.event_peaks(facts(spark, 0, 0), sv), events.event_paths(facts(spark, 0, 0), sv)):
        assert df.first()["peak_ts"] == minute(1)


def test_peak_search_starts_before_the_signal(spark):
    sv = silver(spark, [(0, 20), (5, 11), (6, 12)])
    row = events.measured(events.event_paths(facts(spark, 5, 6), sv)).first()
    assert row["peak_ts"] == minute(0) and row["minutes_to_peak"] == -5.0


def test_no_candle_after_the_peak(spark):
    row = events.measured(events.event_paths(facts(spark, 0, 0), silver(spark, [(0, 12)]))).first()
    assert row["min_low_after"] is None and row["dump_pct"] is None and row["is_pump_dump"] is False


def test_half_way_close_counts_as_retraced(spark):
    sv = silver(spark, [(0, 20), (3, 15)])
    row = events.measured(events.event_paths(facts(spark, 0, 0), sv)).first()
    assert row["is_pump_dump"] and row["minutes_to_half_retrace"] == 3.0 and row["retrace_share"] == 0.5


def test_after_window_is_half_open(spark):
    sv = silver(spark, [(0, 20), (60, 9), (61, 1)])
    assert events.event_paths(facts(spark, 0, 0), sv).first()["min_low_after"] == 9.0


def test_zero_base_price_is_dropped(spark):
    assert events.measured(events.event_paths(facts(spark, 0, 0, base=0.0), silver(spark, [(0, 12)]))).count() == 0


def starts(spark, rows):
    return spark.createDataFrame([(f"{s}{i}", s, t) for i, (s, t) in enumerate(rows)], "event_id string, symbol string, start_ts timestamp_ntz")


def test_concurrency_boundary(spark):
    df = starts(spark, [("A", minute(0)), ("B", minute(10)), ("C", minute(10) + dt.timedelta(seconds=1))])
    got = {r["symbol"]: r["concurrent_symbols"] for r in events.with_concurrency(df).collect()}
    assert got == {"A": 1, "B": 2, "C": 1}


def test_concurrency_equals_pairwise_count(spark):
    rng = random.Random(11)
    rows = list({(f"S{rng.randrange(8)}", minute(rng.randrange(3 * 24 * 60))) for _ in range(700)})
    got = {r["event_id"]: r["concurrent_symbols"] for r in events.with_concurrency(starts(spark, rows)).collect()}
    for i, (s, t) in enumerate(rows):
        near = {o for o, u in rows if o != s and abs((u - t).total_seconds()) <= 600}
        assert got[f"{s}{i}"] == len(near)


def test_range_join_equals_plain_join(spark):
    rng = random.Random(3)
    spans = [(rng.choice("AB"), i, a := rng.randrange(10_000) * MINUTE, a + rng.randrange(400) * MINUTE) for i in range(60)]
    points = [(rng.choice("AB"), rng.randrange(10_500) * MINUTE) for _ in range(800)]
    a = spark.createDataFrame(spans, "symbol string, i long, lo long, hi long")
    b = spark.createDataFrame(points, "symbol string, at long")
    got = sorted((r["i"], r["at"]) for r in ranges.range_join(a, b, ["symbol"], "lo", "hi", "at").collect())
    want = sorted((i, p) for (s, i, lo, hi), (q, p) in itertools.product(spans, points) if s == q and lo <= p <= hi)
    assert got == want


def test_scores_survive_a_refresh(spark):
    fresh = starts(spark, [("A", minute(0)), ("B", minute(1))])
    old = spark.createDataFrame([("A0", 0.7), ("gone", 0.2)], "event_id string, anomaly_score double")
    got = {r["event_id"]: r["anomaly_score"] for r in events.carry_scores(fresh, old).collect()}
    assert got == {"A0": 0.7, "B1": None}


def test_fused_paths_equal_separate_joins(spark):
    from tests.conftest import SF
    from tidewick.sources import bindings as B

    sv = candles.build_silver(B.b1(spark, SF)).persist()
    f = events.session_facts(events.sessions(events.candidates(sv)))
    peaks = f.join(events.event_peaks(f, sv), ["symbol", "eid"])
    two = peaks.join(events.event_aftermath(peaks, sv), ["symbol", "eid"])
    cols = ["symbol", "eid", "peak_price", "peak_ts", "min_low_after", "half_retrace_ts"]
    assert sorted(map(str, two.select(cols).collect())) == sorted(map(str, events.event_paths(f, sv).select(cols).collect()))
    sv.unpersist()


def test_micros_is_utc(spark):
    assert spark.sql("SELECT timestamp_ntz'1970-01-01 00:00:01' AS t").select(micros("t")).first()[0] == 1_000_000
