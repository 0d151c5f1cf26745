import dataclasses
import random

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import SF, T0, bars, minute
from tidewick.config import Settings
from tidewick.functions.timefn import DAY, MINUTE, micros
from tidewick.operators import candles
from tidewick.sources import bindings as B


def feature(df, name):
    return {r["ts"]: r[name] for r in df.select("ts", name).collect()}


def test_latest_pull_wins(spark):
    rows = [("A", T0, 1.0, 1.0, 1.0, float(k), 1.0, minute(k)) for k in (1, 3, 2)]
    df = spark.createDataFrame(rows, bars(spark, [(0, 1)]).schema)
    assert [r["close"] for r in candles.latest_candles(df).collect()] == [3.0]


def test_latest_pull_with_equal_times_is_deterministic(spark):
    rows = [("A", T0, 1.0, 1.0, 1.0, c, 1.0, T0) for c in (5.0, 9.0, 7.0)]
    df = spark.createDataFrame(rows, bars(spark, [(0, 1)]).schema)
    for parts in (1, 3):
        assert candles.latest_candles(df.repartition(parts)).first()["close"] == 9.0


def test_frame_boundaries(spark):
    df = candles.minute_features(bars(spark, [(m, m + 1) for m in (0, 1, 4, 5, 14, 15, 60, 61)]))
    opens, base = feature(df, "open_5m"), feature(df, "base_vpm_thb")
    assert opens[minute(5)] == 2.0  # members 1, 4, 5
    ahead = feature(df, "max_high_next60")
    assert ahead[minute(0)] == 61.0 and ahead[minute(61)] is None
    later = feature(df, "close_next15")
    assert later[minute(0)] == 16.0 and later[minute(4)] is None
    assert base[minute(4)] is None and base[minute(5)] == 1.0 / 10080


def test_history_gate_opens_after_a_day(spark):
    df = candles.minute_features(bars(spark, [(0, 2), (24 * 60 - 1, 2), (24 * 60, 2)]))
    vol_x = feature(df, "vol_x_5m")
    assert vol_x[minute(24 * 60 - 1)] is None and vol_x[minute(24 * 60)] is not None


def test_zero_prices_give_null_not_errors(spark):
    df = candles.minute_features(bars(spark, [(0, 0), (1, 5)]))
    row = {r["ts"]: r for r in df.collect()}
    assert row[minute(0)]["range_1m"] is None and row[minute(1)]["chg_5m"] is None and row[minute(1)]["ret_1m"] is None


def test_single_candle(spark):
    row = candles.minute_features(bars(spark, [(0, 3)])).first()
    assert row["gap_min"] is None and row["base_vpm_thb"] is None and row["active_share_1d"] == 1 / 1440


def test_previous_candle_far_before_the_halo(spark):
    far = 40 * 24 * 60
    row = {r["ts"]: r for r in candles.minute_features(bars(spark, [(0, 4), (far, 5)])).collect()}
    assert row[minute(far)]["gap_min"] == far and row[minute(far)]["ret_1m"] == 0.25


def test_idle_baseline_is_exact_after_heavy_trading(spark):
    """Prefix differences must leave nothing behind of volume that left the window."""
    heavy = [(m, 1, 1, 1, 1, 1e12 / 3) for m in range(3)]
    quiet = [(8 * 24 * 60, 1, 1, 1, 1, 0), (8 * 24 * 60 + 10, 1, 1, 1, 1, 0)]
    df = candles.minute_features(bars(spark, heavy + quiet))
    assert feature(df, "base_vpm_thb")[minute(8 * 24 * 60 + 10)] == 0.0


def test_blocks_do_not_change_results(spark):
    """One symbol over 70 days: any block length and partition count equals plain windows."""
    rng = random.Random(5)
    rows = sorted({rng.randrange(70 * 24 * 60) for _ in range(1500)})
    df = bars(spark, [(m, rng.randint(1, 50) + 0.25) for m in rows])
    want = None
    for days, parts in ((7, 1), (28, 5), (365, 3)):
        got = candles.minute_features(df.repartition(parts), Settings(block_days=days)).orderBy("ts").collect()
        want = want or got
        assert got == want
    w = Window.partitionBy("symbol").orderBy("_us")
    plain = candles.with_quote_volume(df).withColumn("_us", micros("ts")).select(
        "ts", (F.sum("vol_thb").over(w.rangeBetween(-7 * DAY, -5 * MINUTE)) / 10080.0).alias("base"),
        (F.count("*").over(w.rangeBetween(-DAY, 0)) / 1440.0).alias("share"), F.lag("close").over(w).alias("prev"),
        F.min("low").over(w.rangeBetween(MINUTE, 60 * MINUTE)).alias("low60")).orderBy("ts").collect()
    for mine, ref in zip(want, plain):
        assert mine["active_share_1d"] == ref["share"] and mine["min_low_next60"] == ref["low60"]
        assert (mine["base_vpm_thb"] is None) == (ref["base"] is None)
        if ref["base"] is not None:
            assert abs(mine["base_vpm_thb"] - ref["base"]) < 1e-9
        if ref["prev"]:
            assert mine["ret_1m"] == mine["close"] / ref["prev"] - 1


def test_same_pull_again_changes_nothing(spark):
    once = B.b1(spark, SF)
    again = once.unionByName(once.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")))
    a = candles.build_silver(once).orderBy("symbol", "ts").collect()
    assert a == candles.build_silver(again).orderBy("symbol", "ts").collect()


def test_quality_counts(spark):
    df = bars(spark, [(0, 1), (1, 1), (3, 1)])
    df = df.unionByName(df.limit(2).withColumn("ingested_at", F.lit(minute(9))))
    row = candles.data_quality(df).first()
    assert (row["bronze_rows"], row["duplicates"], row["candles"], row["bronze_files"], row["active_share"]) == (5, 2, 3, 2, 0.75)


def test_empty_input(spark):
    empty = bars(spark, [(0, 1)]).where("false")
    assert candles.build_silver(empty).count() == 0
    assert candles.data_quality(empty).count() == 0


def test_no_label_column_feeds_the_models():
    from tidewick.learning import direction, forecast, warning

    used = {*warning.INPUTS, *direction.INPUTS, *forecast.VOLUME_INPUTS, *forecast.VOLATILITY_INPUTS}
    assert not used & {"max_high_next60", "min_low_next60", "close_next15", "future_gain", "fwd_ret"}


def test_settings_are_frozen():
    with pytest.raises(dataclasses.FrozenInstanceError):
        Settings().block_days = 1


def test_edge_is_the_newest_pull_of_the_last_minute(spark):
    """A later pull holds an old copy of a block's last minute and a new copy of another."""
    first = bars(spark, [(0, 1), (10, 2)])
    second = bars(spark, [(0, 1), (10, 9)]).withColumn("ingested_at", F.expr("ingested_at + if(close = 1, 1, -1) * INTERVAL 1 HOUR"))
    later = bars(spark, [(60 * 24 * 40, 3)])
    known = candles.block_summary(first, version="ingested_at").union(candles.block_summary(second, version="ingested_at")).union(candles.block_summary(later, version="ingested_at"))
    assert [r._edge_close for r in candles.edges(known).collect() if r._edge_close is not None] == [2.0]
