import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import minute
from tidewick.config import Settings
from tidewick.learning import anomaly, forecast, registry, warning
from tidewick.operators import grid, sampling, stats
from tidewick.plans import serving


def test_densify_hole_and_clock_lags(spark):
    rows = [("A", minute(60 * h), float(h + 1)) for h in (0, 1, 5)]
    series = spark.createDataFrame(rows, "symbol string, hour_utc timestamp_ntz, y double")
    null = [r["y"] for r in grid.densify(series, ["y"], None).orderBy("hour_utc").collect()]
    assert null == [1.0, 2.0, None, None, None, 6.0]
    zero = grid.lagged(grid.densify(series, ["y"], 0.0), 24).orderBy("hour_utc").collect()
    assert [r["y"] for r in zero] == [1.0, 2.0, 0.0, 0.0, 0.0, 6.0]
    assert zero[5]["lag1"] == 0.0 and zero[2]["lag1"] == 2.0


def test_average_percentile_rank(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 2.0, 3.0])], "i int, v double")
    got = {r["i"]: r["p"] for r in stats.average_rank(df, "v", "p").collect()}
    assert got == {0: 0.25, 1: 0.625, 2: 0.625, 3: 1.0}


def test_auc_with_tie(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.8)], "label int, score double")
    assert stats.roc_auc(df, "label", "score").first()[0] == 0.875
    assert stats.roc_auc(df.where("label = 1"), "label", "score").first()[0] is None


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(4)
    values = {k: np.round(rng.normal(0, 50, 301), 1) for k in "ab"}
    df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None)], "k string, v double")
    for r in stats.exact_quantiles(df, ["k"], "v", {"lo": 0.1, "mid": 0.5, "hi": 0.9}).collect():
        assert np.allclose([r["lo"], r["mid"], r["hi"]], np.quantile(values[r["k"]], [0.1, 0.5, 0.9]))
        assert r["n"] == 301


def test_constant_series_has_no_correlation(spark):
    rows = [(s, minute(60 * h), 5.0 if s == "A" else 5.0 + h * h % 7) for s in "AB" for h in range(30)]
    hourly = spark.createDataFrame(rows, "symbol string, hour_utc timestamp_ntz, close double")
    top = spark.createDataFrame([("A",), ("B",)], "symbol string")
    got = {(r["a"], r["b"]): r["c"] for r in stats.correlation_matrix(stats.hourly_returns(hourly), top).collect()}
    assert got[("A", "B")] is None and got[("A", "A")] is None and abs(got[("B", "B")] - 1) < 1e-9


def test_split_cut(spark):
    df = spark.createDataFrame([(minute(m),) for m in range(10)], "t timestamp_ntz")
    assert stats.split_cut(df, "t").first()["cut"] == minute(8)
    assert stats.time_split(df, "t").where("is_test").count() == 2


def test_champion_gate(spark):
    def trial(value, baseline, has_model=True):
        return spark.createDataFrame([("m", "MAPE", value, baseline, False, has_model)],
                                     "model_name string, metric string, value double, baseline double, higher_is_better boolean, has_model boolean")

    log = spark.createDataFrame([("m", "MAPE", 5.0, True, minute(0)), ("m", "MAPE", 1.0, False, minute(1))],
                                "model_name string, metric string, value double, deployed boolean, run_at timestamp_ntz")
    got = [registry.decide(log, trial(*a)).first()["deployed"] for a in ((5.0, 6.0), (5.1, 6.0), (4.9, 4.9), (4.0, None), (4.0, 6.0, False))]
    assert got == [True, False, False, True, False]


def test_replay_agrees_with_one_decision_at_a_time(spark):
    rows = [("m", "AUC", v, b, True, True, minute(i)) for i, (v, b) in enumerate(
        [(0.5, 0.6), (0.7, 0.6), (0.65, 0.6), (0.7, 0.6), (0.9, 0.95), (0.8, None)])]
    cols = "model_name string, metric string, value double, baseline double, higher_is_better boolean, has_model boolean, run_at timestamp_ntz"
    got = [r["deployed"] for r in registry.replay(spark.createDataFrame(rows, cols)).orderBy("run_at").collect()]
    champion, want = None, []
    for _, _, v, b, *_ in rows:
        win = (b is None or v > b) and (champion is None or v >= champion)
        champion = v if win else champion
        want.append(win)
    assert got == want


def test_mape_skips_and_counts_zero_actuals(spark):
    df = spark.createDataFrame([(10.0, 11.0, 8.0), (0.0, 3.0, 1.0)], "actual double, predicted double, baseline double")
    row = stats.regression_scores(df).first()
    assert row["zero_actuals"] == 1 and abs(row["mape"] - 10) < 1e-9 and abs(row["baseline_mape"] - 20) < 1e-9


@pytest.mark.parametrize("n", [1, 37, 500, 5000])
def test_sample_is_exact_and_independent_of_partitions(spark, n):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    a = {r["id"] for r in sampling.hash_sample(df, [F.col("id")], n, 42).collect()}
    b = {r["id"] for r in sampling.hash_sample(df.repartition(7), [F.col("id")], n, 42).collect()}
    assert a == b and len(a) == min(n, 1000)


def test_outcomes(spark):
    df = spark.createDataFrame([(minute(0), 0.2), (minute(0), None), (minute(30), 0.5)], "ts timestamp_ntz, gain double")
    got = [r[0] for r in df.select(warning.outcome(F.col("ts"), F.lit(minute(60)), F.col("gain"))).collect()]
    assert got == ["pump", "no", "tracking"]


def hours(spark, n, symbols=("A",)):
    rows = [(s, minute(60 * h), 1.0 + ((h % 24) + (3 if s == "B" else 0)) / 10) for s in symbols for h in range(n)]
    return spark.createDataFrame(rows, "symbol string, hour_utc timestamp_ntz, y double")


def test_forecast_learns_a_daily_cycle_and_publishes_bands(spark):
    frame = grid.with_clock(grid.lagged(grid.densify(hours(spark, 24 * 20), ["y"], None), 12))
    settings = Settings()
    model, predicted = forecast.train_volume(frame, settings)
    flat = predicted.agg(F.stddev_pop("y")).first()[0]
    error = predicted.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)))).first()[0]
    assert error < flat / 4
    cut = stats.split_cut(forecast.training_rows(frame), "hour_utc").scalar()
    out = forecast.publish(frame, model, cut, "volume_forecast", minute(60 * 24 * 20), settings).orderBy("target_hour_utc").collect()
    assert [r["target_hour_utc"] for r in out] == [minute(60 * (24 * 20 + k)) for k in range(6)]
    assert all(r["lower"] <= r["upper"] for r in out)


def test_recursive_path_feeds_predictions_back(spark):
    """With a model that returns lag1 + 1 the path counts up from the last value."""
    class PlusOne:
        def transform(self, df):
            return df.withColumn("prediction", F.col("lag1") + 1 + 0 * F.col("lag24"))

    frame = hours(spark, 40)
    last = frame.orderBy(F.desc("hour_utc")).first()["y"]
    path = forecast.forecast_paths(forecast.last_origins(frame), PlusOne(), 6).first()["path"]
    assert np.allclose(path, [last + k for k in range(1, 7)])


def test_volume_of_future_hours_comes_from_the_day_before(spark):
    class Echo:
        def transform(self, df):
            return df.withColumn("prediction", F.col("vol_lag1"))

    frame = hours(spark, 60).withColumn("lv", F.unix_seconds(F.col("hour_utc").cast("timestamp")) / 3600)
    path = forecast.forecast_paths(forecast.last_origins(frame), Echo(), 6).first()["path"]
    last = frame.agg(F.max("lv")).first()[0]
    assert path == [last] + [last + h - 1 - 24 for h in range(2, 7)]


def test_bands_need_enough_samples(spark):
    frame = hours(spark, 24 * 6)
    cut = F.lit(minute(60 * 24 * 3)).cast("timestamp_ntz")
    origins = forecast.test_origins(frame, cut, 6).withColumn("path", F.array_repeat(F.element_at("past", -1), 6))
    assert forecast.error_band(origins).count() == 6
    late = forecast.test_origins(frame, F.lit(minute(60 * 24 * 5)).cast("timestamp_ntz"), 6)
    assert forecast.error_band(late.withColumn("path", F.array_repeat(F.element_at("past", -1), 6))).count() == 0


def test_isolation_forest_ranks_an_outlier_first_and_repeats(spark):
    rng = np.random.default_rng(0)
    rows = [(f"e{i}", *map(float, rng.normal(0, 1, 7))) for i in range(400)] + [("odd", *[9.0] * 7)]
    df = spark.createDataFrame(rows, "event_id string, " + ", ".join(f"{c} double" for c in anomaly.INPUTS))
    settings = Settings(forest_trees=60, forest_sample=64)
    a = anomaly.raw_scores(df, anomaly.grow_forest(df, settings), settings)
    assert a.orderBy(F.desc("raw")).first()["event_id"] == "odd"
    again = df.repartition(5)
    b = anomaly.raw_scores(again, anomaly.grow_forest(again, settings), settings)
    assert {r["event_id"]: r["raw"] for r in a.collect()} == {r["event_id"]: r["raw"] for r in b.collect()}


def test_each_tree_sees_exactly_the_sample(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("event_id"), *[F.rand(i).alias(c) for i, c in enumerate(anomaly.INPUTS)])
    sizes = anomaly._subsamples(df, Settings(forest_trees=20)).groupBy("tree").count().collect()
    assert len(sizes) == 20 and all(r["count"] >= 256 for r in sizes)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert sorted(map(tuple, serving.latest_per(df, ["k"], ["t"]).collect())) == [("a", 2, "y"), ("b", 1, "z")]
