"""Hourly volume and volatility models: frames, recursive forecasts, bands, back-tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.config import DEFAULTS, MARKET_SYMBOL, Settings
from tidewick.functions.timefn import shift
from tidewick.learning.boosting import Forest, train
from tidewick.operators import stats
from tidewick.operators.grid import LAGS, complete_hours, densify, lagged, with_clock
from tidewick.plans.serving import at, top_symbols
from tidewick.session import written

SHARED = ["lag1", "lag2", "lag3", "lag24", "roll24", "hour_sin", "hour_cos", "dow"]
VOLUME_INPUTS = SHARED
VOLATILITY_INPUTS = [*SHARED, "vol_lag1", "sym_mean"]
HISTORY = 24


def volume_frame(market: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Log market volume on a dense grid (holes stay NULL) with lags and clock features."""
    series = complete_hours(market, at(as_of)).select(F.lit(MARKET_SYMBOL).alias("symbol"), "hour_utc", F.log1p("vol_thb").alias("y"))
    return with_clock(lagged(densify(series, ["y"], None), min_roll=12))


def volatility_frame(hourly: DataFrame, coin_stats: DataFrame, as_of: dt.datetime, settings: Settings = DEFAULTS) -> DataFrame:
    """Log realised volatility of the top symbols, idle hours as 0, with lags and volume."""
    kept = complete_hours(hourly, at(as_of)).join(top_symbols(coin_stats, settings.top_symbols), "symbol", "left_semi")
    series = kept.select("symbol", "hour_utc", F.log1p("rv_pct").alias("y"), F.log1p("vol_thb").alias("lv"))
    frame = lagged(densify(series, ["y", "lv"], 0.0), min_roll=24)
    previous = F.lag("lv").over(Window.partitionBy("symbol").orderBy("hour_utc"))
    return with_clock(frame.withColumn("vol_lag1", previous))


def training_rows(frame: DataFrame) -> DataFrame:
    return frame.dropna()


def target_means(train: DataFrame) -> DataFrame:
    return train.groupBy("symbol").agg(F.avg("y").alias("sym_mean"))


def encode_symbol(rows: DataFrame, means: DataFrame) -> DataFrame:
    """Mean target per symbol; a symbol not seen in training gets the mean of the means."""
    unseen = means.agg(F.avg("sym_mean")).scalar()
    return rows.join(means, "symbol", "left").withColumn("sym_mean", F.coalesce("sym_mean", unseen))


def regressor(rows: DataFrame, inputs: list[str], settings: Settings, rounds: int | None = None) -> Forest:
    return train(rows, inputs, "y", rounds or settings.regress_rounds, settings.learning_rate)


def backtest(predicted: DataFrame, baseline: str, model_name: str, run_id: str) -> DataFrame:
    """Test rows in natural units: actual, predicted (log column ``prediction``), baseline."""
    return predicted.select(
        "symbol", "hour_utc", F.expm1("y").alias("actual"), F.expm1("prediction").alias("predicted"),
        F.expm1(baseline).alias("baseline"), F.lit(run_id).alias("run_id"), F.lit(model_name).alias("model_name"))


# ---- recursive forecasts
def _window_of(values: str, first: int, last: int) -> Column:
    """The values around a row, oldest first, keeping NULLs in place."""
    w = Window.partitionBy("symbol").orderBy("hour_utc").rowsBetween(first, last)
    return F.transform(F.collect_list(F.struct(values)).over(w), lambda s: s[values])


def test_origins(frame: DataFrame, cut: Column, horizon: int) -> DataFrame:
    """Start hours from one before the cut that have 24 hours behind and the horizon ahead."""
    w = Window.partitionBy("symbol").orderBy("hour_utc")
    placed = frame.withColumn("_pos", F.row_number().over(w) - 1).withColumn("actual", _window_of("y", 1, horizon))
    rows = _with_history(placed)
    usable = (F.col("hour_utc") >= shift(cut, hours=-1)) & (F.col("_pos") >= HISTORY) & (F.size("actual") == horizon)
    return rows.where(usable).drop("_pos")


def last_origins(frame: DataFrame) -> DataFrame:
    newest = frame.groupBy("symbol").agg(F.max("hour_utc").alias("hour_utc"))
    return _with_history(frame).join(newest, ["symbol", "hour_utc"], "left_semi")


def _with_history(frame: DataFrame) -> DataFrame:
    out = frame.withColumn("past", _window_of("y", 1 - HISTORY, 0))
    if "lv" in frame.columns:
        out = out.withColumn("past_lv", _window_of("lv", 1 - HISTORY, 0))
    keep = [c for c in ("symbol", "hour_utc", "past", "past_lv", "sym_mean", "actual", "_pos") if c in out.columns]
    return out.select(*keep)


def _mean(values: Column) -> Column:
    known = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known))


def forecast_paths(origins: DataFrame, model: Forest, horizon: int) -> DataFrame:
    """Predict ``horizon`` hours from every origin at once, feeding predictions back as lags.

    The state of an origin is the array of its last 24 values, so all origins and symbols
    advance together with one model pass per step. A missing lag is filled with the mean of
    the day, then 0. Volume of a future hour is taken from the same hour of the day before.
    """
    state = origins.withColumn("path", F.array().cast("array<double>"))
    carried = [*origins.columns, "path"]
    for h in range(1, horizon + 1):
        mean = F.coalesce(_mean(F.col("past")), F.lit(0.0))
        lags = {f"lag{k}": F.coalesce(F.element_at("past", -k), F.col("roll24")) for k in LAGS}
        step = with_clock(state.withColumn("roll24", mean).withColumn("_t", shift(F.col("hour_utc"), hours=h)), "_t").withColumns(lags)
        if "past_lv" in origins.columns:
            step = step.withColumn("vol_lag1", F.element_at("past_lv", -1 if h == 1 else h - 1))
        step = model.transform(step)
        newest = F.array(F.col("prediction"))
        state = step.withColumn("path", F.concat("path", newest)).withColumn(
            "past", F.concat(F.slice("past", 2, HISTORY - 1), newest)).select(*carried)
    return state


def error_band(paths: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Low and high quantile of actual minus path per symbol and step.

    A symbol gets a band only when every step has enough known errors.
    """
    zipped = F.posexplode(F.arrays_zip("actual", "path")).alias("_i", "_z")
    errors = paths.select("symbol", zipped).select(
        "symbol", (F.col("_i") + 1).alias("h"), (F.col("_z.actual") - F.col("_z.path")).alias("err"))
    # an hourly series has some 10,000 errors a year per step: small groups, which the built-in aggregate keeps as counts
    band = errors.where("err IS NOT NULL").groupBy("symbol", "h").agg(
        F.count("*").alias("n"), F.percentile("err", settings.band_low).alias("lo"), F.percentile("err", settings.band_high).alias("hi"))
    enough = band.groupBy("symbol").agg(F.min("n").alias("_least"), F.count("*").alias("_steps")).where(
        (F.col("_least") >= settings.band_min_samples) & (F.col("_steps") == settings.horizon_h))
    return band.join(enough, "symbol", "left_semi")


def bounds(y: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """Band edges in natural units, the lower one not below zero; NULL without a band."""
    lower = F.when(lo.isNotNull(), F.greatest(F.lit(0.0), F.expm1(y + lo)))
    return lower, F.expm1(y + hi)


def publish(frame: DataFrame, model: Forest, cut: Column, model_name: str, as_of: dt.datetime, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows for ``forecasts``: the next hours of every symbol with their error bounds.

    Test origins and the newest origin walk together; the stored paths then serve both the
    band and the forecast.
    """
    horizon = settings.horizon_h
    tested = test_origins(frame, cut, horizon).withColumn("ahead", F.lit(False))
    newest = last_origins(frame).withColumn("actual", F.lit(None).cast("array<double>")).withColumn("ahead", F.lit(True))
    paths = written(forecast_paths(tested.unionByName(newest), model, horizon), "paths")
    band = error_band(paths.where("NOT ahead"), settings)
    ahead = paths.where("ahead").select("symbol", "hour_utc", F.posexplode("path").alias("_i", "y"))
    rows = ahead.withColumn("h", F.col("_i") + 1).join(band.select("symbol", "h", "lo", "hi"), ["symbol", "h"], "left")
    lower, upper = bounds(F.col("y"), F.col("lo"), F.col("hi"))
    return rows.select(
        "symbol", (F.col("hour_utc") + F.make_dt_interval(F.lit(0), F.col("h"))).alias("target_hour_utc"),
        F.expm1("y").alias("predicted"), at(as_of).alias("generated_at"), lower.alias("lower"), upper.alias("upper"),
        F.lit(model_name).alias("model_name"))


# ---- training runs
def enough_hours(hours: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: hours seen, hours needed and whether that is enough."""
    return hours.agg(F.count_distinct("hour_utc").alias("have")).select(
        "have", F.lit(settings.min_hours).cast("bigint").alias("need"), (F.col("have") >= settings.min_hours).alias("ok"))


def train_volume(frame: DataFrame, settings: Settings = DEFAULTS, rounds: int | None = None) -> tuple[Forest, DataFrame]:
    """The model and its predictions on the held-out last part of the series."""
    split = stats.time_split(training_rows(frame), "hour_utc", settings.test_share)
    model = regressor(split.where("NOT is_test"), VOLUME_INPUTS, settings, rounds)
    return model, model.transform(split.where("is_test"))


def train_volatility(frame: DataFrame, settings: Settings = DEFAULTS, rounds: int | None = None) -> tuple[Forest, DataFrame, DataFrame]:
    """As ``train_volume``; also returns the symbol means, fitted on the training part."""
    split = stats.time_split(training_rows(frame), "hour_utc", settings.test_share)
    means = target_means(split.where("NOT is_test"))
    encoded = encode_symbol(split, means)
    model = regressor(encoded.where("NOT is_test"), VOLATILITY_INPUTS, settings, rounds)
    return model, model.transform(encoded.where("is_test")), means
