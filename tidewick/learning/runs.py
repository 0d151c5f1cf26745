"""Complete training runs over lake tables: gate, train, score, decide, log, publish."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidewick.config import DEFAULTS, Settings
from tidewick.learning import anomaly, direction, forecast, registry, warning
from tidewick.operators import stats
from tidewick.plans.serving import top_symbols
from tidewick.sources.lake import LakeTables


def _passes(gate: DataFrame) -> bool:
    """Gates are one-row frames; a run stops early on a failed one."""
    return bool(gate.select("ok").first()[0])


def _settle(lake, store, run_id, scores: DataFrame, counts, model, side=None) -> bool:
    """Compare with baseline and champion, deploy on a win, log either way."""
    decided = registry.decide(lake.read("model_metrics"), scores).persist()
    try:
        won = bool(decided.select("deployed").first()[0])
        if won and model is not None:
            store.deploy(scores.select("model_name").first()[0], run_id, model, side)
        named = [F.col(c).alias(c.removeprefix("x_")) for c in scores.columns if c.startswith("x_")]
        extra = F.to_json(F.struct(*named)) if named else F.lit("{}")
        registry.log_trial(lake, decided, *counts, extra)
        return won
    finally:
        decided.unpersist()


def _trial(row: DataFrame, name: str, metric: str, value: str, baseline: str, higher: bool, has_model: bool = True, extra=()) -> DataFrame:
    return row.select(
        F.lit(name).alias("model_name"), F.lit(metric).alias("metric"), F.col(value).alias("value"), F.col(baseline).alias("baseline"),
        F.lit(higher).alias("higher_is_better"), F.lit(has_model).alias("has_model"), *[F.col(c).alias(f"x_{c}") for c in extra])


def _sizes(split: DataFrame) -> tuple[int, int]:
    row = split.agg(F.count(F.when(~F.col("is_test"), 1)), F.count(F.when(F.col("is_test"), 1))).first()
    return row[0], row[1]


def republish(lake: LakeTables, model: str, rows: DataFrame) -> None:
    """Replace the model's forecasts and add them to the history. Repeating it adds nothing twice."""
    lake.replace_slice("forecasts", "model_name", model, rows)
    lake.append_new("forecast_history", rows.select(
        "model_name", "symbol", "target_hour_utc", "predicted", "generated_at", "lower", "upper"), ["model_name", "symbol", "target_hour_utc", "generated_at"])


def volume(lake: LakeTables, store: registry.ModelStore, run_id: str, as_of: dt.datetime, settings: Settings = DEFAULTS) -> bool | None:
    market = lake.read("market_hourly")
    frame = forecast.volume_frame(market, as_of)
    if not _passes(forecast.enough_hours(frame.where("y IS NOT NULL"), settings)):
        return None
    rows = forecast.training_rows(frame)
    lake.save_dataset("volume_forecast", run_id, rows)
    split = stats.time_split(rows, "hour_utc", settings.test_share)
    model, predicted = forecast.train_volume(frame, settings)
    tested = forecast.backtest(predicted, "lag24", "volume_forecast", run_id)
    lake.replace_slice("forecast_backtest", "model_name", "volume_forecast", tested)
    scores = _trial(stats.regression_scores(tested), "volume_forecast", "MAPE", "mape", "baseline_mape", False, extra=["zero_actuals"])
    won = _settle(lake, store, run_id, scores, _sizes(split), model)
    publish_volume(lake, store, as_of, settings)
    return won


def publish_volume(
    lake: LakeTables, store: registry.ModelStore, as_of: dt.datetime, settings: Settings = DEFAULTS, market: DataFrame | None = None
) -> None:
    """Forecast with the deployed model, without training; from the current market hours or from those given."""
    model = store.load("volume_forecast")
    if model is None:
        return
    frame = forecast.volume_frame(lake.read("market_hourly") if market is None else market, as_of)
    cut = stats.split_cut(forecast.training_rows(frame), "hour_utc", settings.test_share).scalar()
    republish(lake, "volume_forecast", forecast.publish(frame, model, cut, "volume_forecast", as_of, settings))


def volatility(lake: LakeTables, store: registry.ModelStore, run_id: str, as_of: dt.datetime, settings: Settings = DEFAULTS) -> bool | None:
    frame = forecast.volatility_frame(lake.read("symbol_hourly"), lake.read("coin_stats"), as_of, settings)
    if not _passes(forecast.enough_hours(frame, settings)):
        return None
    model, predicted, means = forecast.train_volatility(frame, settings)
    split = stats.time_split(forecast.training_rows(frame), "hour_utc", settings.test_share)
    lake.save_dataset("volatility_forecast", run_id, forecast.encode_symbol(split, means))
    tested = forecast.backtest(predicted, "lag1", "volatility_forecast", run_id)
    lake.replace_slice("forecast_backtest", "model_name", "volatility_forecast", tested)
    scores = _trial(stats.regression_scores(tested), "volatility_forecast", "RMSE", "rmse", "baseline_rmse", False)
    won = _settle(lake, store, run_id, scores, _sizes(split), model, {"sym_mean": means})
    publish_volatility(lake, store, as_of, settings)
    return won


def publish_volatility(lake: LakeTables, store: registry.ModelStore, as_of: dt.datetime, settings: Settings = DEFAULTS) -> None:
    model, means = store.load("volatility_forecast"), store.side_table("volatility_forecast", "sym_mean")
    if model is None:
        return
    frame = forecast.volatility_frame(lake.read("symbol_hourly"), lake.read("coin_stats"), as_of, settings)
    cut = stats.split_cut(forecast.training_rows(frame), "hour_utc", settings.test_share).scalar()
    encoded = forecast.encode_symbol(frame, means)
    republish(lake, "volatility_forecast", forecast.publish(encoded, model, cut, "volatility_forecast", as_of, settings))


def early_warning(lake: LakeTables, store: registry.ModelStore, run_id: str, as_of: dt.datetime, settings: Settings = DEFAULTS) -> bool | None:
    silver = lake.read("silver_features")
    rows = warning.labelled(warning.triggers(silver, settings=settings), settings)
    split = stats.time_split(rows, "ts", settings.test_share)
    if not _passes(warning.gate(split, settings)):
        return None
    lake.save_dataset("early_warning", run_id, rows)
    model = warning.train(split, settings)
    judged = warning.evaluation(warning.score(model, split.where("is_test")), settings)
    extra = ["precision", "recall", "rule_precision", "rule_recall", "positive_rate"]
    scores = _trial(judged, "early_warning", "AUC", "auc", "baseline_auc", True, extra=extra)
    won = _settle(lake, store, run_id, scores, _sizes(split), model)
    champion = store.load("early_warning")
    if champion is not None:
        lake.replace("early_warnings", warning.recent_warnings(silver, champion, as_of, settings))
    return won


def direction_experiment(lake: LakeTables, store: registry.ModelStore, run_id: str, settings: Settings = DEFAULTS) -> bool | None:
    silver = lake.read("silver_features")
    top = top_symbols(lake.read("coin_stats"), settings.top_symbols)
    rows = direction.sampled(direction.directions(silver.join(top, "symbol", "left_semi")), settings)
    if not _passes(direction.enough_rows(rows, settings)):
        return None
    judged = direction.run(silver, top, settings)
    sizes = judged.first()
    extra = ["trades", "gross_pct", "net_pct"]
    scores = _trial(judged, "direction_experiment", "accuracy", "accuracy", "baseline", True, has_model=False, extra=extra)
    return _settle(lake, store, run_id, scores, (sizes["train_rows"], sizes["test_rows"]), None)


def anomaly_scoring(lake: LakeTables, settings: Settings = DEFAULTS) -> int | None:
    """Score every gold event and write the scores into a new version of the table."""
    events = lake.read("events")
    if not _passes(anomaly.enough_events(events, settings)):
        return None
    scores = anomaly.anomaly_scores(events, settings)
    rows = events.drop("anomaly_score").join(scores, "event_id", "left").select(*events.columns)
    scored = lake.replace("events", rows)
    lake.append("model_metrics", lake.spark.range(1).select(
        F.lit("anomaly_scoring").alias("model_name"), F.lit("events_scored").alias("metric"), F.lit(float(scored)).alias("value"),
        F.lit(None).cast("double").alias("baseline"), F.lit(True).alias("higher_is_better"), F.lit(True).alias("deployed"),
        F.lit(scored).cast("bigint").alias("train_rows"), F.lit(0).cast("bigint").alias("test_rows"), F.lit("{}").alias("extra"),
        F.current_timestamp().cast("timestamp_ntz").alias("run_at")))
    return scored
