"""Stored tables the catalogued queries read, built once per session and data folder.

Silver and gold are tables in this design, so the read queries start from them. The
``w*``/``p*``/``j*`` operator queries that define those layers compute from raw rows.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewick.config import Settings
from tidewick.learning import forecast, registry, warning
from tidewick.operators import candles, events, rollups, stats
from tidewick.plans import ingest, lakehouse, serving
from tidewick.session import prepare, written
from tidewick.sources import bindings as B

AS_OF = B.AS_OF
CHECKED = Settings(top_n=5)
_MEMO: dict[tuple, DataFrame] = {}


def stored(spark: SparkSession, d: str, name: str, make) -> DataFrame:
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _MEMO:
        prepare(spark)
        _MEMO[key] = written(make(), name.replace(":", "-"))
    return _MEMO[key]


def bronze(spark, d, which="1"):
    return {"1": B.b1, "m": B.market_pull, "3": B.repeated_pulls}[which](spark, d)


def silver(spark, d, which="1") -> DataFrame:
    return stored(spark, d, f"silver:{which}", lambda: candles.build_silver(bronze(spark, d, which)))


def gold(spark, d, which="1") -> DataFrame:
    return stored(spark, d, f"events:{which}", lambda: lakehouse.gold_events(silver(spark, d, which)))


def facts(spark, d, which="1") -> DataFrame:
    return events.session_facts(events.sessions(events.candidates(silver(spark, d, which))))


def hourly(spark, d) -> DataFrame:
    return stored(spark, d, "hourly", lambda: rollups.symbol_hourly(silver(spark, d, "m")))


def market(spark, d) -> DataFrame:
    return stored(spark, d, "market", lambda: rollups.market_hourly(hourly(spark, d)))


def coin_stats(spark, d) -> DataFrame:
    return stored(spark, d, "coin_stats", lambda: rollups.coin_stats(silver(spark, d, "m")))


def market_candles(spark, d) -> DataFrame:
    return stored(spark, d, "candles:m", lambda: B.market_pull(spark, d))


def pairs(spark, d) -> DataFrame:
    bars = market_candles(spark, d)
    none = spark.createDataFrame([], "symbol string, name string, listed_at timestamp_ntz, volume_thb_24h double, "
                                     "rank_24h int, selected boolean, updated_at timestamp_ntz")
    return ingest.refresh_pairs(none, B.ticker(bars), B.listing(spark, d), B.state_before(bars), B.ntz(AS_OF), CHECKED)


def volume_frame(spark, d) -> DataFrame:
    return forecast.volume_frame(market(spark, d), AS_OF)


def volatility_frame(spark, d) -> DataFrame:
    return forecast.volatility_frame(hourly(spark, d), coin_stats(spark, d), AS_OF)


def encoded_volatility(spark, d) -> DataFrame:
    split = stats.time_split(forecast.training_rows(volatility_frame(spark, d)), "hour_utc")
    return forecast.encode_symbol(split, forecast.target_means(split.where("NOT is_test")))


def backtest(spark, d) -> DataFrame:
    """Back-test rows with the 24-hour mean as the predicted value."""
    vol = stats.time_split(forecast.training_rows(volume_frame(spark, d)), "hour_utc").where("is_test")
    rv = encoded_volatility(spark, d).where("is_test")
    mean = lambda rows: rows.withColumn("prediction", F.col("roll24"))
    return forecast.backtest(mean(vol), "lag24", "volume_forecast", "r1").unionByName(
        forecast.backtest(mean(rv), "lag1", "volatility_forecast", "r1"))


def warnings(spark, d) -> DataFrame:
    """Every trigger with its outcome; a simple score stands in for the probability."""
    s = silver(spark, d, "m")
    newest = s.agg(F.max("ts")).scalar()
    return warning.triggers(s).select(
        "symbol", "ts", (F.col("chg_5m") / (1 + F.col("chg_5m"))).alias("probability"), (F.col("chg_5m") * 100).alias("chg_5m_pct"),
        "vol_x_5m", warning.outcome(F.col("ts"), newest, F.col("future_gain")).alias("outcome"), B.ntz(AS_OF).alias("generated_at"))


def labelled(spark, d) -> DataFrame:
    return stats.time_split(warning.labelled(warning.triggers(silver(spark, d))), "ts")


class Tables(dict):
    """Serving tables by name, each made when first asked for."""

    def __init__(self, spark: SparkSession, d: str):
        super().__init__()
        self.spark, self.d = spark, d

    def __missing__(self, name: str) -> DataFrame:
        spark, d = self.spark, self.d
        make = {
            "events": lambda: gold(spark, d, "m"),
            "event_candles": lambda: events.event_candles(gold(spark, d, "m"), silver(spark, d, "m")),
            "symbol_hourly": lambda: hourly(spark, d),
            "market_hourly": lambda: market(spark, d),
            "coin_stats": lambda: coin_stats(spark, d),
            "dq_symbol": lambda: candles.data_quality(market_candles(spark, d)),
            "pairs": lambda: stored(spark, d, "pairs", lambda: pairs(spark, d)),
            "market_ticker": lambda: stored(spark, d, "ticker", lambda: B.ticker(market_candles(spark, d))),
            "ingest_log": lambda: B.ingest_log(market_candles(spark, d)),
            "gold_refresh_log": lambda: B.refresh_log(market_candles(spark, d)),
            "model_metrics": lambda: registry.replay(B.trials(spark, d)),
            "forecast_history": lambda: B.publications(market(spark, d), hourly(spark, d)),
            "forecasts": lambda: B.latest_publications(self["forecast_history"]),
            "forecast_backtest": lambda: backtest(spark, d),
            "early_warnings": lambda: warnings(spark, d),
        }
        self[name] = make[name]()
        return self[name]


def event_filter(**kw) -> serving.EventFilter:
    return serving.EventFilter(AS_OF, **kw)
