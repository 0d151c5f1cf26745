"""Candles and small dimensions derived from the test tables.

Every frame is a plain expression over ``events``, so work grows with that table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewick.functions.timefn import shift, trunc

AS_OF = dt.datetime(2024, 1, 31)
PULL_1 = dt.datetime(2024, 2, 1)


def ntz(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def by_type() -> Column:
    return F.col("event_type")


def by_user() -> Column:
    return F.concat(F.lit("S"), F.lpad((F.col("user_id") % 12).cast("string"), 2, "0"))


def to_candles(events: DataFrame, symbol: Column) -> DataFrame:
    """Minute OHLCV of ``value``; first and last by (ts, event_id), volume summed exactly."""
    order = F.struct("ts", "event_id")
    return events.groupBy(symbol.alias("symbol"), trunc("minute", "ts").alias("minute")).agg(
        F.min_by("value", order).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", order).alias("close"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("volume"),
    ).withColumnRenamed("minute", "ts")


def single_pull(spark: SparkSession, sf_dir: str, symbol: Column) -> DataFrame:
    return to_candles(events_table(spark, sf_dir), symbol).withColumn("ingested_at", ntz(PULL_1))


def repeated_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first pull plus a later one that repeats every seventh minute with volume + 1."""
    first = single_pull(spark, sf_dir, by_type())
    again = first.where(F.minute("ts") % 7 == 0).withColumn("volume", F.col("volume") + 1).withColumn(
        "ingested_at", shift(F.col("ingested_at"), hours=1))
    return first.unionByName(again)


def b1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_pull(spark, sf_dir, by_type())


def b2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_pull(spark, sf_dir, by_user())


# ---- market naming: twelve symbols, two of which are not quoted in the home currency
def by_market() -> Column:
    k = F.col("user_id") % 12
    return (
        F.when(k == 9, F.lit("USDT_THB"))
        .when(k == 10, F.lit("S10XTHB"))
        .when(k == 11, F.lit("S11_USD"))
        .otherwise(F.concat(F.lit("S0"), k.cast("string"), F.lit("_THB")))
    )


def market_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_pull(spark, sf_dir, by_market())


BENCHMARK_SYMBOL = "S00_THB"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and listing date per symbol, thirty days apart from 2023-10-01."""
    index = (F.col("user_id") % 12).cast("int")
    base = events_table(spark, sf_dir).select(by_market().alias("symbol"), index.alias("idx")).distinct()
    return base.select(
        "symbol", F.concat(F.lit("Coin "), "symbol").alias("name"),
        (ntz(dt.datetime(2023, 10, 1)) + F.make_dt_interval(F.col("idx") * 30)).alias("listed_at"))


def ticker(candles: DataFrame, as_of: dt.datetime = AS_OF) -> DataFrame:
    """24-hour statistics before the as-of instant."""
    last, first = F.max_by("close", "ts"), F.min_by("open", "ts")
    return candles.where(F.col("ts") >= ntz(as_of - dt.timedelta(days=1))).groupBy("symbol").agg(
        last.alias("last"), ((last / F.nullif(first, F.lit(0.0)) - 1) * 100).alias("percent_change"),
        F.max("high").alias("high_24h"), F.min("low").alias("low_24h"),
        F.sum(F.col("volume") * F.col("close")).alias("volume_thb_24h"),
    ).withColumn("snapshot_at", ntz(as_of))


def state_before(candles: DataFrame) -> DataFrame:
    """Ingest state of the symbols S00..S07 as of the middle of the data."""
    seen = candles.where((F.col("ts") < ntz(dt.datetime(2024, 1, 16))) & F.col("symbol").between("S00", "S08"))
    return seen.groupBy("symbol").agg(
        F.max(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("last_ts"), F.count("*").alias("rows_total"),
        F.lit(1).alias("files")).withColumn("updated_at", ntz(dt.datetime(2024, 1, 16)))


def ingest_log(candles: DataFrame) -> DataFrame:
    """One daily run per symbol; the first day is the backfill."""
    day = trunc("day", "ts")
    runs = candles.groupBy("symbol", day.alias("day")).agg(
        F.min("ts").alias("from_ts"), F.max("ts").alias("to_ts"), F.count("*").alias("rows"))
    return runs.select(
        shift(F.col("day"), days=1).alias("run_at"), "symbol", "from_ts", "to_ts",
        (F.lit(1) + (F.col("rows") % 3)).cast("bigint").alias("api_calls"), "rows",
        (F.col("rows") * 10).alias("duration_ms"), (F.col("day") == ntz(dt.datetime(2024, 1, 1))).alias("is_backfill"))


def refresh_log(candles: DataFrame) -> DataFrame:
    return candles.groupBy(trunc("day", "ts").alias("refreshed_at")).agg(
        F.count("*").alias("silver_rows"), F.count_distinct("symbol").alias("events"),
        (F.count("*") / F.lit(100.0)).alias("duration_s"))


MODEL_OF_TYPE = {
    "view": ("volume_forecast", "MAPE", False),
    "click": ("volatility_forecast", "RMSE", False),
    "purchase": ("early_warning", "AUC", True),
    "signup": ("direction_experiment", "accuracy", True),
    "error": ("anomaly_scoring", "events_scored", True),
}


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily history of trained models: score and baseline are means over the day's events."""
    events = events_table(spark, sf_dir)
    kind = F.create_map(*[x for k, v in MODEL_OF_TYPE.items() for x in (
        F.lit(k), F.struct(F.lit(v[0]).alias("model_name"), F.lit(v[1]).alias("metric"), F.lit(v[2]).alias("higher_is_better")))])
    exact = F.col("value").cast("decimal(18,2)")
    even = F.col("event_id") % 2 == 0
    daily = events.groupBy("event_type", trunc("day", "ts").alias("run_at")).agg(
        (F.sum(exact).cast("double") / F.count("*")).alias("value"),
        (F.sum(F.when(even, exact)).cast("double") / F.nullif(F.count(F.when(even, 1)), F.lit(0))).alias("baseline"),
        F.count("*").alias("train_rows"), (F.count("*") % 7).alias("test_rows"))
    return daily.withColumn("_k", kind[F.col("event_type")]).select(
        "_k.model_name", "_k.metric", "value", "baseline", "_k.higher_is_better", "train_rows", "test_rows", "run_at",
        (F.col("_k.model_name") != "direction_experiment").alias("has_model"))


def publications(market: DataFrame, hourly: DataFrame) -> DataFrame:
    """A stand-in forecast history: each hour published for the next two hours."""
    def spread(rows: DataFrame, value: str, model: str) -> DataFrame:
        steps = F.explode(F.array(*[
            F.struct(F.lit(h).alias("h"), F.lit(w).alias("w")) for h, w in ((1, 1.0), (2, 0.9))])).alias("p")
        out = rows.select("symbol", "hour_utc", F.col(value).alias("v"), steps)
        predicted = F.col("v") * F.col("p.w")
        return out.select(
            F.lit(model).alias("model_name"), "symbol",
            (F.col("hour_utc") + F.make_dt_interval(F.lit(0), F.col("p.h"))).alias("target_hour_utc"),
            predicted.alias("predicted"), F.col("hour_utc").alias("generated_at"),
            (predicted * 0.8).alias("lower"), (predicted * 1.2).alias("upper"))

    return spread(market.withColumn("symbol", F.lit("MARKET")), "vol_thb", "volume_forecast").unionByName(
        spread(hourly, "rv_pct", "volatility_forecast"))


def latest_publications(history: DataFrame) -> DataFrame:
    newest = history.groupBy("model_name", "symbol").agg(F.max("generated_at").alias("generated_at"))
    return history.join(newest, ["model_name", "symbol", "generated_at"], "left_semi")


def candle_payloads(candles: DataFrame) -> DataFrame:
    """Landed bodies, one per symbol and day; on every fifth day of the month the pull found nothing."""
    daily = candles.groupBy("symbol", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_list(F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), "open", "high", "low", "close", "volume"))).alias("x"))
    parts = [F.col(f"x.{c}").alias(k) for k, c in zip("tohlcv", ["t", "open", "high", "low", "close", "volume"])]
    status = F.when(F.dayofmonth("day") % 5 == 0, "no_data").otherwise("ok").alias("s")
    return daily.select("symbol", F.to_json(F.struct(status, *parts)).alias("body"))


def ticker_payload(tick: DataFrame) -> DataFrame:
    """One snapshot body per symbol; names that are not seven letters long lack a change."""
    change_ = F.when(F.length("symbol") == 7, F.col("percent_change").cast("string"))
    item = F.struct(
        "symbol", F.col("last").cast("string").alias("last"), change_.alias("percent_change"),
        F.col("high_24h").cast("string").alias("high_24_hr"), F.col("low_24h").cast("string").alias("low_24_hr"),
        F.col("volume_thb_24h").cast("string").alias("quote_volume"))
    return tick.select(F.to_json(F.array(item)).alias("body"))


def answers(ranges: DataFrame, candles: DataFrame) -> DataFrame:
    """One landed body per planned range: the candles from its first second up to its last, that one left out."""
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    hits = candles.join(ranges, "symbol").where((second >= F.col("from_s")) & (second < F.col("to_s")))
    bodies = hits.groupBy(*ranges.columns).agg(F.array_sort(F.collect_list(F.struct(
        second.alias("t"), "open", "high", "low", "close", "volume"))).alias("x"))
    parts = [F.col(f"x.{c}").alias(k) for k, c in zip("tohlcv", ["t", "open", "high", "low", "close", "volume"])]
    got = bodies.select(*ranges.columns, F.to_json(F.struct(F.lit("ok").alias("s"), *parts)).alias("body"))
    return ranges.join(got, ranges.columns, "left").fillna('{"s":"no_data"}', ["body"])
