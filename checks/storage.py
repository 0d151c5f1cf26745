"""Queries that write through the lake tables or a stream and return what was stored."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from checks import tables as T
from tidewick.config import Settings
from tidewick.learning import anomaly, direction, forecast, registry, warning
from tidewick.operators import stats
from tidewick.plans import ingest, lakehouse, serving
from tidewick.session import fresh_path, written
from tidewick.sources import bindings as B
from tidewick.sources.keyed import KeyedTable
from tidewick.sources.lake import LakeTables
from tidewick.streaming import closing as closing_sessions, jobs, outcomes, publishing

def new_lake(spark) -> LakeTables:
    return LakeTables(spark, fresh_path(spark, "lake"))


def appended(s, d) -> DataFrame:
    """Two pulls appended by symbol, read back."""
    lake = new_lake(s)
    rows = B.repeated_pulls(s, d)
    for moment in (B.PULL_1, B.PULL_1 + dt.timedelta(hours=1)):
        lake.append("bronze_candles", rows.where(F.col("ingested_at") == B.ntz(moment)))
    return lake.read("bronze_candles")


def refreshed_lake(s, d) -> LakeTables:
    """The whole pipeline through stored tables, gold refreshed twice."""
    lake = new_lake(s)
    lake.append("bronze_candles", B.repeated_pulls(s, d))
    lakehouse.refresh_silver(lake)
    lakehouse.refresh_gold(lake)
    lakehouse.refresh_gold(lake)
    return lake


def overwritten_silver(s, d) -> DataFrame:
    lake = new_lake(s)
    lake.append("bronze_candles", B.repeated_pulls(s, d))
    lakehouse.refresh_silver(lake)
    lakehouse.refresh_silver(lake)
    return lake.read("silver_features")


def replaced(s, d) -> DataFrame:
    """A table computed from its own previous version, replaced twice, with row counts."""
    lake = new_lake(s)
    first = lake.replace("symbol_hourly", T.hourly(s, d))
    second = lake.replace("symbol_hourly", lake.read("symbol_hourly").where("candles > 1"))
    return lake.read("symbol_hourly").agg(F.count("*").alias("now")).select(
        F.lit(first).cast("bigint").alias("first_count"), F.lit(second).cast("bigint").alias("second_count"), "now")


def appended_log(s, d) -> DataFrame:
    lake = new_lake(s)
    log = B.refresh_log(T.market_candles(s, d))
    half = B.ntz(dt.datetime(2024, 1, 16))
    lake.append("gold_refresh_log", log.where(F.col("refreshed_at") < half))
    lake.append("gold_refresh_log", log.where(F.col("refreshed_at") >= half))
    return lake.read("gold_refresh_log")


def replaced_slice(s, d) -> DataFrame:
    """Both models written, then only one replaced."""
    lake = new_lake(s)
    rows = T.backtest(s, d)
    lake.replace_slices("forecast_backtest", rows)
    again = rows.where("model_name = 'volume_forecast'").withColumn("run_id", F.lit("r2"))
    lake.replace_slices("forecast_backtest", again)
    return lake.read("forecast_backtest").groupBy("model_name", "run_id").agg(F.count("*").alias("n"))


def saved_dataset(s, d) -> DataFrame:
    lake = new_lake(s)
    path = lake.save_dataset("volume_forecast", "manual__2024-01-31T00:00:00+00:00", forecast.training_rows(T.volume_frame(s, d)))
    return s.read.parquet(path).select("hour_utc", "y", "roll24")


def _csv(s, path: str) -> DataFrame:
    return s.read.option("header", True).csv(path)


def exported_events(s, d) -> DataFrame:
    path = fresh_path(s, "events-csv")
    serving.export_events(T.Tables(s, d), T.event_filter(), path)
    return _csv(s, path).select("event_id", "symbol", "name", "start_ts", "is_pump_dump", "concurrent_symbols", "anomaly_score")


def exported_prices(s, d) -> DataFrame:
    path = fresh_path(s, "prices-csv")
    serving.export_prices(T.Tables(s, d), T.AS_OF, path)
    return _csv(s, path).select("symbol", "name", "events_90d", "rank_24h", "listed_at")


def exported_coin(s, d) -> DataFrame:
    path = fresh_path(s, "coin-csv")
    serving.export_coin(T.Tables(s, d), B.BENCHMARK_SYMBOL, 90, path)
    return _csv(s, path).select("t", F.col("close").cast("double").alias("close"))


RUN_1, RUN_2 = dt.datetime(2024, 1, 16, 12), B.AS_OF


def ingested(s, d) -> LakeTables:
    """Two ingest runs over landed bodies, each done twice; the second continues from the first one's state."""
    def make() -> LakeTables:
        lake, bars = new_lake(s), T.market_candles(s, d)
        for name, now in (("r1", RUN_1), ("r2", RUN_2)):
            seen = bars.where(F.col("ts") < B.ntz(now))
            for _ in range(2):
                ingest.run(lake, name, now, B.ticker_payload(B.ticker(seen, now)), B.listing(s, d), lambda ranges, seen=seen: B.answers(ranges, seen), T.CHECKED)
        return lake

    return _once(s, d, "ingested", make)


def ingest_state(s, d) -> DataFrame:
    """State after both runs beside the rows that bronze holds."""
    lake = ingested(s, d)
    return lake.read("ingest_state").join(lake.read("bronze_candles").groupBy("symbol").agg(F.count("*").alias("bronze_rows")), "symbol", "left")


def merged_state(s, d) -> DataFrame:
    """State in buckets: what was there before, then the arrivals of a run."""
    state, bars = KeyedTable(new_lake(s), "ingest_state", ["symbol"]), T.market_candles(s, d)
    state.merge(written(B.state_before(bars), "before"), lambda old, new: new)
    ingest.merge_state(state, bars.where(F.col("ts") >= B.ntz(dt.datetime(2024, 1, 16))), B.ntz(T.AS_OF))
    return state.read()


def laid_out(s, d) -> LakeTables:
    """Candles in symbol folders, sorted by time."""
    def make() -> LakeTables:
        lake = new_lake(s)
        lake.replace_slices("bronze_candles", B.b1(s, d), sort=["ts"])
        return lake

    return _once(s, d, "laid out", make)


def stored_slice(s, d) -> DataFrame:
    return laid_out(s, d).read_slice("bronze_candles", "symbol", "click", F.col("ts") >= B.ntz(HALVES))


def guarded_scans(s, d) -> DataFrame:
    """Rows of the whole lake, of one symbol, of a symbol that has no folder and of a table that was never written."""
    lake = laid_out(s, d)
    scans = {"all": lake.read("bronze_candles"), "one": lake.read_slice("bronze_candles", "symbol", "click"),
             "no folder": lake.read_slice("bronze_candles", "symbol", "nothing"), "no table": lake.read("silver_features")}
    counts = [rows.agg(F.count("*").alias("n"), F.min("ts").alias("first_ts")).select(F.lit(name).alias("scan"), "n", "first_ts") for name, rows in scans.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


# ---- streams
def _landing(s, d, which: str) -> str:
    path = fresh_path(s, "landing")
    T.bronze(s, d, which).write.parquet(path)
    return path


def _scattered(s, rows: DataFrame, table: str, action, halves: dt.datetime) -> DataFrame:
    """One symbol to a file and one file to a batch, the later half of the time before the earlier one."""
    landing = fresh_path(s, "landing")
    symbols = [r[0] for r in rows.select("symbol").distinct().orderBy("symbol").collect()]
    for late in (True, False):
        for symbol in symbols:
            part = rows.where((F.col("symbol") == symbol) & ((F.col("ts") >= B.ntz(halves)) == F.lit(late)))
            part.coalesce(1).write.mode("append").parquet(landing)
    jobs.each_batch(jobs.landed(s, landing, table, files_per_batch=1), action, fresh_path(s, "mark")).awaitTermination()
    return action.current()


HALVES = dt.datetime(2024, 1, 16, 11, 30)


def stream_ingest(s, d) -> DataFrame:
    """Two landings taken by two runs of the same query."""
    landing, out, mark = fresh_path(s, "landing"), fresh_path(s, "bronze"), fresh_path(s, "bronze-checkpoint")
    rows = B.repeated_pulls(s, d)
    for moment in (B.PULL_1, B.PULL_1 + dt.timedelta(hours=1)):
        rows.where(F.col("ingested_at") == B.ntz(moment)).write.mode("append").parquet(landing)
        jobs.ingest(jobs.landed(s, landing, "bronze_candles"), out, mark).awaitTermination()
    return s.read.schema("ts timestamp_ntz, open double, high double, low double, close double, volume double, ingested_at timestamp_ntz, symbol string").parquet(out)


def stream_dedupe(s, d) -> DataFrame:
    """The newer pull of every symbol lands first, the older one last."""
    action, landing = jobs.latest_candles(new_lake(s)), fresh_path(s, "landing")
    rows = B.repeated_pulls(s, d)
    symbols = [r[0] for r in rows.select("symbol").distinct().orderBy("symbol").collect()]
    for newer in (True, False):
        for symbol in symbols:
            rows.where((F.col("symbol") == symbol) & ((F.col("ingested_at") > B.ntz(B.PULL_1)) == F.lit(newer))).coalesce(1).write.mode("append").parquet(landing)
    jobs.each_batch(jobs.landed(s, landing, "bronze_candles", files_per_batch=1), action, fresh_path(s, "mark")).awaitTermination()
    return action.current()


def stream_hourly(s, d) -> DataFrame:
    return _scattered(s, T.silver(s, d), "silver_features", jobs.hourly(new_lake(s)), HALVES)


def stream_sessions(s, d) -> DataFrame:
    return _scattered(s, T.silver(s, d), "silver_features", jobs.pump_sessions(new_lake(s)), HALVES)


def stream_closed_sessions(s, d) -> DataFrame:
    """Silver in three landings, the middle of the time last and so late; sessions that were closed at the end."""
    landing, closing = fresh_path(s, "landing"), closing_sessions.ClosingSessions(new_lake(s))
    rows, late = T.silver(s, d), F.col("ts").between(B.ntz(dt.datetime(2024, 1, 12)), B.ntz(HALVES))
    for part in (rows.where(~late & (F.col("ts") < B.ntz(HALVES))), rows.where(~late & (F.col("ts") >= B.ntz(HALVES))), rows.where(late)):
        part.coalesce(1).write.mode("append").parquet(landing)
    closing.run(jobs.landed(s, landing, "silver_features", files_per_batch=1))
    return closing.current()


def stream_triggers(s, d) -> DataFrame:
    return _scattered(s, T.silver(s, d), "silver_features", jobs.refractory_triggers(new_lake(s)), HALVES)


def stream_outcomes(s, d) -> DataFrame:
    """Silver in four landings by time, each in any order within; what was told last about every trigger."""
    landing, told = fresh_path(s, "landing"), fresh_path(s, "told")
    rows, cuts = T.silver(s, d, "m"), [dt.datetime(1970, 1, 1), *(dt.datetime(2024, 1, day) for day in (9, 16, 24)), dt.datetime(9999, 1, 1)]
    for start, end in zip(cuts, cuts[1:]):
        rows.where((F.col("ts") >= B.ntz(start)) & (F.col("ts") < B.ntz(end))).coalesce(1).write.mode("append").parquet(landing)
    stream = outcomes.outcomes(jobs.landed(s, landing, "silver_features", files_per_batch=1))
    jobs.to_table(stream, told, fresh_path(s, "told-checkpoint")).awaitTermination()
    return outcomes.current(s.read.schema(outcomes.TOLD).parquet(told))


def stream_silver(s, d) -> DataFrame:
    """One symbol to a file and one file to a batch: the later half of the time, the earlier half, and last a mixture of
    older pulls with other prices and newer ones that repeat a candle. Silver then equals a full recompute."""
    landing, refresh = fresh_path(s, "landing"), jobs.TailRefresh(new_lake(s))
    rows, hour = B.b1(s, d), F.expr("INTERVAL 1 HOUR")
    repeats = F.minute("ts") % 7 == 0
    again = rows.withColumn("close", F.when(repeats, F.col("close")).otherwise(F.col("close") * 2)).withColumn(
        "ingested_at", F.when(repeats, F.col("ingested_at") + hour).otherwise(F.col("ingested_at") - hour))
    late = F.col("ts") >= B.ntz(HALVES)
    symbols = [r[0] for r in rows.select("symbol").distinct().orderBy("symbol").collect()]
    for part in (rows.where(late), rows.where(~late), again):
        for symbol in symbols:
            part.where(F.col("symbol") == symbol).coalesce(1).write.mode("append").parquet(landing)
    jobs.silver_tail(jobs.landed(s, landing, "bronze_candles", files_per_batch=1), refresh, fresh_path(s, "silver-checkpoint")).awaitTermination()
    return refresh.current()


def stream_publish(s, d) -> DataFrame:
    lake = new_lake(s)
    store = registry.ModelStore(lake)
    model, _ = _volume_model(s, d)
    store.deploy("volume_forecast", "r1", model)
    T.market(s, d).write.parquet(lake.path("market_hourly"))
    stream = jobs.landed(s, lake.path("market_hourly"), "market_hourly")
    jobs.each_batch(stream, jobs.PublishVolume(lake, store), fresh_path(s, "publish-checkpoint")).awaitTermination()
    return lake.read("forecasts")


def version_publish(s, d) -> DataFrame:
    """Two versions of the market's hours, each published when it appears; the last run of the stream finds nothing new."""
    lake, mark, market = new_lake(s), fresh_path(s, "version-checkpoint"), T.market(s, d)
    store = registry.ModelStore(lake)
    store.deploy("volume_forecast", "r1", _volume_model(s, d)[0])
    for rows in (market.where(F.col("hour_utc") < B.ntz(dt.datetime(2024, 1, 24))), market, None):
        if rows is not None:
            lake.replace("market_hourly", rows)
        publishing.on_versions(lake, store, mark).awaitTermination()
    return lake.read("forecast_history")


# ---- models
def boosted_volume(s, d) -> DataFrame:
    _, predicted = _volume_model(s, d)
    return forecast.backtest(predicted, "lag24", "volume_forecast", "r1")


_MODELS: dict[tuple, tuple] = {}


def _once(s, d, name: str, train):
    """Trained once per session and data folder; several queries apply the same model."""
    key = (s.sparkContext.applicationId, d, name)
    if key not in _MODELS:
        _MODELS[key] = train()
    return _MODELS[key]


def _volatility_model(s, d):
    frame = T.volatility_frame(s, d)
    model, _, means = _once(s, d, "volatility", lambda: forecast.train_volatility(frame))
    return model, forecast.encode_symbol(frame, means)


def _volume_model(s, d):
    return _once(s, d, "volume", lambda: forecast.train_volume(T.volume_frame(s, d)))


def _warning_model(s, d):
    return _once(s, d, "warning", lambda: warning.train(T.labelled(s, d)))


def recursive_paths(s, d) -> DataFrame:
    model, frame = _volatility_model(s, d)
    return forecast.forecast_paths(forecast.last_origins(frame), model, 6).select("symbol", "hour_utc", "path")


def published_volatility(s, d) -> DataFrame:
    model, frame = _volatility_model(s, d)
    cut = stats.split_cut(forecast.training_rows(frame), "hour_utc").scalar()
    return forecast.publish(frame, model, cut, "volatility_forecast", T.AS_OF)


def _passes(gate: DataFrame) -> bool:
    return bool(gate.select("ok").first()[0])


def warning_model(s, d) -> DataFrame:
    """No row where the gate asks for more triggers."""
    split = T.labelled(s, d)
    if not _passes(warning.gate(split)):
        return s.createDataFrame([], "auc double, baseline_auc double, precision double, recall double, positive_rate double, rule_precision double, rule_recall double")
    return warning.evaluation(warning.score(_warning_model(s, d), split.where("is_test")))


def scored_warnings(s, d) -> DataFrame:
    """No row where the gate asks for more triggers: then no champion is ever deployed."""
    if not _passes(warning.gate(T.labelled(s, d))):
        return s.createDataFrame([], "symbol string, ts timestamp_ntz, probability double, chg_5m_pct double, vol_x_5m double, outcome string, generated_at timestamp_ntz")
    return warning.recent_warnings(T.silver(s, d), _warning_model(s, d), T.AS_OF)


def direction_run(s, d) -> DataFrame:
    return direction.gated(T.silver(s, d), serving.top_symbols(T.silver(s, d).groupBy("symbol").agg(F.sum("vol_thb").alias("avg_daily_vol_thb_30d")), 10))


def anomalies(s, d) -> DataFrame:
    return anomaly.anomaly_scores(T.gold(s, d), Settings())
