"""The parametrised read queries, each a function of stored tables and an explicit ``as_of``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidewick.config import DEFAULTS, MARKET_SYMBOL, QUOTE_SUFFIX, TAG_LOW_LIQUIDITY, TAG_NEW_LISTING, Settings
from tidewick.functions.timefn import shift, whole_days
from tidewick.operators import rollups, stats
from tidewick.sources.lake import export_csv


def at(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class EventFilter:
    """days <= 0 means all time; single keeps events with at most one concurrent symbol."""

    as_of: dt.datetime
    days: int = 90
    min_pump: float = DEFAULTS.default_pump_pct
    min_volx: float = DEFAULTS.default_vol_x
    single: bool = True

    def apply(self, events: DataFrame) -> DataFrame:
        kept = events.where((F.col("pump_pct") >= self.min_pump) & (F.col("max_vol_x") >= self.min_volx))
        if self.days > 0:
            kept = kept.where(F.col("start_ts") >= at(self.as_of - dt.timedelta(days=self.days)))
        if self.single:
            kept = kept.where(F.coalesce(F.col("concurrent_symbols"), F.lit(0)) < 2)
        return kept


def top_symbols(coin_stats: DataFrame, n: int) -> DataFrame:
    return coin_stats.orderBy(F.desc_nulls_last("avg_daily_vol_thb_30d"), "symbol").limit(n).select("symbol")


def since_latest(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days before the newest row of the table."""
    return df.where(F.col(ts) >= shift(df.agg(F.max(ts)).scalar(), days=-days))


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key, by one grouped maximum instead of a sort."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_r")
    return df.groupBy(*keys).agg(newest).select(*keys, "_r.*").select(*df.columns)


def newest_row(df: DataFrame, order: str) -> DataFrame:
    return df.agg(F.max(F.struct(order, *[c for c in df.columns if c != order])).alias("_r")).select("_r.*")


# ---- Q1 overview
def lake_totals(dq: DataFrame) -> DataFrame:
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)

    return dq.agg(
        F.count("*").alias("coins"), total("bronze_rows"), total("candles"), total("duplicates"), total("bronze_files"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.avg("active_share").alias("avg_active_share"))


def ingest_summary(log: DataFrame) -> DataFrame:
    """All runs, and the totals of the newest one."""
    per_run = log.groupBy("run_at").agg(F.sum("rows").alias("rows"), F.sum("api_calls").alias("calls"), F.sum("duration_ms").alias("ms"))
    return per_run.agg(
        F.max("run_at").alias("last_run"), F.count("*").alias("runs"), F.coalesce(F.sum("calls"), F.lit(0)).alias("api_calls"),
        F.coalesce(F.max_by("rows", "run_at"), F.lit(0)).alias("last_run_rows"),
        F.coalesce(F.max_by("calls", "run_at"), F.lit(0)).alias("last_run_calls"),
        F.coalesce(F.max_by("ms", "run_at"), F.lit(0)).alias("last_run_ms"))


def event_kpis(events: DataFrame) -> DataFrame:
    """Counts, means and the median time to half retrace. The median runs on whole minutes,
    of which there are at most as many as the dump window has."""
    dumped = F.col("is_pump_dump")
    return events.agg(
        F.count("*").alias("events"), F.count(F.when(dumped, 1)).alias("pump_dumps"), F.avg("pump_pct").alias("avg_pump_pct"),
        F.percentile(F.when(dumped, F.col("minutes_to_half_retrace")), 0.5).alias("median_minutes_to_dump"),
        F.avg("dump_pct").alias("avg_dump_pct"), F.count_distinct("symbol").alias("coins_hit"))


def top_coin(events: DataFrame) -> DataFrame:
    return events.groupBy("symbol").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "symbol").limit(1)


def overview(t: dict[str, DataFrame], f: EventFilter) -> DataFrame:
    """One row; every part is a one-row aggregate placed with a scalar subquery."""
    kept = f.apply(t["events"])
    parts = {
        "lake": lake_totals(t["dq_symbol"]), "ingest": ingest_summary(t["ingest_log"]),
        "gold": newest_row(t["gold_refresh_log"].select("refreshed_at", "duration_s", F.col("events").alias("refresh_events")), "refreshed_at"),
        "models": t["model_metrics"].where("deployed").agg(F.count_distinct("model_name").alias("models_deployed")),
        "kpi": event_kpis(kept),
        "all": t["events"].agg(F.count("*").alias("candidates_total")),
        "top": top_coin(kept).select(F.col("symbol").alias("top_symbol"), F.col("n").alias("top_n")),
    }
    spark = t["events"].sparkSession
    row = spark.range(1).select(*[
        p.select(F.struct("*")).scalar().alias(f"_{name}") for name, p in parts.items()])
    return row.select((F.col("_lake.coins") > 0).alias("ready"), *[f"_{name}.*" for name in parts])


# ---- Q2..Q5 events
EVENT_LIST = [
    "event_id", "symbol", "name", "start_ts", "peak_ts", "base_price", "peak_price", "pump_pct", "max_vol_x",
    "max_chg_5m_pct", "dump_pct", "retrace_share", "minutes_to_peak", "minutes_to_half_retrace", "is_pump_dump",
    "active_share_1d", "vol_thb_event", "concurrent_symbols", "anomaly_score", "days_since_listing",
]


def event_rows(t: dict[str, DataFrame], f: EventFilter) -> DataFrame:
    names = t["pairs"].select("symbol", "name", "listed_at")
    joined = f.apply(t["events"]).join(names, "symbol", "left")
    return joined.withColumn("days_since_listing", whole_days(F.col("listed_at"), F.col("start_ts"))).select(*EVENT_LIST)


def event_list(t: dict[str, DataFrame], f: EventFilter, limit: int = 200) -> DataFrame:
    return event_rows(t, f).orderBy(F.desc("start_ts"), "symbol").limit(limit)


def candles_of_event(t: dict[str, DataFrame], event_id: str | Column) -> DataFrame:
    key = F.lit(event_id) if isinstance(event_id, str) else event_id
    return t["event_candles"].where(F.col("event_id") == key).select("ts", "open", "high", "low", "close", "vol_thb").orderBy("ts")


def risk_tags(settings: Settings = DEFAULTS) -> Column:
    return F.array_compact(F.array(
        F.when(F.col("days_listed") < settings.new_listing_days, F.lit(TAG_NEW_LISTING)),
        F.when(F.col("active_share") < settings.low_liquidity_share, F.lit(TAG_LOW_LIQUIDITY))))


def coin_risk(t: dict[str, DataFrame], f: EventFilter) -> DataFrame:
    """Events per symbol first, then one lookup row each: the joins never see event rows."""
    per_symbol = f.apply(t["events"]).groupBy("symbol").agg(
        F.count("*").alias("events"), F.count(F.when(F.col("is_pump_dump"), 1)).alias("pump_dumps"), F.max("pump_pct").alias("max_pump_pct"))
    listed = t["pairs"].select("symbol", "name", whole_days(F.col("listed_at"), at(f.as_of)).alias("days_listed"))
    liquid = t["coin_stats"].select("symbol", "active_share", F.col("avg_daily_vol_thb_30d").alias("avg_daily_vol_thb"))
    return per_symbol.join(listed, "symbol", "left").join(liquid, "symbol", "left")


def risky_coins(t: dict[str, DataFrame], f: EventFilter, limit: int = 12, settings: Settings = DEFAULTS) -> DataFrame:
    best = coin_risk(t, f).orderBy(F.desc("events"), F.desc_nulls_first("max_pump_pct"), "symbol").limit(limit)
    return best.withColumn("tags", risk_tags(settings))


def heatmap(t: dict[str, DataFrame], f: EventFilter) -> DataFrame:
    return f.apply(t["events"]).groupBy("dow_local", "hour_local").agg(F.count("*").alias("n")).orderBy("dow_local", "hour_local")


# ---- Q6, Q7 series
def market_series(t: dict[str, DataFrame], days: int = 7) -> DataFrame:
    return since_latest(t["market_hourly"], "hour_utc", days).select("hour_utc", "vol_thb", "avg_rv_pct", "symbols").orderBy("hour_utc")


def market_forecast(t: dict[str, DataFrame]) -> DataFrame:
    return t["forecasts"].where("model_name = 'volume_forecast'").select(
        "target_hour_utc", "predicted", "lower", "upper", "generated_at").orderBy("target_hour_utc")


def selectable_symbols(t: dict[str, DataFrame], n: int = 10) -> DataFrame:
    """Symbols with a published volatility forecast; without any, the top symbols by volume."""
    published = t["forecasts"].where("model_name = 'volatility_forecast'").select("symbol").distinct()
    none = published.agg(F.count("*")).scalar() == 0
    fallback = top_symbols(t["coin_stats"], n).withColumn("_pos", F.lit(1)).where(none)
    return published.withColumn("_pos", F.lit(0)).unionByName(fallback).join(
        t["coin_stats"].select("symbol", "avg_daily_vol_thb_30d"), "symbol", "left")


def chosen_symbol(t: dict[str, DataFrame], symbol: str | None, n: int = 10) -> DataFrame:
    """One row: the wanted symbol if it is selectable, else the first selectable one."""
    options = selectable_symbols(t, n)
    wanted = F.lit(symbol).cast("string")
    volume_rank = F.when(F.col("_pos") == 1, -F.col("avg_daily_vol_thb_30d"))
    return options.orderBy((F.col("symbol") == wanted).desc_nulls_last(), volume_rank.asc_nulls_last(), "symbol").limit(1).select("symbol")


def volatility_series(t: dict[str, DataFrame], symbol: str | None = None, days: int = 3) -> DataFrame:
    own = t["symbol_hourly"].join(chosen_symbol(t, symbol), "symbol", "left_semi")
    return since_latest(own, "hour_utc", days).select("symbol", "hour_utc", "rv_pct", "vol_thb").orderBy("hour_utc")


def volatility_forecast_rows(t: dict[str, DataFrame], symbol: str | None = None) -> DataFrame:
    return t["forecasts"].where("model_name = 'volatility_forecast'").join(
        chosen_symbol(t, symbol), "symbol", "left_semi").select("symbol", "target_hour_utc", "predicted", "lower", "upper").orderBy("target_hour_utc")


# ---- Q8, Q9 models
def recent_warnings(t: dict[str, DataFrame], limit: int = 30) -> DataFrame:
    return t["early_warnings"].orderBy(F.desc("ts"), "symbol").limit(limit)


def model_status(t: dict[str, DataFrame]) -> DataFrame:
    metrics = t["model_metrics"]
    live = latest_per(metrics.where("deployed").select("model_name", "run_at", "value"), ["model_name"], ["run_at"])
    live = live.select("model_name", F.col("value").alias("deployed_value"), F.col("run_at").alias("deployed_at"))
    return latest_per(metrics, ["model_name"], ["run_at"]).join(live, "model_name", "left")


def model_history(t: dict[str, DataFrame]) -> DataFrame:
    return t["model_metrics"].where("model_name <> 'anomaly_scoring'").select(
        "model_name", "metric", "value", "baseline", "higher_is_better", "deployed", "run_at").orderBy("run_at", "model_name")


# ---- Q10 movers
def quoted(ticker: DataFrame) -> DataFrame:
    return ticker.where(F.col("symbol").like(QUOTE_SUFFIX.replace("_", "%\\_", 1)) & (F.col("volume_thb_24h") > 0))


def movers(t: dict[str, DataFrame], n: int = 6) -> DataFrame:
    rows = quoted(t["market_ticker"]).join(t["pairs"].select("symbol", "selected"), "symbol", "left").select(
        "symbol", "last", "percent_change", "volume_thb_24h", F.coalesce("selected", F.lit(False)).alias("tracked"))
    up = rows.orderBy(F.desc_nulls_last("percent_change"), "symbol").limit(n).withColumn("side", F.lit("gainer"))
    down = rows.orderBy(F.asc_nulls_last("percent_change"), "symbol").limit(n).withColumn("side", F.lit("loser"))
    return up.unionByName(down)


# ---- Q11 pipeline
def recent_runs(t: dict[str, DataFrame], n: int = 24) -> DataFrame:
    """The newest runs, shown oldest first."""
    runs = t["ingest_log"].groupBy("run_at").agg(
        F.count("*").alias("coins"), F.sum("rows").alias("rows"), F.sum("api_calls").alias("calls"),
        F.sum("duration_ms").alias("duration_ms"), F.bool_or("is_backfill").alias("backfill"))
    return runs.orderBy(F.desc("run_at")).limit(n).orderBy("run_at")


def quality_by_liquidity(t: dict[str, DataFrame]) -> DataFrame:
    return t["dq_symbol"].select("symbol", "candles", "duplicates", "active_share", "first_ts", "last_ts").orderBy(
        F.asc_nulls_last("active_share"), "symbol")


# ---- Q12, Q13 prices
def sparklines(hourly: DataFrame, days: int = 7, step_h: int = 4) -> DataFrame:
    """Closes at every fourth clock hour of the last week, oldest first (at most 43 each)."""
    kept = since_latest(hourly, "hour_utc", days).where(F.hour("hour_utc") % step_h == 0)
    ordered = F.array_sort(F.collect_list(F.struct("hour_utc", "close")))
    return kept.groupBy("symbol").agg(F.transform(ordered, lambda x: x["close"]).alias("spark"))


def strong(events: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    return EventFilter(as_of, days=days, single=False).apply(events)


def event_counts(events: DataFrame, as_of: dt.datetime, days: int = 90) -> DataFrame:
    return strong(events, as_of, days).groupBy("symbol").agg(F.count("*").alias("events_90d"))


def price_board(t: dict[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    board = (
        t["dq_symbol"].select("symbol")
        .join(t["pairs"].select("symbol", "name", "rank_24h", "listed_at"), "symbol", "left")
        .join(t["market_ticker"].select("symbol", "last", "percent_change", "volume_thb_24h"), "symbol", "left")
        .join(t["coin_stats"].select("symbol", "active_share", "last_close"), "symbol", "left")
        .join(sparklines(t["symbol_hourly"]), "symbol", "left")
        .join(event_counts(t["events"], as_of), "symbol", "left")
    )
    return board.select(
        "symbol", "name", "rank_24h", "listed_at", F.coalesce("last", "last_close").alias("last"), "percent_change",
        "volume_thb_24h", "active_share", "spark", F.coalesce("events_90d", F.lit(0)).alias("events_90d"),
    ).orderBy(F.desc_nulls_last("volume_thb_24h"), "symbol")


def coin_info(t: dict[str, DataFrame], symbol: str) -> DataFrame:
    ticker = t["market_ticker"].select("symbol", "last", "percent_change", "high_24h", "low_24h", "volume_thb_24h")
    facts = t["coin_stats"].select("symbol", "first_ts", "last_ts", "candles", "active_share", "avg_daily_vol_thb_30d")
    own = F.col("symbol") == symbol
    return t["pairs"].where(own).select("symbol", "name", "listed_at", "rank_24h").join(
        ticker.where(own), "symbol", "left").join(facts.where(own), "symbol", "left")


def coin_series(t: dict[str, DataFrame], symbol: str, days: int = 90) -> DataFrame:
    own = t["symbol_hourly"].where(F.col("symbol") == symbol)
    return rollups.rebucket(since_latest(own, "hour_utc", days), "hour" if days <= 30 else "day").orderBy("t")


def coin_events(t: dict[str, DataFrame], symbol: str, as_of: dt.datetime, days: int = 90) -> DataFrame:
    return strong(t["events"].where(F.col("symbol") == symbol), as_of, days).select(
        "event_id", "start_ts", "peak_ts", "pump_pct", "dump_pct", "max_vol_x", "is_pump_dump", "concurrent_symbols",
        "anomaly_score").orderBy(F.desc("start_ts"))


def mean_volatility(t: dict[str, DataFrame], symbol: str, days: int = 30) -> DataFrame:
    recent = since_latest(t["symbol_hourly"], "hour_utc", days)
    return recent.where(F.col("symbol") == symbol).agg(F.avg("rv_pct").alias("avg_rv_30d"))


def coin_forecast(t: dict[str, DataFrame], symbol: str) -> DataFrame:
    return t["forecasts"].where((F.col("model_name") == "volatility_forecast") & (F.col("symbol") == symbol)).select(
        "target_hour_utc", "predicted").orderBy("target_hour_utc")


def coin_detail(t: dict[str, DataFrame], symbol: str, as_of: dt.datetime, days: int = 90) -> dict[str, DataFrame]:
    return {
        "info": coin_info(t, symbol), "series": coin_series(t, symbol, days), "events": coin_events(t, symbol, as_of, days),
        "avg_rv": mean_volatility(t, symbol), "forecast": coin_forecast(t, symbol),
    }


# ---- Q14 correlation
def correlations(t: dict[str, DataFrame], days: int = 30, top: int = 15) -> DataFrame:
    """Hourly returns of the ``top`` symbols (at most 30) against each other."""
    if not 1 <= top <= 30:
        raise ValueError("top must lie between 1 and 30")
    returns = stats.hourly_returns(since_latest(t["symbol_hourly"], "hour_utc", days))
    return stats.correlation_matrix(returns, top_symbols(t["coin_stats"], top))


def benchmark_correlations(t: dict[str, DataFrame], benchmark: str, days: int = 30) -> DataFrame:
    returns = stats.hourly_returns(since_latest(t["symbol_hourly"], "hour_utc", days))
    return stats.benchmark_correlation(returns, benchmark).orderBy(F.desc_nulls_first("c"), "symbol")


# ---- Q15 back-tests
def backtest_options(t: dict[str, DataFrame]) -> DataFrame:
    return t["forecast_backtest"].select("model_name", "symbol").distinct().orderBy("model_name", "symbol")


def backtest_rows(t: dict[str, DataFrame], model: str = "volume_forecast", symbol: str = MARKET_SYMBOL) -> DataFrame:
    return t["forecast_backtest"].where((F.col("model_name") == model) & (F.col("symbol") == symbol)).select(
        "hour_utc", "actual", "predicted", "baseline", "run_id").orderBy("hour_utc")


def live_accuracy(t: dict[str, DataFrame], model: str = "volume_forecast", symbol: str = MARKET_SYMBOL) -> DataFrame:
    """The last published forecast of each hour beside what then happened."""
    published = t["forecast_history"].where(F.col("model_name") == model)
    if model == "volume_forecast":
        real = t["market_hourly"].select("hour_utc", F.col("vol_thb").alias("actual"))
    else:
        published = published.where(F.col("symbol") == symbol)
        real = t["symbol_hourly"].where(F.col("symbol") == symbol).select("hour_utc", F.col("rv_pct").alias("actual"))
    last = latest_per(published.select(F.col("target_hour_utc").alias("hour_utc"), "generated_at", "predicted"), ["hour_utc"], ["generated_at"])
    return last.join(real, "hour_utc").select("hour_utc", "predicted", "actual", "generated_at").orderBy("hour_utc")


# ---- Q16 exports. The column order of the three files.
EXPORT_EVENTS = [
    "event_id", "symbol", "name", "start_ts", "peak_ts", "base_price", "peak_price", "pump_pct", "max_vol_x", "dump_pct",
    "minutes_to_peak", "minutes_to_half_retrace", "is_pump_dump", "concurrent_symbols", "active_share_1d",
    "vol_thb_event", "anomaly_score",
]
EXPORT_PRICES = [
    "symbol", "name", "last", "percent_change", "volume_thb_24h", "active_share", "events_90d", "rank_24h", "listed_at",
]
EXPORT_COIN = ["t", "close", "high", "low", "vol_thb", "rv_pct"]


def export_events(t: dict[str, DataFrame], f: EventFilter, path: str) -> None:
    export_csv(event_rows(t, f).orderBy(F.desc("start_ts"), "symbol"), EXPORT_EVENTS, path)


def export_prices(t: dict[str, DataFrame], as_of: dt.datetime, path: str) -> None:
    export_csv(price_board(t, as_of), EXPORT_PRICES, path)


def export_coin(t: dict[str, DataFrame], symbol: str, days: int, path: str) -> None:
    export_csv(coin_series(t, symbol, days), EXPORT_COIN, path)
