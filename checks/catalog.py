"""Every checked query: the Spark side, the SQL it must equal, and its double columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from checks import storage as S, tables as T
from checks.sql import AS_OF, BENCH, RUN_1, places, rounded, with_parts
from tidewick.config import Settings
from tidewick.functions.numeric import ratio
from tidewick.functions.timefn import cyclic
from tidewick.learning import anomaly, direction, forecast, registry, warning
from tidewick.operators import candles, events, grid, rollups, sampling, stats
from tidewick.plans import ingest, lakehouse, serving
from tidewick.session import prepare
from tidewick.sources import bindings as B, payloads

QUERIES: dict = {}
ORACLES: dict = {}


def round_doubles(df: DataFrame, names: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) + F.lit(0.0) for c, n in places(names)}) if names else df


def add(key: str, make, parts: str | None = None, sql: str | None = None, doubles: str = "") -> None:
    def run(spark, d):
        return round_doubles(make(prepare(spark), d), doubles)

    QUERIES[key] = run
    if sql is not None:
        body = rounded(sql, doubles)
        ORACLES[key] = with_parts(parts, body) if parts else body


F1 = "open high low close volume"
SILVER_D = F1 + " vol_thb ret_1m:9 open_5m chg_5m:9 vol5_thb base_vpm_thb:10 active_share_1d range_1m:9 max_high_next60 min_low_next60 close_next15 vol_x_5m"
EVENT_D = ("base_price peak_price pump_pct max_vol_x max_chg_5m_pct min_low_after dump_pct retrace_share minutes_to_peak "
           "minutes_to_half_retrace active_share_1d vol_thb_event")
FRAME_D = "y lag1 lag2 lag3 lag24 roll24 hour_sin hour_cos"


def from_raw(cols: str, which: str = "1"):
    """Silver columns computed from raw events in one plan."""
    return lambda s, d: candles.build_silver(T.bronze(s, d, which)).select("symbol", "ts", *cols.split())


def silver_sql(cols: str) -> str:
    return f"SELECT symbol, ts, {', '.join(cols.split())} FROM s1"


# ------------------------------------------------------------------ sources and sinks
add("s1_scan_one_symbol", lambda s, d: B.b1(s, d).where("symbol = 'click'").drop("ingested_at"), "c1",
    "SELECT symbol, ts, open, high, low, close, volume FROM c1 WHERE symbol = 'click'", F1)
add("s3_payload_candles", lambda s, d: payloads.candles_from_payload(B.candle_payloads(B.b1(s, d))), "c1",
    "SELECT symbol, ts, open, high, low, close, volume FROM c1 WHERE day(ts) % 5 <> 0", F1)
add("s4_payload_ticker", lambda s, d: payloads.ticker_from_payload(B.ticker_payload(B.ticker(B.market_pull(s, d))), B.ntz(T.AS_OF)), "tk",
    "SELECT symbol, last, CASE WHEN length(symbol) = 7 THEN coalesce(percent_change, 0) ELSE 0.0 END AS percent_change, high_24h, low_24h, volume_thb_24h, snapshot_at FROM tk",
    "last percent_change high_24h low_24h volume_thb_24h")


def state_after(s, d):
    bars = B.market_pull(s, d)
    later = bars.where(F.col("ts") >= B.ntz(dt.datetime(2024, 1, 16)))
    return ingest.advance_state(B.state_before(bars), later, B.ntz(T.AS_OF))


STATE_AFTER = f"""
SELECT coalesce(o.symbol, n.symbol) AS symbol, coalesce(n.last_ts, o.last_ts) AS last_ts, coalesce(n.updated_at, o.updated_at) AS updated_at,
  coalesce(o.rows_total, 0) + coalesce(n.rows_total, 0) AS rows_total, coalesce(o.files, 0) + coalesce(n.files, 0) AS files
FROM st o FULL OUTER JOIN (SELECT symbol, max(CAST(epoch(ts) AS BIGINT)) AS last_ts, count(*) AS rows_total, 1 AS files, {AS_OF} AS updated_at
  FROM cm WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' GROUP BY symbol) n ON n.symbol = o.symbol"""
add("s8_upsert_accumulate", state_after, "cm st", STATE_AFTER)
add("s8_bucketed_merge", S.merged_state, "cm st", STATE_AFTER)


def carried(s, d):
    g = T.gold(s, d)
    old = g.where(F.col("signal_minutes") % 2 == 1).select("event_id", (F.col("signal_minutes") / F.lit(10.0)).alias("anomaly_score"))
    return events.carry_scores(g, old).select("event_id", "symbol", "anomaly_score")


add("s11_carry_scores", carried, "gx1",
    "SELECT event_id, symbol, CASE WHEN signal_minutes % 2 = 1 THEN signal_minutes / 10.0 END AS anomaly_score FROM gx1", "anomaly_score")


def ranges_plan(s, d):
    bars = B.market_pull(s, d)
    wanted = B.listing(s, d).withColumn("selected", F.lit(True))
    return ingest.pull_ranges(wanted, B.state_before(bars), dt.datetime(2024, 3, 20), Settings())


add("s14_pull_ranges", ranges_plan, "ls st", """
WITH p AS (SELECT l.symbol, s.last_ts IS NULL AS is_backfill, coalesce(s.last_ts, CAST(epoch(TIMESTAMP '2024-03-20') AS BIGINT) - 365 * 86400) AS a,
  CAST(epoch(TIMESTAMP '2024-03-20') AS BIGINT) AS b FROM ls l LEFT JOIN st s ON s.symbol = l.symbol),
g AS (SELECT symbol, is_backfill, b, unnest(range(a, b, 2592000)) AS from_s FROM p)
SELECT symbol, is_backfill, from_s, least(from_s + 2592000, b) AS to_s FROM g""")
add("u1_merge_pulls", lambda s, d: candles.latest_candles(candles.merge_pulls(*[
    B.repeated_pulls(s, d).where(F.col("ingested_at") == B.ntz(m)) for m in (B.PULL_1, B.PULL_1 + dt.timedelta(hours=1))])),
    "d3", "SELECT symbol, ts, open, high, low, close, volume FROM d3", F1)

# ------------------------------------------------------------------ projections and predicates
add("p1_quote_volume", lambda s, d: candles.with_quote_volume(candles.latest_candles(B.b1(s, d))).select("symbol", "ts", "vol_thb"), "c1",
    "SELECT symbol, ts, volume * close AS vol_thb FROM c1", "vol_thb")
add("p2_candidates", lambda s, d: events.candidates(candles.build_silver(B.b1(s, d))), "cand1", "SELECT * FROM cand1",
    "open_5m chg_5m vol_x_5m active_share_1d vol5_thb")
add("p3_history_gate", from_raw("vol_x_5m"), "s1", silver_sql("vol_x_5m"), "vol_x_5m")
add("p4_universe", lambda s, d: ingest.tradable(B.ticker(B.market_pull(s, d))).select("symbol", "volume_thb_24h"), "un",
    "SELECT symbol, volume_thb_24h FROM un", "volume_thb_24h")
add("p5_like_escaped", lambda s, d: serving.quoted(B.ticker(B.market_pull(s, d))).select("symbol", "last"), "tk",
    "SELECT symbol, last FROM tk WHERE symbol LIKE '%\\_THB' ESCAPE '\\' AND volume_thb_24h > 0", "last")
KEPT = "start_ts >= TIMESTAMP '2024-01-31' - INTERVAL {days} DAY AND pump_pct >= {p} AND max_vol_x >= {v}"
SINGLE = " AND coalesce(concurrent_symbols, 0) < 2"
DEF = KEPT.format(days=90, p=10, v=10) + SINGLE
add("p6_event_filter", lambda s, d: T.event_filter(days=20, min_pump=15, min_volx=8).apply(T.gold(s, d)).select("event_id", "pump_pct"), "gx1",
    f"SELECT event_id, pump_pct FROM gx1 WHERE {KEPT.format(days=20, p=15, v=8)}{SINGLE}", "pump_pct")
add("p6_event_filter_all_time", lambda s, d: T.event_filter(days=0, single=False).apply(T.gold(s, d)).select("event_id", "pump_pct"), "gx1",
    "SELECT event_id, pump_pct FROM gx1 WHERE pump_pct >= 10 AND max_vol_x >= 10", "pump_pct")
add("p7_drop_columns", lambda s, d: candles.first_seen(B.b1(s, d)).drop("first_ts", "ingested_at"), "c1",
    "SELECT * EXCLUDE (ingested_at) FROM c1", F1)
add("p8_pump_label", lambda s, d: warning.labelled(warning.triggers(T.silver(s, d))).select("symbol", "ts", "future_gain", "gap_min", "label"), "lb",
    "SELECT symbol, ts, future_gain, gap_min, label FROM lb", "future_gain")
add("p9_direction_label", lambda s, d: direction.directions(T.silver(s, d)).select("symbol", "ts", "fwd_ret", "up"), "dr",
    "SELECT symbol, ts, fwd_ret, up FROM dr", "fwd_ret")
add("p10_complete_hours", lambda s, d: grid.complete_hours(T.hourly(s, d), serving.at(dt.datetime(2024, 1, 20, 12, 30))).select("symbol", "hour_utc", "candles"), "hrm",
    "SELECT symbol, hour_utc, candles FROM hrm WHERE hour_utc < TIMESTAMP '2024-01-20 12:00:00'")
add("p11_risk_tags", lambda s, d: T.coin_stats(s, d).join(B.listing(s, d), "symbol").withColumn(
    "days_listed", F.datediff(B.ntz(T.AS_OF), "listed_at")).select("symbol", F.array_join(serving.risk_tags(), "|").alias("tags")), "csm ls", f"""
SELECT c.symbol, concat_ws('|', CASE WHEN date_diff('day', l.listed_at, {AS_OF}) < 90 THEN 'new listing' END,
  CASE WHEN c.active_share < 0.5 THEN 'low liquidity' END) AS tags FROM csm c JOIN ls l ON l.symbol = c.symbol""")
add("p12_outcome", lambda s, d: T.warnings(s, d).select("symbol", "ts", "outcome"), "wn", "SELECT symbol, ts, outcome FROM wn")
add("p13_membership", lambda s, d: T.hourly(s, d).join(serving.top_symbols(T.coin_stats(s, d), 3), "symbol", "left_semi").select("symbol", "hour_utc", "close"),
    "hrm csm", "SELECT symbol, hour_utc, close FROM hrm WHERE symbol IN (SELECT symbol FROM csm ORDER BY avg_daily_vol_thb_30d DESC NULLS LAST, symbol LIMIT 3)", "close")

# ------------------------------------------------------------------ joins
add("j1_peak_range_join", lambda s, d: events.event_peaks(T.facts(s, d), T.silver(s, d)), "pk1",
    "SELECT symbol, CAST(eid AS BIGINT) AS eid, peak_price, peak_ts, vol_thb_event FROM pk1", "peak_price vol_thb_event")


def aftermath(s, d):
    f, sv = T.facts(s, d), T.silver(s, d)
    return events.event_aftermath(f.join(events.event_peaks(f, sv), ["symbol", "eid"]), sv)


add("j2_after_range_join", aftermath, "af1", "SELECT symbol, CAST(eid AS BIGINT) AS eid, min_low_after, half_retrace_ts FROM af1", "min_low_after")


def three_way(s, d):
    f, sv = T.facts(s, d), T.silver(s, d)
    k = ["symbol", "eid"]
    peaks = f.join(events.event_peaks(f, sv), k)
    return peaks.join(events.event_aftermath(peaks, sv), k).select("symbol", "eid", "start_ts", "peak_ts", "min_low_after", "base_price")


add("j3_three_way_join", three_way, "ev1 pk1 af1", """
SELECT e.symbol, CAST(e.eid AS BIGINT) AS eid, e.start_ts, p.peak_ts, a.min_low_after, e.base_price
FROM ev1 e JOIN pk1 p USING (symbol, eid) JOIN af1 a USING (symbol, eid)""", "min_low_after base_price")
add("j4_concurrent_symbols", lambda s, d: T.gold(s, d).select("event_id", "concurrent_symbols"), "gx1", "SELECT event_id, concurrent_symbols FROM gx1")
add("j4_concurrent_symbols_market", lambda s, d: events.with_concurrency(T.gold(s, d, "m").drop("concurrent_symbols")).select("event_id", "concurrent_symbols"), "gxm",
    "SELECT event_id, concurrent_symbols FROM gxm")
add("j5_event_candles", lambda s, d: events.event_candles(T.gold(s, d), T.silver(s, d)), "ec1", "SELECT * FROM ec1", "open high low close vol_thb")


def risk_sql(where: str) -> str:
    """Events counted by coin first, then the two lookups."""
    return f"""WITH hits AS (SELECT symbol, pump_pct, CAST(is_pump_dump AS INTEGER) AS fell FROM gxm WHERE {where}),
per AS (SELECT symbol, count(*) AS events, CAST(sum(fell) AS BIGINT) AS pump_dumps, max(pump_pct) AS max_pump_pct FROM hits GROUP BY symbol)
SELECT per.*, (SELECT name FROM pr WHERE pr.symbol = per.symbol) AS name,
  (SELECT date_diff('day', listed_at, {AS_OF}) FROM pr WHERE pr.symbol = per.symbol) AS days_listed, life.active_share,
  life.avg_daily_vol_thb_30d AS avg_daily_vol_thb
FROM per LEFT JOIN csm life ON life.symbol = per.symbol"""


def riskiest(n: int) -> str:
    return f"SELECT * FROM ({risk_sql(DEF)}) ORDER BY events DESC, max_pump_pct DESC, symbol LIMIT {n}"


RISK_D = "max_pump_pct active_share avg_daily_vol_thb"
add("j6_lookup_joins", lambda s, d: serving.coin_risk(T.Tables(s, d), T.event_filter(days=0, single=False)), "gxm pr csm",
    risk_sql("pump_pct >= 10 AND max_vol_x >= 10"), RISK_D)
# hourly log returns of the last month; the hour before is the nearest earlier one
RET = """priced AS (SELECT symbol, hour_utc, close FROM hrm WHERE close > 0 AND hour_utc + INTERVAL 30 DAY >= (SELECT max(hour_utc) FROM hrm)),
moves AS (SELECT n.symbol, n.hour_utc, ln(n.close / o.close) AS r FROM priced n ASOF JOIN priced o ON o.symbol = n.symbol AND n.hour_utc > o.hour_utc)"""


def corr(a: str, b: str) -> str:
    return f"CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN corr({a}, {b}) END"


MATRIX_SQL = f"""WITH {RET}, largest AS (FROM csm SELECT symbol ORDER BY avg_daily_vol_thb_30d DESC NULLS LAST, symbol LIMIT 15),
kept AS (SELECT moves.* FROM moves SEMI JOIN largest ON largest.symbol = moves.symbol),
hours AS (SELECT x.symbol AS a, y.symbol AS b, x.r AS ra, y.r AS rb FROM kept x, kept y WHERE x.hour_utc = y.hour_utc AND y.symbol >= x.symbol)
SELECT a, b, count(*) AS n, {corr('ra', 'rb')} AS c FROM hours GROUP BY ALL"""
BENCH_SQL = f"""WITH {RET}, lead AS (SELECT hour_utc, r AS rb FROM moves WHERE symbol = '{BENCH}'),
both_sides AS (SELECT symbol, count(*) AS n, {corr('r', 'rb')} AS c FROM moves JOIN lead ON lead.hour_utc = moves.hour_utc WHERE symbol <> '{BENCH}' GROUP BY symbol)
FROM both_sides WHERE n >= 24"""
add("j7_pairwise_hours", lambda s, d: serving.correlations(T.Tables(s, d)).select("a", "b", "n"), "hrm csm", f"SELECT a, b, n FROM ({MATRIX_SQL})")
add("j8_benchmark_hours", lambda s, d: serving.benchmark_correlations(T.Tables(s, d), BENCH).select("symbol", "n"), "hrm", f"SELECT symbol, n FROM ({BENCH_SQL})")


def live_sql(model: str, symbol: str, actual: str) -> str:
    """The newest forecast of every hour beside what happened; ``actual`` has hour_utc and v."""
    return f"""WITH newest AS (
  SELECT target_hour_utc AS hour_utc, max(generated_at) AS generated_at FROM fh WHERE model_name = '{model}' AND symbol = '{symbol}' GROUP BY target_hour_utc)
SELECT w.hour_utc, w.generated_at, fh.predicted, happened.v AS actual
FROM newest w JOIN ({actual}) happened ON happened.hour_utc = w.hour_utc
JOIN fh ON fh.target_hour_utc = w.hour_utc AND fh.generated_at = w.generated_at AND fh.model_name = '{model}' AND fh.symbol = '{symbol}'"""


LIVE_V = live_sql("volume_forecast", "MARKET", "SELECT hour_utc, vol_thb AS v FROM mkm")
LIVE_R = live_sql("volatility_forecast", BENCH, f"SELECT hour_utc, rv_pct AS v FROM hrm WHERE symbol = '{BENCH}'")
add("j9_forecast_vs_actual", lambda s, d: serving.live_accuracy(T.Tables(s, d), "volatility_forecast", BENCH), "fh hrm", LIVE_R, "predicted actual")
add("j10_semi_join", lambda s, d: ingest.tracked_pairs(T.pairs(s, d), B.state_before(B.market_pull(s, d))).select("symbol", "name"), "pr st",
    "SELECT symbol, name FROM pr WHERE symbol IN (SELECT symbol FROM st)")
add("j11_time_anchor", lambda s, d: serving.since_latest(T.hourly(s, d), "hour_utc", 3).select("symbol", "hour_utc", "candles"), "hrm",
    "SELECT symbol, hour_utc, candles FROM hrm WHERE hour_utc >= (SELECT max(hour_utc) FROM hrm) - INTERVAL 3 DAY")
add("j12_target_encoding", lambda s, d: T.encoded_volatility(s, d).select("symbol", "hour_utc", "sym_mean", "is_test"), "re",
    "SELECT symbol, hour_utc, sym_mean, is_test FROM re", "sym_mean")

# ------------------------------------------------------------------ aggregations
add("a1_session_aggregate", lambda s, d: T.facts(s, d), "ev1", "SELECT * REPLACE (CAST(eid AS BIGINT) AS eid) FROM ev1",
    "base_price max_vol_x max_chg_5m_pct active_share_1d")
add("a2_peak_aggregate", lambda s, d: events.event_paths(T.facts(s, d), T.silver(s, d)).select("symbol", "eid", "peak_price", "peak_ts", "vol_thb_event"), "pk1",
    "SELECT symbol, CAST(eid AS BIGINT) AS eid, peak_price, peak_ts, vol_thb_event FROM pk1", "peak_price vol_thb_event")
add("a3_filtered_aggregate", lambda s, d: events.event_paths(T.facts(s, d), T.silver(s, d)).select("symbol", "eid", "min_low_after", "half_retrace_ts"), "af1",
    "SELECT symbol, CAST(eid AS BIGINT) AS eid, min_low_after, half_retrace_ts FROM af1", "min_low_after")
add("a4_event_measures", lambda s, d: events.measured(events.event_paths(T.facts(s, d), T.silver(s, d))), "ge1", "SELECT * FROM ge1", EVENT_D)
HOURLY_D = "vol_thb open high low close rv_pct range_pct"
add("a5_symbol_hourly", lambda s, d: rollups.symbol_hourly(T.silver(s, d)), "hr1", "SELECT * FROM hr1", HOURLY_D)
add("a6_market_hourly", lambda s, d: rollups.market_hourly(rollups.symbol_hourly(T.silver(s, d))), "mk1", "SELECT * FROM mk1", "vol_thb avg_rv_pct")
add("a7_coin_stats", lambda s, d: rollups.coin_stats(T.silver(s, d)), "cs1", "SELECT * FROM cs1", "active_share avg_daily_vol_thb_30d last_close")
add("a8_data_quality", lambda s, d: candles.data_quality(B.repeated_pulls(s, d)), "dq3", "SELECT * FROM dq3", "active_share")
KPI_SQL = """WITH kept AS (SELECT symbol, pump_pct, dump_pct, CASE WHEN is_pump_dump THEN minutes_to_half_retrace END AS fell_in FROM {src} WHERE {where}),
fallen AS (SELECT count(*) AS n FROM {src} WHERE is_pump_dump AND {where})
SELECT (SELECT count(*) FROM kept) AS events, (SELECT n FROM fallen) AS pump_dumps, (SELECT median(fell_in) FROM kept) AS median_minutes_to_dump,
  (SELECT avg(pump_pct) FROM kept) AS avg_pump_pct, (SELECT avg(dump_pct) FROM kept) AS avg_dump_pct,
  (SELECT count(*) FROM (SELECT DISTINCT symbol FROM kept)) AS coins_hit"""
add("a9_event_kpis", lambda s, d: serving.event_kpis(T.event_filter().apply(T.gold(s, d))), "gx1", KPI_SQL.format(src="gx1", where=DEF),
    "avg_pump_pct median_minutes_to_dump avg_dump_pct")
add("a10_top_coin", lambda s, d: serving.top_coin(T.event_filter().apply(T.gold(s, d))), "gx1",
    f"SELECT symbol, count(*) AS n FROM gx1 WHERE {DEF} GROUP BY 1 ORDER BY n DESC, symbol LIMIT 1")
add("a11_heatmap", lambda s, d: serving.heatmap(T.Tables(s, d), T.event_filter()), "gxm",
    f"SELECT dow_local, hour_local, count(*) AS n FROM gxm WHERE {DEF} GROUP BY 1, 2")
# counted from the pulled candles themselves, not from the report by symbol
TOTALS = """WITH pulled AS (SELECT symbol, ts, ingested_at FROM c{x}), kept AS (SELECT DISTINCT symbol, ts FROM pulled),
files AS (SELECT DISTINCT symbol, ingested_at FROM pulled), n AS (SELECT (SELECT count(*) FROM pulled) AS a, (SELECT count(*) FROM kept) AS b)
SELECT (SELECT count(DISTINCT symbol) FROM kept) AS coins, n.a AS bronze_rows, n.b AS candles, n.a - n.b AS duplicates,
  (SELECT count(*) FROM files) AS bronze_files, (SELECT min(ts) FROM kept) AS first_ts, (SELECT max(ts) FROM kept) AS last_ts,
  (SELECT avg(active_share) FROM dq{x}) AS avg_active_share FROM n"""
add("a12_lake_totals", lambda s, d: serving.lake_totals(candles.data_quality(B.repeated_pulls(s, d))), "dq3", TOTALS.format(x="3"), "avg_active_share")
ING_SQL = """WITH by_run AS (
  SELECT run_at, CAST(sum(rows) AS BIGINT) AS n, CAST(sum(api_calls) AS BIGINT) AS calls, CAST(sum(duration_ms) AS BIGINT) AS ms FROM lg GROUP BY run_at),
newest AS (FROM by_run ORDER BY run_at DESC LIMIT 1)
SELECT newest.run_at AS last_run, (SELECT count(*) FROM by_run) AS runs, (SELECT CAST(sum(calls) AS BIGINT) FROM by_run) AS api_calls,
  newest.n AS last_run_rows, newest.calls AS last_run_calls, newest.ms AS last_run_ms FROM newest"""
add("a13_ingest_summary", lambda s, d: serving.ingest_summary(B.ingest_log(B.market_pull(s, d))), "lg", ING_SQL)
add("a14_pairwise_correlation", lambda s, d: serving.correlations(T.Tables(s, d)).where("n >= 24"), "hrm csm", f"SELECT * FROM ({MATRIX_SQL}) WHERE n >= 24", "c")
SPARK_SQL = """WITH fourth AS (SELECT symbol, hour_utc, close FROM hrm WHERE CAST(epoch(hour_utc) AS BIGINT) % 14400 = 0),
since AS (SELECT max(hour_utc) - INTERVAL 168 HOUR AS t FROM hrm)
SELECT symbol, array_agg(close ORDER BY hour_utc) AS spark FROM fourth, since WHERE hour_utc >= t GROUP BY symbol"""
add("a15_sparkline", lambda s, d: serving.sparklines(T.hourly(s, d)), "hrm", SPARK_SQL)


def bucket_sql(unit: str, days: int) -> str:
    return f"""SELECT CAST(date_trunc('{unit}', hour_utc) AS TIMESTAMP) AS t, arg_max(close, hour_utc) AS close, max(high) AS high, min(low) AS low,
  sum(vol_thb) AS vol_thb, avg(rv_pct) AS rv_pct FROM hrm WHERE symbol = '{BENCH}'
  AND hour_utc >= (SELECT max(hour_utc) FROM hrm WHERE symbol = '{BENCH}') - INTERVAL {days} DAY GROUP BY 1"""


COIN_D = "close high low vol_thb rv_pct"
add("a16_rebucket_hour", lambda s, d: serving.coin_series(T.Tables(s, d), BENCH, 30), "hrm", bucket_sql("hour", 30), COIN_D)
add("a16_rebucket_day", lambda s, d: serving.coin_series(T.Tables(s, d), BENCH, 90), "hrm", bucket_sql("day", 90), COIN_D)
STRONG = "start_ts >= TIMESTAMP '2024-01-31' - INTERVAL 90 DAY AND pump_pct >= 10 AND max_vol_x >= 10"
add("a17_event_counts", lambda s, d: serving.event_counts(T.gold(s, d, "m"), T.AS_OF), "gxm", f"SELECT symbol, count(*) AS events_90d FROM gxm WHERE {STRONG} GROUP BY 1")
RV_SQL = f"SELECT avg(rv_pct) AS avg_rv_30d FROM hrm WHERE symbol = '{BENCH}' AND hour_utc >= (SELECT max(hour_utc) FROM hrm) - INTERVAL 30 DAY"
add("a17_mean_volatility", lambda s, d: serving.mean_volatility(T.Tables(s, d), BENCH), "hrm", RV_SQL, "avg_rv_30d")
E_DEF = DEF.replace("start_ts", "e.start_ts", 1)
add("a18_coin_ranking", lambda s, d: serving.risky_coins(T.Tables(s, d), T.event_filter(), 5).drop("tags"), "gxm pr csm", riskiest(5), RISK_D)
add("a19_split_cut", lambda s, d: stats.split_cut(forecast.training_rows(T.volatility_frame(s, d)), "hour_utc"), "rc", "SELECT cut FROM rc")


def scores_sql(m: str) -> str:
    def one(c: str, name: str) -> str:
        return f"avg(abs({c} - actual) / nullif(actual, 0)) * 100 AS {name}mape, sqrt(avg(({c} - actual) * ({c} - actual))) AS {name}rmse"

    return f"""SELECT count(*) AS n, count(*) FILTER (WHERE actual = 0) AS zero_actuals, {one('predicted', '')}, {one('baseline', 'baseline_')}
FROM bt WHERE model_name = '{m}'"""


SCORES_D = "mape rmse baseline_mape baseline_rmse"
add("a20_volume_scores", lambda s, d: stats.regression_scores(T.backtest(s, d).where("model_name = 'volume_forecast'")), "bt", scores_sql("volume_forecast"), SCORES_D)
add("a20_volatility_scores", lambda s, d: stats.regression_scores(T.backtest(s, d).where("model_name = 'volatility_forecast'")), "bt", scores_sql("volatility_forecast"), SCORES_D)


def auc_sql(score: str) -> str:
    return f"""(SELECT sum(CASE WHEN p.{score} > q.{score} THEN 1.0 WHEN p.{score} = q.{score} THEN 0.5 ELSE 0 END) / nullif(count(*), 0)
  FROM t p, t q WHERE p.label = 1 AND q.label = 0)"""


def pr_sql(cond: str, name: str) -> str:
    return f"""coalesce(count(*) FILTER (WHERE label = 1 AND {cond}) / nullif(count(*) FILTER (WHERE {cond}), 0)::DOUBLE, 0) AS {name}precision,
  coalesce(count(*) FILTER (WHERE label = 1 AND {cond}) / nullif(count(*) FILTER (WHERE label = 1), 0)::DOUBLE, 0) AS {name}recall"""


def warn_scores(s, d):
    test = T.labelled(s, d).where("is_test").withColumn("prob", F.col("chg_5m") / (1 + F.col("chg_5m")))
    return warning.evaluation(test)


add("a21_classification_scores", warn_scores, "lt", f"""
WITH t AS (SELECT label, vol_x_5m, chg_5m / (1 + chg_5m) AS prob FROM lt WHERE is_test)
SELECT {auc_sql('prob')} AS auc, {auc_sql('vol_x_5m')} AS baseline_auc, {pr_sql('prob >= 0.5', '')}, avg(label) AS positive_rate, {pr_sql('vol_x_5m >= 10', 'rule_')} FROM t""",
    "auc baseline_auc precision recall positive_rate rule_precision rule_recall")


def dir_scores(s, d):
    split = stats.time_split(direction.directions(T.silver(s, d)), "ts")
    return stats.direction_scores(split.withColumn("pred", F.when(F.col("ret_1m") < 0, 1).otherwise(0)))


add("a22_direction_scores", dir_scores, "dr", """
WITH c AS (SELECT ts AS cut FROM (SELECT ts, row_number() OVER (ORDER BY ts) AS rn FROM dr) WHERE rn = CAST(floor((SELECT count(*) FROM dr) * 0.8::DOUBLE) AS BIGINT) + 1),
t AS (SELECT *, ts >= (SELECT cut FROM c) AS is_test, CASE WHEN ret_1m < 0 THEN 1 ELSE 0 END AS pred FROM dr),
m AS (SELECT CASE WHEN avg(up) >= 0.5 THEN 1 ELSE 0 END AS maj FROM t WHERE NOT is_test)
SELECT (SELECT count(*) FROM t WHERE NOT is_test) AS train_rows, count(*) AS test_rows, avg(CAST(pred = up AS INTEGER)) * 100 AS accuracy,
  avg(CAST(up = (SELECT maj FROM m) AS INTEGER)) * 100 AS baseline, count(*) FILTER (WHERE pred = 1) AS trades,
  coalesce(avg(fwd_ret) FILTER (WHERE pred = 1) * 100, 0) AS gross_pct, coalesce(avg(fwd_ret) FILTER (WHERE pred = 1) * 100, 0) - 0.5 AS net_pct
FROM t WHERE is_test""", "accuracy baseline gross_pct net_pct")


def naive_band(s, d):
    """Bands of a forecast that repeats the last known value."""
    frame = T.volatility_frame(s, d)
    cut = stats.split_cut(forecast.training_rows(frame), "hour_utc").scalar()
    origins = forecast.test_origins(frame, cut, 6)
    return forecast.error_band(origins.withColumn("path", F.array_repeat(F.element_at("past", -1), 6))).select("symbol", F.col("h").cast("bigint").alias("h"), "n", "lo", "hi")


BAND_SQL = """WITH p AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY hour_utc) - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS len FROM rd),
e AS (SELECT o.symbol, f.pos - o.pos AS h, f.y - o.y AS err FROM p o JOIN p f ON f.symbol = o.symbol AND f.pos - o.pos BETWEEN 1 AND 6
  WHERE o.hour_utc >= (SELECT cut FROM rc) - INTERVAL 1 HOUR AND o.pos >= 24 AND o.pos + 6 < o.len),
b AS (SELECT symbol, h, count(err) AS n, quantile_cont(err, 0.1) AS lo, quantile_cont(err, 0.9) AS hi FROM e GROUP BY symbol, h)
SELECT symbol, CAST(h AS BIGINT) AS h, n, lo, hi FROM b WHERE symbol IN (SELECT symbol FROM b GROUP BY symbol HAVING min(n) >= 50)"""
add("a23_error_band", naive_band, "rd rc", BAND_SQL, "lo hi")
add("a24_gate_hours", lambda s, d: forecast.enough_hours(T.market(s, d)), "mkm", "SELECT count(*) AS have, 336::BIGINT AS need, count(*) >= 336 AS ok FROM mkm")
add("a24_gate_triggers", lambda s, d: warning.gate(T.labelled(s, d)), "lt", """SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives,
  count(DISTINCT CASE WHEN is_test THEN label END) AS test_classes, count(*) >= 200 AND sum(label) >= 20 AND count(DISTINCT CASE WHEN is_test THEN label END) = 2 AS ok FROM lt""")
add("a24_gate_direction", lambda s, d: direction.enough_rows(direction.directions(T.silver(s, d))), "dr", "SELECT count(*) AS rows, count(*) >= 5000 AS ok FROM dr")
add("a24_gate_anomaly", lambda s, d: anomaly.enough_events(T.gold(s, d)), "gx1", "SELECT count(*) AS events, count(*) >= 30 AS ok FROM gx1")
MED = ["pump_pct", "min_low_after", "dump_pct", "minutes_to_half_retrace"]
add("a25_median_imputation", lambda s, d: stats.impute_medians(T.gold(s, d).select("event_id", *MED), MED), "gx1",
    "SELECT event_id, " + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM gx1)) AS {c}" for c in MED) + " FROM gx1", " ".join(MED))

# ------------------------------------------------------------------ windows
add("w1_latest_wins", lambda s, d: candles.latest_candles(B.repeated_pulls(s, d)), "d3", "SELECT * FROM d3", F1)
for _key, _cols, _dbl in (
    ("w2_lag_return_gap", "ret_1m gap_min", "ret_1m:9"), ("w3_open_5m", "open_5m chg_5m", "open_5m chg_5m:9"), ("w4_vol5", "vol5_thb", "vol5_thb"),
    ("w5_volume_baseline", "base_vpm_thb", "base_vpm_thb:10"), ("w6_active_share", "active_share_1d", "active_share_1d"),
    ("w7_forward_extremes", "max_high_next60 min_low_next60", "max_high_next60 min_low_next60"), ("w8_close_next15", "close_next15", "close_next15"),
):
    add(_key, from_raw(_cols), "s1", silver_sql(_cols), _dbl)
add("silver_features", lambda s, d: candles.build_silver(B.repeated_pulls(s, d)), "s3", "SELECT * FROM s3", SILVER_D)
add("w9_first_ts_range", lambda s, d: candles.first_seen(candles.latest_candles(B.b1(s, d))).select(
    "symbol", "ts", "first_ts", ratio(F.col("high") - F.col("low"), F.col("low")).alias("range_1m")), "c1",
    "SELECT symbol, ts, min(ts) OVER (PARTITION BY symbol) AS first_ts, (high - low) / nullif(low, 0) AS range_1m FROM c1", "range_1m")
add("w10_sessions", lambda s, d: events.sessions(T.silver(s, d).transform(events.candidates)).select("symbol", "ts", F.col("is_new").cast("int").alias("is_new"), "eid"), "num1",
    "SELECT symbol, ts, is_new, CAST(eid AS BIGINT) AS eid FROM num1")
TRG_D = "chg_5m vol_x_5m ret_1m range_1m active_share_1d log_vol5 future_gain"
add("w11_refractory", lambda s, d: warning.triggers(T.silver(s, d)), "trg1", "SELECT * FROM trg1", TRG_D)
SINCE = dt.datetime(2024, 1, 20, 6)
SINCE_SQL = """SELECT symbol, ts FROM (SELECT symbol, ts, lag(ts) OVER (PARTITION BY symbol ORDER BY ts) AS prev FROM s1
  WHERE chg_5m >= 0.03 AND vol_x_5m >= 3 {before}) WHERE (prev IS NULL OR ts - prev > INTERVAL 30 MINUTE) {after}"""
FROM = "AND ts >= TIMESTAMP '2024-01-20 06:00:00'"
add("w11_refractory_since", lambda s, d: warning.triggers(T.silver(s, d), since=serving.at(SINCE)).select("symbol", "ts"), "s1", SINCE_SQL.format(before=FROM, after=""))
add("w11_refractory_full_history", lambda s, d: warning.triggers(T.silver(s, d), since=serving.at(SINCE), full_history=True).select("symbol", "ts"), "s1",
    SINCE_SQL.format(before="", after=FROM))
add("w12_latest_per_key", lambda s, d: serving.latest_per(T.hourly(s, d), ["symbol"], ["hour_utc"]).select("symbol", "hour_utc", "close"), "hrm",
    "SELECT symbol, hour_utc, close FROM hrm QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY hour_utc DESC) = 1", "close")
add("w13_densify_null", lambda s, d: T.volume_frame(s, d).select("hour_utc", "y"), "vd", "SELECT hour_utc, y FROM vd", "y")
add("w13_densify_zero", lambda s, d: T.volatility_frame(s, d).select("symbol", "hour_utc", "y", "lv"), "rd", "SELECT symbol, hour_utc, y, lv FROM rd", "y lv")
add("w14_average_rank", lambda s, d: stats.average_rank(T.gold(s, d).select("event_id", "signal_minutes", F.round("max_vol_x", 0).alias("v")), "v", "pct_rank").select("event_id", "pct_rank"), "gx1", """
SELECT event_id, (rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0) / count(*) OVER () AS pct_rank FROM (SELECT event_id, round(max_vol_x, 0) AS v FROM gx1)""", "pct_rank")
add("w15_dense_lags", lambda s, d: T.volatility_frame(s, d).select("symbol", "hour_utc", "lag1", "lag2", "lag3", "lag24"), "rf", "SELECT symbol, hour_utc, lag1, lag2, lag3, lag24 FROM rf", "lag1 lag2 lag3 lag24")
add("w16_rolling_mean_12", lambda s, d: T.volume_frame(s, d).select("hour_utc", "roll24"), "vf", "SELECT hour_utc, roll24 FROM vf", "roll24")
add("w16_rolling_mean_24", lambda s, d: T.volatility_frame(s, d).select("symbol", "hour_utc", "roll24"), "rf", "SELECT symbol, hour_utc, roll24 FROM rf", "roll24")
add("w17_log_return", lambda s, d: stats.hourly_returns(T.hourly(s, d)), "hrm", """
SELECT symbol, hour_utc, ln(close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY hour_utc), 0)) AS r FROM hrm WHERE close > 0""", "r")
add("w18_volume_rank", lambda s, d: ingest.ranked(B.ticker(B.market_pull(s, d)), 5), "un",
    "SELECT symbol, volume_thb_24h, CASE WHEN rn <= 5 THEN CAST(rn AS INTEGER) END AS rank_24h, rn <= 5 AS selected FROM un", "volume_thb_24h")

# ------------------------------------------------------------------ top-k and sampling
add("t1_top_symbols", lambda s, d: serving.top_symbols(T.coin_stats(s, d), 10), "tp", "SELECT symbol FROM tp")
add("t2_recent_events", lambda s, d: T.gold(s, d).orderBy(F.desc("start_ts"), "symbol").limit(100).select("event_id", "start_ts"), "gx1",
    "SELECT event_id, start_ts FROM gx1 ORDER BY start_ts DESC, symbol LIMIT 100")
MOVE = """WITH r AS (SELECT t.symbol, t.last, t.percent_change, t.volume_thb_24h, coalesce(p.selected, false) AS tracked FROM tk t LEFT JOIN pr p ON p.symbol = t.symbol
  WHERE t.symbol LIKE '%\\_THB' ESCAPE '\\' AND t.volume_thb_24h > 0)
SELECT * FROM (SELECT *, 'gainer' AS side FROM r ORDER BY percent_change DESC NULLS LAST, symbol LIMIT {n}) UNION ALL
SELECT * FROM (SELECT *, 'loser' AS side FROM r ORDER BY percent_change ASC NULLS LAST, symbol LIMIT {n})"""
MOVE_D = "last percent_change volume_thb_24h"
add("t3_gainers_losers", lambda s, d: serving.movers(T.Tables(s, d), 3), "tk pr", MOVE.format(n=3), MOVE_D)
add("t4_newest_log_row", lambda s, d: serving.newest_row(B.refresh_log(B.market_pull(s, d)), "refreshed_at"), "rl", "SELECT * FROM rl ORDER BY refreshed_at DESC LIMIT 1", "duration_s")
add("t5_mixed_order", lambda s, d: T.Tables(s, d)["pairs"].orderBy(F.asc_nulls_last("rank_24h"), F.desc("symbol")).limit(6).select("symbol", "rank_24h"), "pr",
    "SELECT symbol, rank_24h FROM pr ORDER BY rank_24h NULLS LAST, symbol DESC LIMIT 6")
add("t6_hash_sample", lambda s, d: sampling.hash_sample(T.silver(s, d).select("symbol", "ts"), [F.col("symbol"), F.date_format("ts", "yyyyMMddHHmm")], 2000, 42), "s1",
    "SELECT symbol, ts FROM s1 ORDER BY md5(symbol || '|' || strftime(ts, '%Y%m%d%H%M') || '|42') LIMIT 2000")
add("f1_cyclic_time", lambda s, d: T.gold(s, d).select("event_id", *cyclic("start_ts")), "gx1", """
SELECT event_id, sin(2 * pi() * hour(start_ts + INTERVAL 7 HOUR) / 24) AS hour_sin, cos(2 * pi() * hour(start_ts + INTERVAL 7 HOUR) / 24) AS hour_cos,
  CAST(isodow(start_ts + INTERVAL 7 HOUR) - 1 AS INTEGER) AS dow FROM gx1""", "hour_sin hour_cos")


def natural_bounds(s, d):
    rows = T.volatility_frame(s, d).where("roll24 IS NOT NULL")
    lower, upper = forecast.bounds(F.col("roll24"), F.when(F.col("y") > 0, -F.col("y")), F.col("y") / 2)
    return rows.select("symbol", "hour_utc", lower.alias("lower"), upper.alias("upper"))


add("f2_band_bounds", natural_bounds, "rf", """SELECT symbol, hour_utc, CASE WHEN y > 0 THEN greatest(0.0, exp(roll24 - y) - 1) END AS lower, exp(roll24 + y / 2) - 1 AS upper
FROM rf WHERE roll24 IS NOT NULL""", "lower upper")

# ------------------------------------------------------------------ learning, relational part
add("m1_volume_frame", lambda s, d: forecast.training_rows(T.volume_frame(s, d)), "vt", "SELECT * FROM vt", FRAME_D)
add("m2_volatility_frame", lambda s, d: T.encoded_volatility(s, d), "re", "SELECT * FROM re", FRAME_D + " lv vol_lag1 sym_mean")
add("m10_champion_gate", lambda s, d: registry.replay(B.trials(s, d)), "mx", "SELECT * FROM mx", "value:9 baseline:9 champion:9")
add("m11_backtest_rows", lambda s, d: T.backtest(s, d), "bt", "SELECT * FROM bt", "actual predicted baseline")
STATUS = """WITH marks AS (
  SELECT model_name, max(run_at) AS run_at, max(CASE WHEN deployed THEN run_at END) AS deployed_at FROM mx GROUP BY model_name)
SELECT m.*, marks.deployed_at, (SELECT d.value FROM mx d WHERE d.model_name = marks.model_name AND d.run_at = marks.deployed_at) AS deployed_value
FROM marks JOIN mx m ON m.model_name = marks.model_name AND m.run_at = marks.run_at"""
add("m12_model_status", lambda s, d: serving.model_status(T.Tables(s, d)), "mx", STATUS, "value:9 baseline:9 champion:9 deployed_value:9")

# ------------------------------------------------------------------ read queries
OVER_D = "avg_active_share duration_s avg_pump_pct median_minutes_to_dump avg_dump_pct"
add("q1_overview", lambda s, d: serving.overview(T.Tables(s, d), T.event_filter()), "dqm lg rl mx gxm", f"""
SELECT l.coins > 0 AS ready, l.*, i.*, g.refreshed_at, g.duration_s, g.events AS refresh_events,
  (SELECT count(DISTINCT model_name) FROM mx WHERE deployed) AS models_deployed, k.*, (SELECT count(*) FROM gxm) AS candidates_total,
  t.symbol AS top_symbol, t.n AS top_n
FROM ({TOTALS.format(x='m')}) l, ({ING_SQL}) i, (SELECT * FROM rl ORDER BY refreshed_at DESC LIMIT 1) g, ({KPI_SQL.format(src='gxm', where=DEF)}) k
LEFT JOIN (SELECT symbol, count(*) AS n FROM gxm WHERE {DEF} GROUP BY 1 ORDER BY n DESC, symbol LIMIT 1) t ON true""", OVER_D)
LIST_COLS = ("e.event_id, e.symbol, p.name, e.start_ts, e.peak_ts, e.base_price, e.peak_price, e.pump_pct, e.max_vol_x, e.max_chg_5m_pct, e.dump_pct, "
             "e.retrace_share, e.minutes_to_peak, e.minutes_to_half_retrace, e.is_pump_dump, e.active_share_1d, e.vol_thb_event, e.concurrent_symbols, e.anomaly_score")
LIST_D = "base_price peak_price pump_pct max_vol_x max_chg_5m_pct dump_pct retrace_share minutes_to_peak minutes_to_half_retrace active_share_1d vol_thb_event"
add("q2_event_list", lambda s, d: serving.event_list(T.Tables(s, d), T.event_filter(), 200), "gxm pr", f"""
SELECT {LIST_COLS}, CAST(trunc(epoch(e.start_ts - p.listed_at) / 86400) AS BIGINT) AS days_since_listing
FROM gxm e LEFT JOIN pr p ON p.symbol = e.symbol WHERE {E_DEF} ORDER BY e.start_ts DESC, e.symbol LIMIT 200""", LIST_D)
add("q3_candles_of_event", lambda s, d: serving.candles_of_event(T.Tables(s, d), T.gold(s, d, "m").agg(F.min("event_id")).scalar()), "ecm gxm",
    "SELECT ts, open, high, low, close, vol_thb FROM ecm WHERE event_id = (SELECT min(event_id) FROM gxm)", "open high low close vol_thb")
add("q4_risky_coins", lambda s, d: serving.risky_coins(T.Tables(s, d), T.event_filter()).withColumn("tags", F.array_join("tags", "|")), "gxm pr csm", f"""
SELECT *, concat_ws('|', CASE WHEN days_listed < 90 THEN 'new listing' END, CASE WHEN active_share < 0.5 THEN 'low liquidity' END) AS tags
FROM ({riskiest(12)})""", RISK_D)
add("q5_heatmap", lambda s, d: serving.heatmap(T.Tables(s, d), T.event_filter(days=0, single=False)), "gxm",
    "SELECT dow_local, hour_local, count(*) AS n FROM gxm WHERE pump_pct >= 10 AND max_vol_x >= 10 GROUP BY 1, 2")
add("q6_market_series", lambda s, d: serving.market_series(T.Tables(s, d), 7), "mkm",
    "SELECT hour_utc, vol_thb, avg_rv_pct, symbols FROM mkm WHERE hour_utc >= (SELECT max(hour_utc) FROM mkm) - INTERVAL 7 DAY", "vol_thb avg_rv_pct")
add("q6_market_forecast", lambda s, d: serving.market_forecast(T.Tables(s, d)), "fc",
    "SELECT target_hour_utc, predicted, lower, upper, generated_at FROM fc WHERE model_name = 'volume_forecast'", "predicted lower upper")
add("q7_volatility_series", lambda s, d: serving.volatility_series(T.Tables(s, d), None, 3), "hrm fc", """
WITH c AS (SELECT min(symbol) AS symbol FROM fc WHERE model_name = 'volatility_forecast')
SELECT symbol, hour_utc, rv_pct, vol_thb FROM hrm WHERE symbol = (SELECT symbol FROM c)
  AND hour_utc >= (SELECT max(hour_utc) FROM hrm WHERE symbol = (SELECT symbol FROM c)) - INTERVAL 3 DAY""", "rv_pct vol_thb")
add("q7_volatility_forecast", lambda s, d: serving.volatility_forecast_rows(T.Tables(s, d), "S03_THB"), "fc",
    "SELECT symbol, target_hour_utc, predicted, lower, upper FROM fc WHERE model_name = 'volatility_forecast' AND symbol = 'S03_THB'", "predicted lower upper")
add("q8_early_warnings", lambda s, d: serving.recent_warnings(T.Tables(s, d)), "wn", "SELECT * FROM wn ORDER BY ts DESC, symbol LIMIT 30", "probability chg_5m_pct vol_x_5m")
add("q9_model_history", lambda s, d: serving.model_history(T.Tables(s, d)), "mx",
    "SELECT model_name, metric, value, baseline, higher_is_better, deployed, run_at FROM mx WHERE model_name <> 'anomaly_scoring'", "value:9 baseline:9")
add("q10_movers", lambda s, d: serving.movers(T.Tables(s, d)), "tk pr", MOVE.format(n=6), MOVE_D)
add("q11_recent_runs", lambda s, d: serving.recent_runs(T.Tables(s, d)), "lg", """
SELECT run_at, count(*) AS coins, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(api_calls) AS BIGINT) AS calls, CAST(sum(duration_ms) AS BIGINT) AS duration_ms,
  bool_or(is_backfill) AS backfill FROM lg GROUP BY run_at ORDER BY run_at DESC LIMIT 24""")
add("q11_quality", lambda s, d: serving.quality_by_liquidity(T.Tables(s, d)), "dqm", "SELECT symbol, candles, duplicates, active_share, first_ts, last_ts FROM dqm", "active_share")
# Prices and shares are totals over the pulled candles of a symbol: the newest close is the ticker's price and, where a symbol has no ticker, the
# last one of its statistics. What isn't a total is looked up by symbol, one attribute at a time.
DAY = f"FILTER (WHERE ts >= {AS_OF} - INTERVAL 1 DAY)"
TOTALS = f"""arg_max(close, ts) AS last, (arg_max(close, ts) {DAY} / nullif(arg_min(open, ts) {DAY}, 0) - 1) * 100 AS percent_change,
  sum(volume * close) {DAY} AS volume_thb_24h, count(*) / (epoch(max(ts) - min(ts)) / 60 + 1) AS active_share"""
LISTED = "SELECT map(list(symbol), list(name)) AS names, map(list(symbol), list(rank_24h)) AS ranks, map(list(symbol), list(listed_at)) AS dates FROM pr"
add("q12_price_board", lambda s, d: serving.price_board(T.Tables(s, d), T.AS_OF), "pr cm hrm gxm", f"""
WITH totals AS (SELECT symbol, {TOTALS} FROM cm GROUP BY symbol), listed AS ({LISTED}),
lines AS (SELECT map(list(symbol), list(spark)) AS of FROM ({SPARK_SQL})),
strong AS (SELECT histogram(symbol) AS of FROM gxm WHERE {STRONG})
SELECT totals.*, names[symbol] AS name, ranks[symbol] AS rank_24h, dates[symbol] AS listed_at, lines.of[symbol] AS spark,
  CAST(coalesce(strong.of[symbol], 0) AS BIGINT) AS events_90d
FROM totals, listed, lines, strong""", "last percent_change volume_thb_24h active_share")
add("q13_coin_info", lambda s, d: serving.coin_info(T.Tables(s, d), BENCH), "pr cm", f"""
WITH listed AS ({LISTED}), month AS (SELECT max(ts) - INTERVAL 30 DAY AS t FROM cm),
totals AS (
  SELECT symbol, {TOTALS}, max(high) {DAY} AS high_24h, min(low) {DAY} AS low_24h, count(*) AS candles, min(ts) AS first_ts, max(ts) AS last_ts,
    sum(volume * close) FILTER (WHERE ts >= (SELECT t FROM month)) / 30 AS avg_daily_vol_thb_30d
  FROM cm WHERE symbol = '{BENCH}' GROUP BY symbol)
SELECT totals.*, names[symbol] AS name, ranks[symbol] AS rank_24h, dates[symbol] AS listed_at FROM totals, listed""",
    "last percent_change high_24h low_24h volume_thb_24h active_share avg_daily_vol_thb_30d")
add("q13_coin_series", lambda s, d: serving.coin_detail(T.Tables(s, d), BENCH, T.AS_OF, 90)["series"], "hrm", bucket_sql("day", 90), COIN_D)
add("q13_coin_events", lambda s, d: serving.coin_events(T.Tables(s, d), BENCH, T.AS_OF), "gxm", f"""
SELECT event_id, start_ts, peak_ts, pump_pct, dump_pct, max_vol_x, is_pump_dump, concurrent_symbols, anomaly_score FROM gxm WHERE symbol = '{BENCH}' AND {STRONG}""",
    "pump_pct dump_pct max_vol_x")
add("q14_correlation_matrix", lambda s, d: serving.correlations(T.Tables(s, d)), "hrm csm", MATRIX_SQL, "c")
add("q14_benchmark_correlation", lambda s, d: serving.benchmark_correlations(T.Tables(s, d), BENCH), "hrm", BENCH_SQL, "c")
add("q15_backtest_rows", lambda s, d: serving.backtest_rows(T.Tables(s, d), "volume_forecast", "MARKET"), "bt",
    "SELECT hour_utc, actual, predicted, baseline, run_id FROM bt WHERE model_name = 'volume_forecast' AND symbol = 'MARKET'", "actual predicted baseline")
add("q15_live_volume", lambda s, d: serving.live_accuracy(T.Tables(s, d)), "fh mkm", LIVE_V, "predicted actual")
add("q15_backtest_options", lambda s, d: serving.backtest_options(T.Tables(s, d)), "bt", "SELECT DISTINCT model_name, symbol FROM bt")
add("flagship_gold_events", lambda s, d: lakehouse.gold_from(B.b1(s, d)), "gx1", "SELECT * FROM gx1", EVENT_D)

# ------------------------------------------------------------------ sinks, read back
add("s5_partitioned_append", S.appended, "c3", "SELECT * FROM c3", F1)
add("s1_stored_symbol_scan", S.stored_slice, "c1", "SELECT * FROM c1 WHERE symbol = 'click' AND ts >= TIMESTAMP '2024-01-16 11:30:00'", F1)
add("s2_missing_input", S.guarded_scans, "c1", """
SELECT 'all' AS scan, count(*) AS n, min(ts) AS first_ts FROM c1 UNION ALL SELECT 'one', count(*), min(ts) FROM c1 WHERE symbol = 'click'
UNION ALL SELECT unnest(['no folder', 'no table']), 0, NULL""")
add("s5_ticker_append", lambda s, d: S.ingested(s, d).read("bronze_ticker"), "tk_r1 tk_r2", """
SELECT * REPLACE (CASE WHEN length(symbol) = 7 THEN coalesce(percent_change, 0) ELSE 0 END AS percent_change), CAST(snapshot_at AS DATE) AS dt
FROM (FROM tk_r1 UNION ALL FROM tk_r2)""", "last percent_change high_24h low_24h volume_thb_24h")
RUN_ROWS = f"""SELECT {RUN_1} AS run_at, 'r1' AS run, symbol, ts, CAST(NULL AS TIMESTAMP) AS since FROM in_r1
UNION ALL SELECT {AS_OF}, 'r2', symbol, ts, since FROM in_r2"""
add("s9_ingest_log", lambda s, d: S.ingested(s, d).read("ingest_log").drop("duration_ms"), "in_r1 in_r2", f"""
SELECT run_at, symbol, min(ts) AS from_ts, max(ts) AS to_ts, count(*) AS rows, since IS NULL AS is_backfill,
  CAST(ceil(coalesce(epoch(run_at - since) / 86400, 365) / 30) AS INTEGER) AS api_calls, 'bronze_candles_runs/run_id=' || run || '/symbol=' || symbol AS object_key
FROM ({RUN_ROWS}) GROUP BY run_at, run, symbol, since""")
add("s14_ingest_run", S.ingest_state, "in_r1 in_r2", f"""
SELECT symbol, CAST(epoch(max(ts)) AS BIGINT) AS last_ts, count(*) AS rows_total, CAST(count(DISTINCT run) AS INTEGER) AS files, max(run_at) AS updated_at,
  count(*) AS bronze_rows FROM ({RUN_ROWS}) GROUP BY symbol""")
add("s6_silver_overwrite", S.overwritten_silver, "s3", "SELECT * FROM s3", SILVER_D)
add("s6_gold_snapshot", lambda s, d: S.refreshed_lake(s, d).read("events"), "gx3", "SELECT * FROM gx3", EVENT_D)
add("s7_atomic_replace", S.replaced, "hrm", "SELECT count(*) AS first_count, count(*) FILTER (WHERE candles > 1) AS second_count, count(*) FILTER (WHERE candles > 1) AS now FROM hrm")
add("s9_append_log", S.appended_log, "rl", "SELECT * FROM rl", "duration_s")
add("s10_replace_slice", S.replaced_slice, "bt", "SELECT model_name, CASE model_name WHEN 'volume_forecast' THEN 'r2' ELSE 'r1' END AS run_id, count(*) AS n FROM bt GROUP BY 1, 2")
add("s12_dataset_snapshot", S.saved_dataset, "vt", "SELECT hour_utc, y, roll24 FROM vt", "y roll24")
CSV_TS = "strftime({c}, '%Y-%m-%dT%H:%M:%S') AS {c}"
add("q16_export_events", S.exported_events, "gxm pr", f"""
SELECT e.event_id, e.symbol, p.name, strftime(e.start_ts, '%Y-%m-%dT%H:%M:%S') AS start_ts, CAST(e.is_pump_dump AS VARCHAR) AS is_pump_dump,
  CAST(e.concurrent_symbols AS VARCHAR) AS concurrent_symbols, CAST(NULL AS VARCHAR) AS anomaly_score
FROM gxm e LEFT JOIN pr p ON p.symbol = e.symbol WHERE {E_DEF}""")
add("q16_export_prices", S.exported_prices, "dqm pr gxm", f"""
SELECT t.symbol, p.name, CAST(coalesce(ev.n, 0) AS VARCHAR) AS events_90d, CAST(p.rank_24h AS VARCHAR) AS rank_24h, strftime(p.listed_at, '%Y-%m-%dT%H:%M:%S') AS listed_at
FROM dqm t LEFT JOIN pr p ON p.symbol = t.symbol LEFT JOIN (SELECT symbol, count(*) AS n FROM gxm WHERE {STRONG} GROUP BY 1) ev ON ev.symbol = t.symbol""")
add("s13_export_coin", S.exported_coin, "hrm", f"SELECT strftime(t, '%Y-%m-%dT%H:%M:%S') AS t, close FROM ({bucket_sql('day', 90)})", "close")

# ------------------------------------------------------------------ streams
add("st1_stream_ingest", S.stream_ingest, "c3", "SELECT * FROM c3", F1)
add("st2_stream_dedupe", S.stream_dedupe, "d3", "SELECT * FROM d3", F1)
add("st3_stream_hourly", S.stream_hourly, "hr1", "SELECT * FROM hr1", HOURLY_D)
add("st4_stream_silver", S.stream_silver, "s1", "SELECT * FROM s1", SILVER_D)
add("st5_stream_sessions", S.stream_sessions, "ev1", """
SELECT symbol, start_ts, last_signal_ts, base_price, max_vol_x, max_chg_5m_pct, signal_minutes, active_share_1d FROM ev1""", "base_price max_vol_x max_chg_5m_pct active_share_1d")
add("st5_closed_sessions", S.stream_closed_sessions, "ev1 s1", """
SELECT symbol, start_ts, last_signal_ts, base_price, max_vol_x, max_chg_5m_pct, signal_minutes, active_share_1d FROM ev1
WHERE last_signal_ts + INTERVAL 30 MINUTE < (SELECT max(ts) FROM s1)""", "base_price max_vol_x max_chg_5m_pct active_share_1d")
add("st6_stream_triggers", S.stream_triggers, "trg1", "SELECT symbol, ts, chg_5m, vol_x_5m FROM trg1", "chg_5m vol_x_5m")
add("st6_stream_outcomes", S.stream_outcomes, "wn trgm", "SELECT wn.symbol, wn.ts, t.chg_5m, wn.vol_x_5m, wn.outcome FROM wn JOIN trgm t ON t.symbol = wn.symbol AND t.ts = wn.ts", "chg_5m vol_x_5m")
add("st7_stream_publish", S.stream_publish)
add("st7_version_publish", S.version_publish)

# ------------------------------------------------------------------ trained models (no SQL equivalent)
add("m3_boosted_regression", S.boosted_volume)
add("m4_recursive_forecast", S.recursive_paths)
add("m5_published_with_band", S.published_volatility)
add("m6_warning_classifier", S.warning_model)
add("m7_scored_warnings", S.scored_warnings)
add("m8_direction_experiment", S.direction_run)
add("m9_anomaly_scores", S.anomalies)
