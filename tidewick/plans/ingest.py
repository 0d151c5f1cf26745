"""Ingest decisions: which symbols, which ranges, and keyed state updates."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.config import DEFAULTS, QUOTE_SUFFIX, STABLECOINS, Settings
from tidewick.session import written
from tidewick.sources.keyed import KeyedTable
from tidewick.sources.lake import LakeTables
from tidewick.sources.payloads import candles_from_payload, ticker_from_payload

DAY_S = 86_400


def tradable(ticker: DataFrame) -> DataFrame:
    """Quoted in the home currency, base not a stablecoin, traded in the last 24 hours."""
    base = F.split("symbol", "_")[0]
    return ticker.where(
        F.col("symbol").endswith(QUOTE_SUFFIX) & ~base.isin(*STABLECOINS) & (F.col("volume_thb_24h") > 0))


def ranked(ticker: DataFrame, top_n: int = DEFAULTS.top_n) -> DataFrame:
    """The universe with rank 1..N by 24h volume; the rest have no rank."""
    universe = tradable(ticker).select("symbol", "volume_thb_24h")
    best = universe.orderBy(F.desc("volume_thb_24h"), "symbol").limit(top_n)
    order = Window.orderBy(F.desc("volume_thb_24h"), "symbol")  # over at most top_n rows
    ranks = best.select("symbol", F.row_number().over(order).alias("rank_24h"))
    return universe.join(ranks, "symbol", "left").withColumn("selected", F.col("rank_24h").isNotNull())


def refresh_pairs(
    pairs: DataFrame, ticker: DataFrame, listing: DataFrame, state: DataFrame, now: Column,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """New contents of ``pairs``: ranks are reset, universe rows replace, tracked ones stay selected."""
    fresh = ranked(ticker, settings.top_n).join(listing.select("symbol", "name", "listed_at"), "symbol", "left")
    merged = upsert(
        pairs.withColumn("rank_24h", F.lit(None).cast("int")).withColumn("selected", F.lit(False)),
        fresh.withColumn("updated_at", now), ["symbol"], replace=[
            "name", "listed_at", "volume_thb_24h", "rank_24h", "selected", "updated_at"])
    return keep_tracked(merged, state)


def keep_tracked(pairs: DataFrame, state: DataFrame) -> DataFrame:
    """A symbol that was ever ingested stays selected."""
    tracked = state.select("symbol").distinct().withColumn("_tracked", F.lit(True))
    return pairs.join(tracked, "symbol", "left").withColumn(
        "selected", F.col("selected") | F.coalesce(F.col("_tracked"), F.lit(False))).drop("_tracked")


def tracked_pairs(pairs: DataFrame, state: DataFrame) -> DataFrame:
    return pairs.join(state.select("symbol"), "symbol", "left_semi")


def upsert(
    old: DataFrame, new: DataFrame, keys: list[str], replace: list[str] = (), add: list[str] = ()
) -> DataFrame:
    """Keyed merge: ``replace`` columns take the new row's value, ``add`` columns accumulate.

    The result is a new frame; write it to a new version, never over the path being read.
    """
    o = old.select(*keys, F.struct(*replace, *add).alias("_old"))
    n = new.select(*keys, F.struct(*replace, *add).alias("_new"))
    both = o.join(n, keys, "full_outer")
    arrived = F.col("_new").isNotNull()
    columns = [F.when(arrived, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in replace]
    columns += [(F.coalesce(F.col(f"_old.{c}"), F.lit(0)) + F.coalesce(F.col(f"_new.{c}"), F.lit(0))).alias(c) for c in add]
    return both.select(*keys, *columns)


def pull_state(pull: DataFrame, run_at: Column) -> DataFrame:
    """What one run adds to ``ingest_state``: newest candle second, rows, one file per symbol."""
    return pull.groupBy("symbol").agg(
        F.max(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("last_ts"),
        F.count("*").alias("rows_total"), F.lit(1).alias("files"), F.first(run_at).alias("updated_at"))


def advance_state(state: DataFrame, pull: DataFrame, run_at: Column) -> DataFrame:
    return upsert(state, pull_state(pull, run_at), ["symbol"], replace=["last_ts", "updated_at"], add=["rows_total", "files"])


def merge_state(state: KeyedTable, pull: DataFrame, run_at: Column) -> list[int]:
    """``advance_state`` on a table in buckets: those of symbols that gave no candles are neither read nor written."""
    arrived = written(pull_state(pull, run_at), "arrived")
    return state.merge(arrived, lambda old, new: upsert(old, new, ["symbol"], replace=["last_ts", "updated_at"], add=["rows_total", "files"]))


def pull_ranges(pairs: DataFrame, state: DataFrame, now: dt.datetime, settings: Settings = DEFAULTS) -> DataFrame:
    """Ranges to pull per selected symbol, from its last candle (again) to now, in chunks."""
    now_s = int(now.replace(tzinfo=dt.timezone.utc).timestamp())
    start = F.coalesce(F.col("last_ts"), F.lit(now_s - settings.backfill_days * DAY_S))
    planned = pairs.where("selected").select("symbol").join(state.select("symbol", "last_ts"), "symbol", "left")
    steps = planned.withColumn("is_backfill", F.col("last_ts").isNull()).withColumn("_from", start).where(F.col("_from") < now_s)
    chunk = settings.chunk_days * DAY_S
    starts = F.explode(F.sequence(F.col("_from"), F.lit(now_s - 1).cast("long"), F.lit(chunk).cast("long")))
    return steps.select("symbol", "is_backfill", starts.alias("from_s")).withColumn(
        "to_s", F.least(F.col("from_s") + chunk, F.lit(now_s).cast("long")))


def run_log(pull: DataFrame, ranges: DataFrame, run_id: str, run_at: Column, duration_ms: int) -> DataFrame:
    """Rows for ``ingest_log``: first and last candle, calls and row count per symbol that gave candles. The symbols of a run
    are pulled side by side, so each row carries the whole pull's milliseconds."""
    calls = ranges.groupBy("symbol").agg(F.count("*").cast("int").alias("api_calls"), F.bool_and("is_backfill").alias("is_backfill"))
    got = pull.groupBy("symbol").agg(F.min("ts").alias("from_ts"), F.max("ts").alias("to_ts"), F.count("*").alias("rows"))
    return got.join(calls, "symbol").select(
        run_at.alias("run_at"), "symbol", "from_ts", "to_ts", "api_calls", "rows", F.lit(duration_ms).alias("duration_ms"),
        F.concat(F.lit(f"bronze_candles_runs/run_id={run_id}/symbol="), "symbol").alias("object_key"), "is_backfill")


def run(
    lake: LakeTables, run_id: str, now: dt.datetime, ticker_bodies: DataFrame, listing: DataFrame,
    fetch: Callable[[DataFrame], DataFrame], settings: Settings = DEFAULTS,
) -> bool:
    """One ingest run: ticker, universe, ranges, pull, then bronze, ticker history, log and state in one commit.

    ``fetch`` maps ranges (symbol, is_backfill, from_s, to_s) to landed bodies (symbol, body). A run that is repeated after
    its commit changes nothing and returns False; one that was cut off before it is done anew over what it left. Symbols
    without new candles get neither a log row nor a change of state.
    """
    if run_id in lake.committed_runs():
        return False
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    snapshot = written(ticker_from_payload(ticker_bodies, moment), "ticker")
    state = lake.read("ingest_state")
    lake.replace("market_ticker", snapshot)
    lake.update("pairs", lambda pairs: refresh_pairs(pairs, snapshot, listing, state, moment, settings))
    ranges = written(pull_ranges(lake.read("pairs"), state, now, settings), "ranges")
    began = time.monotonic()
    pull = written(candles_from_payload(fetch(ranges)).withColumn("ingested_at", moment), "pull")
    spent = int((time.monotonic() - began) * 1000)
    return lake.commit_run(run_id, {
        "bronze_candles": pull,
        "bronze_ticker": snapshot.withColumn("dt", F.lit(now.date())),
        "ingest_log": run_log(pull, ranges, run_id, moment, spent),
    }, lambda old: advance_state(old, pull, moment))
