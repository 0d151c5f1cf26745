"""Silver to gold events: candidate signals, sessions, peak and aftermath, concurrency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.config import DEFAULTS, Settings
from tidewick.functions.numeric import ratio
from tidewick.functions.timefn import DAY, MINUTE, floor_div, from_micros, iso_weekday, local_hour, micros, minutes_elapsed
from tidewick.operators.blocks import BLOCK, in_block, owned, running_total, with_halo
from tidewick.operators.ranges import range_join

SIGNAL = ["symbol", "ts", "open_5m", "chg_5m", "vol_x_5m", "active_share_1d", "vol5_thb"]
EVENT = [
    "event_id", "symbol", "start_ts", "peak_ts", "last_signal_ts", "base_price", "peak_price", "pump_pct",
    "max_vol_x", "max_chg_5m_pct", "signal_minutes", "min_low_after", "dump_pct", "retrace_share",
    "minutes_to_peak", "minutes_to_half_retrace", "is_pump_dump", "active_share_1d", "vol_thb_event",
    "hour_local", "dow_local",
]
CONTEXT = ["open", "high", "low", "close", "vol_thb"]


def candidates(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return silver.where(
        (F.col("chg_5m") * 100 >= settings.candidate_pump_pct) & (F.col("vol_x_5m") >= settings.candidate_vol_x)
    ).select(*SIGNAL)


def _marked(rows: DataFrame, gap_us: int, block_us: int) -> DataFrame:
    """Flag rows with no earlier row of the symbol inside the gap (gap end included)."""
    laid = with_halo(rows.withColumn("_us", micros("ts")), "_us", block_us, back_us=gap_us)
    previous = F.lag("_us").over(in_block(["symbol"], "_us"))
    close_by = F.coalesce(F.col("_us") - previous <= gap_us, F.lit(False))
    return laid.withColumn("_opens", ~close_by).where(owned("_us", block_us)).drop(BLOCK)


def sessions(signals: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Number the runs of signals per symbol; a longer pause than the gap starts a new one."""
    block_us = settings.block_days * DAY
    marked = _marked(signals, settings.event_gap_min * MINUTE, block_us)
    marked = marked.withColumn("is_new", F.col("_opens").cast("long"))
    numbered = running_total(marked, ["symbol"], "_us", "is_new", "eid", floor_div(F.col("_us"), block_us))
    return numbered.drop("_us", "_opens")


def refractory_triggers(rows: DataFrame, quiet_min: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Keep a row only when the previous qualifying row is more than ``quiet_min`` older."""
    return _marked(rows, quiet_min * MINUTE, settings.block_days * DAY).where("_opens").drop("_opens", "_us")


def session_facts(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy("symbol", "eid").agg(
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("last_signal_ts"),
        F.min_by("open_5m", F.when(F.col("open_5m").isNotNull(), F.col("ts"))).alias("base_price"),
        F.max("vol_x_5m").alias("max_vol_x"),
        (F.max("chg_5m") * 100).alias("max_chg_5m_pct"),
        F.count("*").alias("signal_minutes"),
        F.min_by("active_share_1d", F.when(F.col("active_share_1d").isNotNull(), F.col("ts"))).alias("active_share_1d"),
    )


def _timed(silver: DataFrame, columns: list[str]) -> DataFrame:
    return silver.select("symbol", micros("ts").alias("_us"), *columns)


def event_peaks(facts: DataFrame, silver: DataFrame) -> DataFrame:
    """Highest high, its earliest minute and the traded value around each session."""
    spans = facts.select(
        "symbol", "eid",
        (micros("start_ts") - 5 * MINUTE).alias("_lo"), (micros("last_signal_ts") + 30 * MINUTE).alias("_hi"))
    met = range_join(spans, _timed(silver, ["high", "vol_thb"]), ["symbol"], "_lo", "_hi", "_us")
    top = F.max(F.struct("high", (-F.col("_us")).alias("_neg")))
    return met.groupBy("symbol", "eid").agg(top.alias("_top"), F.sum("vol_thb").alias("vol_thb_event")).select(
        "symbol", "eid", F.col("_top.high").alias("peak_price"),
        from_micros(-F.col("_top._neg")).alias("peak_ts"), "vol_thb_event")


def _half_way(base: Column, peak: Column) -> Column:
    return base + F.lit(0.5) * (peak - base)


def event_aftermath(peaks: DataFrame, silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Lowest low and first half-retrace after the peak; no candle leaves both NULL.

    ``peaks`` carries symbol, eid, base_price, peak_price and peak_ts.
    """
    spans = peaks.select(
        "symbol", "eid", "base_price", "peak_price",
        (micros("peak_ts") + 1).alias("_lo"), (micros("peak_ts") + settings.dump_window_min * MINUTE).alias("_hi"))
    met = range_join(spans, _timed(silver, ["low", "close"]), ["symbol"], "_lo", "_hi", "_us")
    back = F.col("close") <= _half_way(F.col("base_price"), F.col("peak_price"))
    found = met.groupBy("symbol", "eid").agg(
        F.min("low").alias("min_low_after"), from_micros(F.min(F.when(back, F.col("_us")))).alias("half_retrace_ts"))
    return peaks.select("symbol", "eid").join(found, ["symbol", "eid"], "left")


def event_paths(facts: DataFrame, silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Peak and aftermath of every session from a single pass over silver.

    The joined span covers both searches, because the peak lies at most 30 minutes past
    the last signal. Everything after the join runs on one shuffle by session.
    """
    reach = settings.dump_window_min * MINUTE
    spans = facts.withColumn("_lo", micros("start_ts") - 5 * MINUTE).withColumn(
        "_peak_hi", micros("last_signal_ts") + 30 * MINUTE).withColumn("_hi", F.col("_peak_hi") + reach)
    points = _timed(silver, ["high", "low", "close", "vol_thb"])
    met = range_join(spans, points, ["symbol"], "_lo", "_hi", "_us")
    near = F.col("_us") <= F.col("_peak_hi")
    whole = Window.partitionBy("symbol", "eid")
    met = met.withColumn("_top", F.max(F.when(near, F.struct("high", (-F.col("_us")).alias("_neg")))).over(whole))
    peak_us = -F.col("_top._neg")
    after = (F.col("_us") > peak_us) & (F.col("_us") <= peak_us + reach)
    back = after & (F.col("close") <= _half_way(F.col("base_price"), F.col("_top.high")))
    return met.groupBy(*facts.columns, F.col("_top.high").alias("peak_price"), peak_us.alias("_peak_us")).agg(
        F.sum(F.when(near, F.col("vol_thb"))).alias("vol_thb_event"),
        F.min(F.when(after, F.col("low"))).alias("min_low_after"),
        from_micros(F.min(F.when(back, F.col("_us")))).alias("half_retrace_ts"),
    ).withColumn("peak_ts", from_micros(F.col("_peak_us"))).drop("_peak_us")


def measured(paths: DataFrame) -> DataFrame:
    """Final measures of a session; sessions without a positive base price are dropped."""
    base, peak, low = F.col("base_price"), F.col("peak_price"), F.col("min_low_after")
    return paths.where(base > 0).select(
        F.concat("symbol", F.lit("-"), F.date_format("start_ts", "yyyyMMddHHmm")).alias("event_id"),
        "symbol", "start_ts", "peak_ts", "last_signal_ts", "base_price", "peak_price",
        ((ratio(peak, base) - 1) * 100).alias("pump_pct"),
        "max_vol_x", "max_chg_5m_pct", "signal_minutes", "min_low_after",
        ((ratio(low, peak) - 1) * 100).alias("dump_pct"),
        ratio(peak - low, peak - base).alias("retrace_share"),
        minutes_elapsed(F.col("start_ts"), F.col("peak_ts")).alias("minutes_to_peak"),
        minutes_elapsed(F.col("peak_ts"), F.col("half_retrace_ts")).alias("minutes_to_half_retrace"),
        F.col("half_retrace_ts").isNotNull().alias("is_pump_dump"),
        "active_share_1d", "vol_thb_event",
        local_hour("start_ts").alias("hour_local"), iso_weekday("start_ts").alias("dow_local"),
    )


def with_concurrency(events: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Count the other symbols with an event starting within the window on either side.

    No pairs are formed. A symbol is present from ``reach`` before to ``reach`` after each
    of its events; overlapping presences are merged by emitting +1 only where none began
    just before and -1 only where none follows. The running total over instants is then
    the number of distinct symbols present, the event's own one included.
    """
    reach = settings.concurrent_min * MINUTE
    block_us = settings.block_days * DAY
    timed = events.withColumn("_us", micros("start_ts"))
    laid = with_halo(timed.select("symbol", "_us"), "_us", block_us, back_us=2 * reach, ahead_us=2 * reach)
    w = in_block(["symbol"], "_us")
    opens = F.coalesce(F.col("_us") - F.lag("_us").over(w) > 2 * reach, F.lit(True))
    closes = F.coalesce(F.lead("_us").over(w) - F.col("_us") > 2 * reach, F.lit(True))
    marks = laid.withColumn("_opens", opens).withColumn("_closes", closes).where(owned("_us", block_us))
    steps = marks.select(F.explode(F.array_compact(F.array(
        F.struct(F.col("_us").alias("at"), F.lit(0).alias("step"), F.lit(1).alias("asked")),
        F.when(F.col("_opens"), F.struct((F.col("_us") - reach).alias("at"), F.lit(1).alias("step"), F.lit(0).alias("asked"))),
        F.when(F.col("_closes"), F.struct((F.col("_us") + reach + 1).alias("at"), F.lit(-1).alias("step"), F.lit(0).alias("asked"))),
    ))).alias("m")).select("m.*")
    instants = steps.groupBy("at").agg(F.sum("step").alias("step"), F.max("asked").alias("asked"))
    active = running_total(instants, [], "at", "step", "_active", floor_div(F.col("at"), DAY))
    active = active.where("asked = 1").select(F.col("at").alias("_us"), (F.col("_active") - 1).cast("int").alias("concurrent_symbols"))
    return timed.join(active, "_us").drop("_us")


def carry_scores(events: DataFrame, scored: DataFrame | None) -> DataFrame:
    """Attach scores of an earlier snapshot by event_id; unknown events stay NULL."""
    if scored is None:
        return events.withColumn("anomaly_score", F.lit(None).cast("double"))
    kept = scored.where(F.col("anomaly_score").isNotNull()).select("event_id", "anomaly_score")
    return events.drop("anomaly_score").join(kept, "event_id", "left")


def event_candles(events: DataFrame, silver: DataFrame) -> DataFrame:
    """Candles from an hour before the start to 90 minutes past the peak, per event."""
    spans = events.select(
        "event_id", "symbol",
        (micros("start_ts") - 60 * MINUTE).alias("_lo"), (micros("peak_ts") + 90 * MINUTE).alias("_hi"))
    met = range_join(spans, silver.select("symbol", "ts", micros("ts").alias("_us"), *CONTEXT), ["symbol"], "_lo", "_hi", "_us")
    return met.select("event_id", "ts", *CONTEXT)
