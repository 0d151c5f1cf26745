"""Landed API payloads to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CANDLE_BODY = (
    "s string, t array<bigint>, o array<double>, h array<double>, l array<double>, c array<double>, v array<double>"
)
TICKER_BODY = (
    "array<struct<symbol:string, last:string, percent_change:string, high_24_hr:string, low_24_hr:string, quote_volume:string>>"
)


def candles_from_payload(payloads: DataFrame) -> DataFrame:
    """(symbol, body) to one row per candle; a body that is not ok or is empty gives none."""
    parsed = payloads.select("symbol", F.from_json("body", CANDLE_BODY).alias("p")).where("p.s = 'ok'")
    zipped = F.arrays_zip(*[F.col(f"p.{k}").alias(k) for k in "tohlcv"])
    rows = parsed.select("symbol", F.inline(zipped))
    return rows.select(
        "symbol", F.timestamp_seconds("t").cast("timestamp_ntz").alias("ts"),
        *[F.col(k).alias(name) for k, name in zip("ohlcv", ["open", "high", "low", "close", "volume"])])


def ticker_from_payload(payloads: DataFrame, snapshot_at: Column) -> DataFrame:
    """(body) to one row per listed symbol; an absent or unreadable number becomes 0."""
    def number(field: str) -> Column:
        return F.coalesce(F.col(f"t.{field}").try_cast("double"), F.lit(0.0))

    rows = payloads.select(F.explode(F.from_json("body", TICKER_BODY)).alias("t"))
    return rows.select(
        F.col("t.symbol").alias("symbol"), number("last").alias("last"),
        number("percent_change").alias("percent_change"), number("high_24_hr").alias("high_24h"),
        number("low_24_hr").alias("low_24h"), number("quote_volume").alias("volume_thb_24h"),
        snapshot_at.alias("snapshot_at"))
