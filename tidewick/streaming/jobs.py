"""The pipelines as Structured Streaming jobs over landed files.

Each function returns a streaming DataFrame or starts a query with
``trigger(availableNow=True)``: it takes what has arrived, then stops, and the checkpoint
remembers what was taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tidewick.config import DEFAULTS, Settings
from tidewick.functions.timefn import shift
from tidewick.learning import forecast, registry
from tidewick.learning.runs import republish
from tidewick.operators import candles, events, rollups, stats
from tidewick.schemas import SCHEMAS
from tidewick.sources.lake import LakeTables


def landed(spark: SparkSession, path: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """Files of a table as they arrive."""
    reader = spark.readStream.schema(SCHEMAS[table])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def to_table(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Append a stream to a folder that only this query writes; exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start()


def each_batch(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# ---- ingest and dedupe
def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Landed pulls to bronze; the checkpoint replaces the per-symbol high-water mark."""
    return to_table(stream, path, checkpoint, partition_by=["symbol"])


class Recompute:
    """foreachBatch action: recomputes the blocks that a batch can change, from everything that has arrived for them.

    A block is a symbol's day, or the whole symbol. No watermark decides what is too late: pulls land symbol by symbol
    and out of order, and each one reopens its own blocks. Every write is keyed by batch id, so a repeated batch
    overwrites itself; ``current`` takes each block from the newest batch that touched it.

    ``step`` maps rows to results and ``at`` names the results' time; ``reach`` is how many minutes later a row can
    still change a result. Of rows that land twice the newest counts, unless ``step`` chooses itself.
    """

    def __init__(self, lake: LakeTables, name: str, step: Callable[[DataFrame], DataFrame], at: str, reach: int = 0, by_day: bool = True, newest: bool = True):
        self.lake, self.step, self.at, self.reach, self.by_day, self.newest = lake, step, at, reach, by_day, newest
        self.rows, self.blocks, self.results = (lake.path(f"{name}_{kind}") for kind in ("rows", "blocks", "results"))

    def _block(self, ts: Column) -> Column:
        return F.to_date(ts) if self.by_day else F.lit("1970-01-01").cast("date")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark, columns = batch.sparkSession, batch.columns
        batch.withColumn("block", self._block(F.col("ts"))).write.mode("overwrite").partitionBy("block").parquet(f"{self.rows}/batch={batch_id}")
        layout = StructType([*batch.schema.fields, StructField("block", DateType()), StructField("batch", LongType())])
        history = spark.read.schema(layout).parquet(self.rows)
        arrived = history.where(F.col("batch") == batch_id)
        reached = F.array_distinct(F.array(self._block(F.col("ts")), self._block(shift(F.col("ts"), minutes=self.reach))))
        arrived.select("symbol", F.explode(reached).alias("block")).distinct().write.mode("overwrite").parquet(f"{self.blocks}/b={batch_id}")
        touched = spark.read.parquet(f"{self.blocks}/b={batch_id}")
        halo = F.array_distinct(F.array(F.col("block"), F.date_sub("block", 1 if self.reach else 0)))
        needed = touched.select("symbol", F.explode(halo).alias("block")).distinct()
        rows = history.join(needed, ["symbol", "block"], "left_semi")
        if self.newest:
            rest = [c for c in columns if c not in ("symbol", "ts")]
            rows = rows.groupBy("symbol", "ts").agg(F.max(F.struct("batch", *rest)).alias("v")).select("symbol", "ts", *[f"v.{c}" for c in rest])
        made = self.step(rows.select(*columns)).withColumn("block", self._block(F.col(self.at)))
        made.join(touched, ["symbol", "block"], "left_semi").withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.results}/b={batch_id}")

    def current(self) -> DataFrame:
        read = self.lake.spark.read.option("recursiveFileLookup", True)
        last = self.lake.spark.read.parquet(self.blocks).groupBy("symbol", "block").agg(F.max("b").cast("long").alias("batch"))
        return read.parquet(self.results).join(last, ["symbol", "block", "batch"], "left_semi").drop("block", "batch")


# ---- dedupe, rollups, sessions and triggers
def latest_candles(lake: LakeTables) -> Recompute:
    """Latest pull per (symbol, minute), whatever the order in which pulls land."""
    return Recompute(lake, "stream_latest", candles.latest_candles, "ts", newest=False)


def hourly(lake: LakeTables) -> Recompute:
    """Hourly candles and volatility; a late minute recomputes its day's hours."""
    return Recompute(lake, "stream_hourly", rollups.symbol_hourly, "hour_utc")


def refractory_triggers(lake: LakeTables, quiet_min: int = 30, settings: Settings = DEFAULTS) -> Recompute:
    """First signals after a quiet period. A late signal also takes back a trigger that follows it too soon."""

    def step(rows: DataFrame) -> DataFrame:
        return events.refractory_triggers(_early(rows, settings).select("symbol", "ts", "chg_5m", "vol_x_5m"), quiet_min, settings)

    return Recompute(lake, "stream_triggers", step, "ts", reach=quiet_min)


def _early(rows: DataFrame, settings: Settings) -> DataFrame:
    return rows.where((F.col("chg_5m") >= settings.early_chg) & (F.col("vol_x_5m") >= settings.early_vol_x))


def pump_sessions(lake: LakeTables, settings: Settings = DEFAULTS) -> Recompute:
    """Sessions of candidate signals. A session may span days and a late signal may join two, so the signals of the
    symbols that a batch touches, which are few among all rows, are numbered anew."""

    def step(rows: DataFrame) -> DataFrame:
        facts = events.session_facts(events.sessions(events.candidates(rows, settings), settings))
        return facts.select("symbol", "start_ts", "last_signal_ts", "base_price", "max_vol_x", "max_chg_5m_pct", "signal_minutes", "active_share_1d")

    return Recompute(lake, "stream_sessions", step, "start_ts", by_day=False)


# ---- incremental silver
class TailRefresh:
    """foreachBatch action that recomputes only the part of silver a batch can change.

    New candles change features from an hour before them (look-ahead labels) onward, and
    those features look back seven days. Older history enters through the block summaries,
    a few rows per symbol and pull. Every write is keyed by batch id, so a retry overwrites
    its own output.
    """

    def __init__(self, lake: LakeTables, settings: Settings = DEFAULTS):
        self.lake, self.settings = lake, settings
        self.bronze = lake.path("stream_bronze")
        self.summaries = lake.path("stream_summary")
        self.silver = lake.path("stream_silver")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        day = F.to_date("ts").alias("day")
        batch.select("*", day).write.mode("overwrite").partitionBy("day").parquet(f"{self.bronze}/batch={batch_id}")
        layout = StructType([*batch.schema.fields, StructField("day", DateType()), StructField("batch", LongType())])
        history = spark.read.schema(layout).parquet(self.bronze)
        arrived = history.where(F.col("batch") == batch_id).select(*batch.columns)
        summary = candles.block_summary(arrived, self.settings, version="ingested_at")
        summary.write.mode("overwrite").parquet(f"{self.summaries}/batch={batch_id}")

        touched = arrived.groupBy("symbol").agg(shift(F.min("ts"), minutes=-60).alias("_from"))
        # days older than this matter to no symbol of the batch and are not read
        oldest = shift(touched.agg(F.min("_from")).scalar(), days=-7, minutes=-5)
        recent = history.where((F.col("day") >= F.to_date(oldest)) & (F.col("ts") >= oldest)).select(*batch.columns)
        tail = recent.join(touched, "symbol").where(F.col("ts") >= shift(F.col("_from"), days=-7, minutes=-5)).drop("_from")
        known = spark.read.schema(summary.schema).option("recursiveFileLookup", True).parquet(self.summaries)
        features = candles.minute_features(candles.latest_candles(tail), self.settings, known)
        changed = features.join(touched, "symbol").where(F.col("ts") >= F.col("_from")).drop("_from")
        changed.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.silver}/b={batch_id}")

    def current(self) -> DataFrame:
        """Silver as of the last batch: the newest computed row per (symbol, minute)."""
        spark = self.lake.spark
        rows = spark.read.option("recursiveFileLookup", True).parquet(self.silver)
        rest = [c for c in rows.columns if c not in ("symbol", "ts", "batch")]
        newest = rows.groupBy("symbol", "ts").agg(F.max_by(F.struct(*rest), "batch").alias("r"))
        return newest.select("symbol", "ts", "r.*")


def silver_tail(stream: DataFrame, refresh: TailRefresh, checkpoint: str) -> StreamingQuery:
    return each_batch(stream, refresh, checkpoint)


# ---- forecasts after each gold refresh
class PublishVolume:
    """foreachBatch action: new market hours arrive, the deployed model publishes again."""

    def __init__(self, lake: LakeTables, store: registry.ModelStore, settings: Settings = DEFAULTS):
        self.lake, self.store, self.settings = lake, store, settings

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        model = self.store.load("volume_forecast")
        if model is None or batch.isEmpty():
            return
        as_of = batch.agg(F.max(shift(F.col("hour_utc"), hours=1))).first()[0]
        market = self.lake.read("market_hourly")
        frame = forecast.volume_frame(market, as_of)
        cut = stats.split_cut(forecast.training_rows(frame), "hour_utc", self.settings.test_share).scalar()
        rows = forecast.publish(frame, model, cut, "volume_forecast", as_of, self.settings)
        republish(self.lake, "volume_forecast", rows)


__all__ = [
    "landed", "ingest", "Recompute", "latest_candles", "hourly", "pump_sessions", "refractory_triggers", "TailRefresh", "silver_tail",
    "PublishVolume", "to_table", "each_batch",
]
