"""Sessions of candidate signals that are appended once they are closed.

Two queries in a row. The first keeps candidates only, sets rows aside that come after the watermark has passed them, and
adds one tick a batch, so time goes on without candidates. The second groups by ``session_window`` and appends a session
when the watermark has passed its gap. Both read batches in the same order and the second's watermark is never ahead of the
first one's, so it drops nothing; every late signal is in the folder of late rows. (Order is that of the files' modification times, which a batch's own run time keeps
apart.) ``current`` puts sessions of symbols with
late signals together anew, from the candidates, which are few among all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewick.config import DEFAULTS, Settings
from tidewick.functions.timefn import MINUTE, micros
from tidewick.operators import events
from tidewick.sources.lake import LakeTables
from tidewick.streaming.jobs import each_batch, to_table

SIGNAL = "symbol string, ts timestamp_ntz, open_5m double, chg_5m double, vol_x_5m double, active_share_1d double"
KEPT = f"{SIGNAL}, tick boolean"
FACTS = ("symbol string, start_ts timestamp_ntz, last_signal_ts timestamp_ntz, base_price double, max_vol_x double, max_chg_5m_pct double, "
         "signal_minutes bigint, active_share_1d double")
COLUMNS = [f.split()[0] for f in FACTS.split(", ")]


class ClosingSessions:
    """``run`` takes what has landed; ``current`` gives the closed sessions, ``late`` the signals that came too late.

    Silver rows hold a minute once. Rows without symbol or time are left out. Every write is keyed by its batch, so a
    repeated batch overwrites itself.
    """

    def __init__(self, lake: LakeTables, name: str = "closing", delay_min: int = 0, settings: Settings = DEFAULTS):
        self.lake, self.delay_min, self.settings = lake, delay_min, settings
        self.signals, self.set_aside, self.ends, self.closed = (lake.path(f"{name}_{kind}") for kind in ("signals", "late", "ends", "closed"))
        self.marks = lake.path(f"{name}_marks")

    def run(self, stream: DataFrame) -> None:
        each_batch(stream, self._sort_out, f"{self.marks}/in").awaitTermination()
        if self.lake.exists(self.signals):
            self._close().awaitTermination()

    def _ends(self) -> DataFrame:
        return self.lake.spark.read.schema("us bigint, b bigint").parquet(self.ends)

    def _watermark(self, before: int | None = None) -> int | None:
        """Microseconds that have been passed when batch ``before`` is read; of all batches by default."""
        if not self.lake.exists(self.ends):
            return None
        seen = self._ends() if before is None else self._ends().where(F.col("b") < before)
        newest = seen.agg(F.max("us")).first()[0]
        # whole milliseconds, as the second query's watermark
        return None if newest is None else newest // 1000 * 1000 - self.delay_min * MINUTE

    def _sort_out(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.where("symbol IS NOT NULL AND ts IS NOT NULL")
        passed = self._watermark(batch_id)
        end = rows.agg(F.max("ts").alias("ts")).where("ts IS NOT NULL")
        end.select(micros("ts").alias("us")).write.mode("overwrite").parquet(f"{self.ends}/b={batch_id}")
        names = [f.split()[0] for f in SIGNAL.split(", ")]
        found = events.candidates(rows, self.settings).select(*names)
        late = micros("ts") <= passed if passed is not None else F.lit(False)
        found.where(late).write.mode("overwrite").parquet(f"{self.set_aside}/b={batch_id}")
        tick = end.select("ts", F.lit(True).alias("tick"))
        kept = found.where(~late).withColumn("tick", F.lit(False)).unionByName(tick, allowMissingColumns=True)
        # one file a batch: the second query takes whole batches in their order
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.signals}/b={batch_id}")

    def _close(self) -> StreamingQuery:
        gap = self.settings.event_gap_min
        rows = self.lake.spark.readStream.schema(KEPT).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(self.signals)
        timed = rows.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", f"{self.delay_min} minutes")
        # a signal at the very end of the gap still belongs to the session
        span = F.session_window("event_time", f"{gap} minutes 1 microsecond")
        first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ts")))
        facts = timed.groupBy("symbol", "tick", span).agg(
            F.min("ts").alias("start_ts"), F.max("ts").alias("last_signal_ts"), first("open_5m").alias("base_price"),
            F.max("vol_x_5m").alias("max_vol_x"), (F.max("chg_5m") * 100).alias("max_chg_5m_pct"),
            F.count_if(~F.col("tick")).alias("signal_minutes"), first("active_share_1d").alias("active_share_1d"))
        # ticks are told by the count: a filter on the key would move below the watermark
        return to_table(facts.where("signal_minutes > 0").select(*COLUMNS), self.closed, f"{self.marks}/out")

    def _stored(self, folder: str, schema: str) -> DataFrame:
        spark = self.lake.spark
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder) if self.lake.exists(folder) else spark.createDataFrame([], schema)

    def late(self) -> DataFrame:
        return self._stored(self.set_aside, SIGNAL)

    def current(self) -> DataFrame:
        spark = self.lake.spark
        closed = spark.read.schema(FACTS).parquet(self.closed) if self.lake.exists(self.closed) else spark.createDataFrame([], FACTS)
        passed = self._watermark()
        if passed is None:
            return closed
        mended = self.late().select("symbol").distinct()
        signals = self._stored(self.signals, KEPT).where("NOT tick").drop("tick").unionByName(self.late())
        again = events.session_facts(events.sessions(signals.join(mended, "symbol", "left_semi"), self.settings))
        over = again.where(micros("last_signal_ts") + self.settings.event_gap_min * MINUTE < passed).select(*COLUMNS)
        return closed.join(mended, "symbol", "left_anti").unionByName(over)
