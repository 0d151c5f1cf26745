"""Forecasts published when gold gets a new version, by the deployed champion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewick.config import DEFAULTS, Settings
from tidewick.functions.timefn import shift
from tidewick.learning import registry
from tidewick.learning.runs import publish_volume
from tidewick.sources.lake import LakeTables
from tidewick.streaming.jobs import each_batch


def versions(lake: LakeTables, table: str, per_batch: int = 16) -> DataFrame:
    """Pointers of a replaced table as they appear: (number, version), one short row a replacement."""
    spark = lake.spark
    lines = spark.readStream.option("maxFilesPerTrigger", per_batch).text(f"{lake.path(table)}_current")
    return lines.select(F.col("_metadata.file_name").cast("long").alias("number"), F.split("value", "\t")[0].alias("version"))


class PublishVersions:
    """foreachBatch action: publishes the volume forecast of every new version of ``market_hourly``, oldest first.

    The moment of a publication is the end of the version's last hour, not the clock's: a batch that is repeated, or a
    version that holds no newer hour, adds nothing to the history. Versions without rows, and those that come while no
    champion is deployed, publish nothing and aren't taken up again.
    """

    def __init__(self, lake: LakeTables, store: registry.ModelStore, settings: Settings = DEFAULTS):
        self.lake, self.store, self.settings = lake, store, settings

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        for _, version in sorted(map(tuple, batch.collect())):
            market = self.lake._version("market_hourly", version)
            as_of = market.agg(F.max(shift(F.col("hour_utc"), hours=1))).first()[0]
            if as_of is not None:
                publish_volume(self.lake, self.store, as_of, self.settings, market)


def on_versions(lake: LakeTables, store: registry.ModelStore, checkpoint: str, settings: Settings = DEFAULTS) -> StreamingQuery:
    return each_batch(versions(lake, "market_hourly"), PublishVersions(lake, store, settings), checkpoint)
