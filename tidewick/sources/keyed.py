"""Keyed tables in hash buckets: a merge reads and rewrites only the buckets that rows arrive for.

Layout under a lake root: ``<table>_buckets/v=<id>/bucket=<n>/`` with the rows that version ``id`` wrote, and
``<table>_manifests/v=<id>`` with one line a bucket: the version that holds it. Pointers (``<table>_keyed_current``) work as
those of replaced tables, so a version becomes visible at once, and of two writers the second merges again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidewick.schemas import SCHEMAS
from tidewick.sources.lake import ATTEMPTS, LakeTables

BUCKETS = 64


class KeyedTable:
    """A lake table that is merged by ``keys``. The number of buckets is set when the table is first written and stays:
    choose it so that a bucket fits a task. Null keys share a bucket; whether they
    match is up to the step (``ingest.upsert`` keeps each as a row of its own)."""

    def __init__(self, lake: LakeTables, table: str, keys: list[str], buckets: int = BUCKETS):
        self.lake, self.table, self.keys, self.buckets = lake, table, keys, buckets
        self.pointers = f"{table}_keyed"
        self.rows, self.manifests = lake.path(f"{table}_buckets"), lake.path(f"{table}_manifests")

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def _manifest(self, version: str | None) -> dict[int, str]:
        """Version that holds each written bucket; as many entries as buckets at most."""
        if version is None:
            return {}
        lines = self.lake.spark.read.text(f"{self.manifests}/v={version}").collect()
        return {int(bucket): held for bucket, held in (line[0].split("\t") for line in lines)}

    def _folders(self, held: dict[int, str]) -> DataFrame:
        """Rows of the given buckets; no others are opened or listed."""
        if not held:
            return self.lake.empty(self.table)
        paths = [f"{self.rows}/v={version}/bucket={bucket}" for bucket, version in sorted(held.items())]
        return self.lake.spark.read.schema(SCHEMAS[self.table]).parquet(*paths)

    def read(self) -> DataFrame:
        return self._folders(self._manifest(self.lake.current(self.pointers)[1]))

    def merge(self, arrivals: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace touched buckets by ``step(their rows, arrivals)``; returns their numbers, none for no arrivals.

        ``step`` must keep rows in the bucket of their key, as a keyed merge does. ``arrivals`` is read more than once:
        pass stored rows.
        """
        touched = sorted(r[0] for r in arrivals.select(self._bucket()).distinct().collect())
        if not touched:
            return []
        for _ in range(ATTEMPTS):
            seq, base = self.lake.current(self.pointers)
            held = self._manifest(base)
            if base and int(base.split("-")[0]) != self.buckets:
                raise ValueError(f"{self.table} has {base.split('-')[0]} buckets, not {self.buckets}")
            version = f"{self.buckets}-{uuid.uuid4().hex}"
            merged = step(self._folders({b: held[b] for b in touched if b in held}), arrivals)
            merged.withColumn("bucket", self._bucket()).write.option("compression", "zstd").partitionBy("bucket").parquet(f"{self.rows}/v={version}")
            made = {b: version for b in touched if self.lake.exists(f"{self.rows}/v={version}/bucket={b}")}
            lines = [f"{b}\t{v}" for b, v in sorted(({b: v for b, v in held.items() if b not in touched} | made).items())]
            self.lake.spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{self.manifests}/v={version}")
            if self.lake._point(self.pointers, seq + 1, version):
                return touched
        raise RuntimeError(f"{self.table}: other writers were faster {ATTEMPTS} times")
