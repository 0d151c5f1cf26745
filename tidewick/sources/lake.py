"""Lake tables as Parquet folders: appends, slice overwrites and versioned snapshots.

Layout under a root: ``<table>/`` for appended and slice-replaced tables, ``<table>_runs/run_id=<id>/`` for rows that
belong to a run, and ``<table>_versions/v=<id>/`` plus ``<table>_current/<number>`` (pointers; the highest number counts) for
replaced snapshots. A pointer names a version and, tab-separated, the run that it commits, if any.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidewick.schemas import PARTITIONS, SCHEMAS

# The table whose pointers commit runs: what a run appended elsewhere is read once a pointer of this table names the run.
COMMITS = "ingest_state"
ATTEMPTS = 10


class LakeTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- reading
    def _hadoop(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        """True when the folder holds at least one data file."""
        hadoop, fs = self._hadoop(f"{path}/*")
        found = fs.globStatus(hadoop)
        return found is not None and len(found) > 0

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def landed(self, table: str) -> bool:
        """True when rows were appended, by a run or without one."""
        return self.exists(self.path(table)) or self.exists(f"{self.path(table)}_runs")

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], SCHEMAS[table])

    def read(self, table: str) -> DataFrame:
        """The table with its declared schema, or no rows when nothing was written yet."""
        seq, version = self.current(table)
        if seq >= 0:
            return self._version(table, version)
        found = []
        if self.exists(self.path(table)):
            found.append(self.spark.read.schema(SCHEMAS[table]).parquet(self.path(table)))
        runs = self.committed_runs() if self.exists(f"{self.path(table)}_runs") else []
        if runs:
            rows = self.spark.read.schema(f"{SCHEMAS[table]}, run_id string").parquet(f"{self.path(table)}_runs")
            found.append(rows.where(F.col("run_id").isin(runs)).drop("run_id"))
        if not found:
            return self.empty(table)
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def read_slice(self, table: str, key: str, value: str, *conditions: Column) -> DataFrame:
        """Rows of one partition: other folders aren't listed as input, and row groups that the conditions rule out aren't
        decoded. A value that was never written gives no rows."""
        rows = self.read(table).where(F.col(key) == value)
        for condition in conditions:
            rows = rows.where(condition)
        return rows

    def _version(self, table: str, version: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.path(table)}_versions/v={version}")

    def current(self, table: str) -> tuple[int, str | None]:
        """Number and version of the newest pointer; -1 when the table was never replaced."""
        hadoop, fs = self._hadoop(f"{self.path(table)}_current/*")
        found = fs.globStatus(hadoop) or []
        numbers = [name for name in (f.getPath().getName() for f in found) if name.isdigit()]
        if not numbers:
            return -1, None
        line = self.spark.read.text(f"{self.path(table)}_current/{max(numbers)}").first()[0]
        return int(max(numbers)), line.split("\t")[0]

    def committed_runs(self) -> list[str]:
        """Names of the runs that pointers commit; one short name a run."""
        if not self.exists(f"{self.path(COMMITS)}_current"):
            return []
        parts = F.split("value", "\t")
        rows = self.spark.read.text(f"{self.path(COMMITS)}_current").where(F.size(parts) > 1).select(parts[1]).distinct()
        return sorted(r[0] for r in rows.collect())

    # ---- writing
    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows; partitioned tables write one folder per partition value.

        No shuffle by the partition column: one dominant symbol would land in one task.
        """
        writer = rows.write.mode("append").option("compression", "zstd")
        if table in PARTITIONS:
            writer = writer.partitionBy(*PARTITIONS[table])
        writer.parquet(self.path(table))

    def replace_slices(self, table: str, rows: DataFrame, sort: list[str] | None = None) -> None:
        """Overwrite only the partitions present in ``rows`` (needs a partitioned table).

        Rows are written where they are: a large partition becomes several files.
        """
        keys = PARTITIONS[table]
        if sort:
            rows = rows.sortWithinPartitions(*keys, *sort)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
            "compression", "zstd").partitionBy(*keys).parquet(self.path(table))

    def replace_slice(self, table: str, key: str, value: str, rows: DataFrame) -> None:
        """Overwrite the partition ``key = value``; no rows leave it empty."""
        seen = Observation()
        rows = rows.where(F.col(key) == value).observe(seen, F.count("*").alias("n"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(key).parquet(self.path(table))
        if not seen.get["n"]:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/{key}={value}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def append_new(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        """Append the rows whose keys (nulls equal) the table doesn't hold yet."""
        known = self.read(table).select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [rows[k].eqNullSafe(known[f"_{k}"]) for k in keys]
        self.append(table, rows.join(known, same, "left_anti"))

    def replace(self, table: str, rows: DataFrame) -> int:
        """Write a new version beside the old one, then point to it; returns the row count.

        Readers see the old version until the pointer is there. Of two writers at once both get a number of their own, so
        no version is lost from the history; rows computed from the table itself belong into ``update``.
        """
        version, n = self._write_version(table, rows)
        for _ in range(ATTEMPTS):
            if self._point(table, self.current(table)[0] + 1, version):
                return n
        raise RuntimeError(f"{table}: other writers were faster {ATTEMPTS} times")

    def update(self, table: str, step: Callable[[DataFrame], DataFrame], run_id: str | None = None) -> int:
        """Replace the table by ``step`` of its rows; returns the row count.

        When another writer points to a version of its own in between, ``step`` is applied again to that version, so
        neither change is lost. With ``run_id`` the pointer commits that run; a run is committed once (-1 when it was before).
        """
        for _ in range(ATTEMPTS):
            seq, base = self.current(table)
            if run_id is not None and run_id in self.committed_runs():
                return -1
            version, n = self._write_version(table, step(self.empty(table) if seq < 0 else self._version(table, base)))
            if self._point(table, seq + 1, version, run_id):
                return n
        raise RuntimeError(f"{table}: other writers were faster {ATTEMPTS} times")

    def commit_run(self, run_id: str, appends: dict[str, DataFrame], step: Callable[[DataFrame], DataFrame]) -> bool:
        """Append rows to several tables and advance the state table, all visible at once or not at all.

        The rows lie in folders of their run, which a repeated run overwrites, and count from the moment that a pointer of
        the state table names the run. Repeating a committed run changes nothing and returns False.
        """
        if run_id in self.committed_runs():
            return False
        for table, rows in appends.items():
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
            if table in PARTITIONS:
                writer = writer.partitionBy(*PARTITIONS[table])
            writer.parquet(f"{self.path(table)}_runs/run_id={run_id}")
        return self.update(COMMITS, step, run_id) >= 0

    def _write_version(self, table: str, rows: DataFrame) -> tuple[str, int]:
        version, seen = uuid.uuid4().hex, Observation()
        rows.observe(seen, F.count("*").alias("n")).write.option("compression", "zstd").parquet(f"{self.path(table)}_versions/v={version}")
        return version, seen.get["n"]

    def _point(self, table: str, seq: int, version: str, run_id: str | None = None) -> bool:
        """Create pointer ``seq``, or return False when it is there already (create if absent)."""
        hadoop, fs = self._hadoop(f"{self.path(table)}_current/{seq:012d}")
        try:
            out = fs.create(hadoop, False)
        except Py4JJavaError as refused:
            if fs.exists(hadoop):
                return False
            raise refused
        out.write((version if run_id is None else f"{version}\t{run_id}").encode())
        out.close()
        return True

    def save_dataset(self, model: str, run_id: str, rows: DataFrame) -> str:
        """Training-set snapshot of one run."""
        path = f"{self.root}/ml/{model}/run_id={run_id.replace(':', '-').replace('+', '-')}"
        rows.write.mode("overwrite").parquet(path)
        return path


def export_csv(rows: DataFrame, columns: list[str], path: str) -> None:
    """CSV with a header, the given column order and empty cells for NULL."""
    rows.select(*columns).write.mode("overwrite").option("header", True).option("nullValue", "").option(
        "emptyValue", "").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path)
