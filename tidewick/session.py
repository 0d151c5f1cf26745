"""Session construction and the shared folder that written intermediates go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_UNSET = "__unset__"

# Runtime settings every operator may rely on. A window group holds at most one block plus
# its halo (about 50,000 minute rows), so it is buffered in memory instead of in a sorter.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.windowExec.buffer.in.memory.threshold": "65536",
}


def build_session(app: str = "tidewick", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on.

    On a cluster leave ``master`` and ``shuffle_partitions`` to spark-submit: AQE
    coalesces small shuffle partitions and splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session built elsewhere. All lake time is UTC; casts
    between TIMESTAMP and TIMESTAMP_NTZ depend on it."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", _UNSET)
    if folder == _UNSET or not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidewick-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
