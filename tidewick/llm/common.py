"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Bytes 0x20 and 0x09-0x0D are the only separators; ``bytes.split()`` splits on exactly these.
SPACES = r"[\x20\x09-\x0D]+"
BATCH = 4 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased; null has none."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def lean(spark: SparkSession) -> None:
    """From now on batches of rows to Python hold at most ``BATCH`` bytes (one row at least): the JVM and the worker of
    every task each hold a batch more than once, and the default of 64 MB adds up in an executor. Rows are the same."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and the whole text, null read as empty; all other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))


def bytes_at_most(frames: Iterator, column: str, limit: int = 16 << 20) -> Iterator:
    """Cut pandas batches into slices of at most ``limit`` characters (one row at least), so that long texts
    don't add up in a worker. Every row is passed on."""
    for frame in frames:
        if not len(frame):
            continue
        sizes = frame[column].str.len().fillna(0).to_numpy()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield frame.iloc[start:i]
                start, total = i, 0
            total += size
        yield frame.iloc[start:]
