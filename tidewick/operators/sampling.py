"""A fixed-size sample that does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.operators.blocks import running_total


def hash_sample(df: DataFrame, identity: list[Column], n: int, seed: int) -> DataFrame:
    """The n rows with the smallest hash of (identity, seed); all rows when there are fewer.

    Rows are counted per hash bucket to find the bucket in which the n-th row falls. Buckets
    below it are kept whole and only that one is ordered, so nothing is sorted globally.
    """
    key = F.md5(F.concat_ws("|", *[c.cast("string") for c in identity], F.lit(str(seed))))
    hashed = df.withColumn("_key", key).withColumn("_bucket", F.conv(F.substring("_key", 1, 5), 16, 10).cast("long"))
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    filled = running_total(sizes, [], "_bucket", "_n", "_upto", F.floor(F.col("_bucket") / 1024))
    wanted = filled.where(F.col("_upto") - F.col("_n") < n).select("_bucket", (F.lit(n) - F.col("_upto") + F.col("_n")).alias("_room"), "_n")
    placed = hashed.join(wanted, "_bucket")
    whole = placed.where("_room >= _n")
    order = Window.partitionBy("_bucket").orderBy("_key")
    partial = placed.where("_room < _n").withColumn("_rn", F.row_number().over(order)).where("_rn <= _room").drop("_rn")
    return whole.unionByName(partial).drop("_key", "_bucket", "_room", "_n")
