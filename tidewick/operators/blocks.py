"""Splitting one long ordered series over many tasks without changing any result.

A symbol may hold a large share of all rows, so no window here is partitioned by
symbol alone. Rows are grouped by (key, time block); a block also receives copies of
the neighbours' rows that its frames can reach (the halo), or a small per-block
summary of everything earlier (the carry). Group size is bounded by block length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.functions.timefn import floor_div

BLOCK = "_block"


def with_halo(df: DataFrame, at: str, block_us: int, back_us: int = 0, ahead_us: int = 0) -> DataFrame:
    """Copy each row to its own block and to the adjacent blocks whose frames reach it.

    ``back_us`` / ``ahead_us`` are the longest frame reaches. ``owned`` tells the one
    original from the copies.
    """
    if max(back_us, ahead_us) > block_us:
        raise ValueError("a block must be at least as long as the frame reach")
    own = floor_div(F.col(at), block_us)
    homes = [own]
    if back_us:
        homes.append(F.when(F.col(at) >= (own + 1) * block_us - back_us, own + 1))
    if ahead_us:
        homes.append(F.when(F.col(at) < own * block_us + ahead_us, own - 1))
    return df.withColumn(BLOCK, F.explode(F.array(*homes))).where(F.col(BLOCK).isNotNull())


def owned(at: str, block_us: int) -> Column:
    return floor_div(F.col(at), block_us) == F.col(BLOCK)


def in_block(keys: list[str], at: str):
    return Window.partitionBy(*keys, BLOCK).orderBy(at)


def running_total(df: DataFrame, keys: list[str], at: str, amount: str, out: str, block: Column) -> DataFrame:
    """Exact inclusive running sum of ``amount`` by ``at`` within ``keys``.

    ``at`` must be unique within ``keys`` and ``block`` must not decrease with it. Block
    totals are scanned first (one row per block), then each block is summed on its own.
    """
    blocked = df.withColumn(BLOCK, block)
    totals = blocked.groupBy(*keys, BLOCK).agg(F.sum(amount).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, BLOCK, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_carry"))
    so_far = in_block(keys, at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        blocked.join(carry, [*keys, BLOCK])
        .withColumn(out, F.col("_carry") + F.sum(amount).over(so_far))
        .drop("_carry", BLOCK)
    )
