"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewick.session import written


def _joined(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def labels(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge (columns a, b: long); label is the smallest node of its component.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest of them. Only minima per
    node are grouped, so a hub costs its rows and not their pairs. Rounds grow with the logarithm of the longest path.
    Null ends are left out.
    """
    now = written(_joined(edges.where("a IS NOT NULL AND b IS NOT NULL")), "edges")
    state = _state(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = _joined(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")))
        large = written(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        hung = large.join(least, "a")
        small = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
        now = written(_joined(small), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
