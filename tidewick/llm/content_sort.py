"""Exact duplicates by sorting content: equal texts become neighbours, the smallest identifier stays.

Sampled splitters deal the normalised texts out in ranges, each range is sorted by Spark's external sort, and the
window over a range compares whole neighbouring texts. Splitters order by the first bytes and a hash of the whole
text, so a sample on the driver holds short keys even when texts are long, and texts with one common beginning still
spread. A text with very many copies is cut into runs by identifier; the runs' heads are joined afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.llm.common import SPACES, whole

LEAST_RUN = 256  # copies of a text that one task may hold without being cut into runs
MOST_RUNS = 20_000  # runs of cut texts are at most twice as many, which bounds what is broadcast


def normalised(text: Column) -> Column:
    """Every run of spaces, tabs and line ends becomes one space; null becomes the empty text."""
    return F.regexp_replace(whole(text), SPACES, " ")


def _judged(docs: DataFrame, carry: Column) -> DataFrame:
    """Every row with its group; ``carry`` travels along as column ``row``."""
    body = normalised(F.col("text"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), carry.alias("row"), F.substring(body, 1, 24).alias("head"), F.xxhash64(body).alias("h"))
    copies = docs.select(F.xxhash64(body).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    run = max(LEAST_RUN, docs.count() // MOST_RUNS)
    # At most total / run rows: the bound above makes this small at any size.
    large = copies.where(F.col("n") > run).select("h", F.ceil(F.col("n") / run).cast("long").alias("runs"))
    dealt = (
        keyed.join(F.broadcast(large), "h", "left")
        .withColumn("run", F.when(F.col("runs").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("doc_id"), F.coalesce("runs", F.lit(1)))))
        .select("head", "h", "run", "doc_id", "text", "row")
        .repartitionByRange("head", "h", "run")
        .select("head", "h", "run", "doc_id", body.alias("body"), "row")
    )
    same = Window.partitionBy("head", "h", "run", "body")
    rank = same.orderBy(F.col("doc_id").asc_nulls_last())
    rows = dealt.withColumns({"at": F.row_number().over(rank), "first": F.min("doc_id").over(same), "size": F.count("*").over(same)})
    # Heads of the cut texts, joined by the whole text; then given back to the rows of each run.
    merged = Window.partitionBy("body")
    first_run = merged.orderBy(F.col("first").asc_nulls_last(), "run")
    cut = rows.where((F.col("run") >= 0) & (F.col("at") == 1)).select(
        F.col("h").alias("_h"), F.col("run").alias("_run"), F.col("first").alias("_first"), F.min("first").over(merged).alias("_keep"),
        F.sum("size").over(merged).alias("_size"), (F.row_number().over(first_run) == 1).alias("_wins"),
    )
    joined = rows.join(F.broadcast(cut), (F.col("h") == F.col("_h")) & (F.col("run") == F.col("_run")) & F.col("first").eqNullSafe(F.col("_first")), "left")
    return joined.select(
        "doc_id",
        F.when(F.col("_wins").isNull(), F.col("first")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", "size").alias("group_size"),
        ((F.col("at") == 1) & F.coalesce("_wins", F.lit(True))).alias("kept"),
        F.sha2("body", 256).alias("text_sha256"),
        "row",
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts equal empty ones. A null doc_id counts as larger than any number. Repeated rows (same doc_id and text)
    are copies like others: exactly one row of a group is kept. An empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    return _judged(docs.select("doc_id", "text"), F.lit(None).cast("boolean")).drop("row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; the same cases as in ``exact_groups``."""
    return _judged(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns])).where("kept").select("row.*")


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""
