"""From raw documents to packed training sequences. Each stage's rows are written and read back by the next."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tidewick.llm import content_sort, decontam, packing, severity, simhash
from tidewick.llm.common import lean, table
from tidewick.session import written

# The severity model and the packing plan have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the cut, learned from ``labels``."""
    return severity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the document with the smallest doc_id."""
    return content_sort.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the document with the smallest doc_id: SimHash links that hold by Jaccard 0.8 on
    5-word shingles, and the links of that similarity that fingerprints can't meet."""
    return simhash.drop_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no item of ``benchmark``."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence of 2048 tokens."""
    return packing.packed_documents(docs)


def _lean(stage):
    """The stage with small batches to Python: all stages run in the same executors, one after another."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        lean(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [(stage.__name__, _lean(stage)) for stage in (toxicity, exact_dedup, near_dedup, decontamination, pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
