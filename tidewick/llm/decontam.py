"""Benchmark decontamination by spaced seeds.

A seed is a mask over a few neighbouring words, of which some places are ignored. Wherever four of five words agree
between the first and the last of at least ten, one of two masks of four words agrees as well; for items of five to nine
words two masks of three words do the same (the tests go through all places that changed words can have). Test items are
hashed once per block of the benchmark; training texts are hashed by the same masks and looked up. Around each hit the two
texts are compared word by word along its diagonal, and of all stretches in which at least four of five words agree the one
with the most agreeing words is kept. Stretches on several diagonals (words put in or left out) add up per item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import bytes_at_most, texts, whole
from tidewick.session import written

SPAN = 10  # items of fewer words are hashed by the short masks
LONG, SHORT = ((0, 1, 2, 4), (0, 1, 4, 5)), ((0, 1, 3), (0, 2, 3))  # places that a mask reads
LEAST = 13  # words that must agree in one stretch
SHARE = 0.8  # ... or the share of a short item's words
SHORTEST = 5  # items of fewer words never match
BLOCK_WORDS = 400_000  # benchmark words looked up in one pass over the documents
_WORD = re.compile(r"\w+")
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(1 + max(map(max, LONG + SHORT)))], np.uint64)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Block:
    """Words and seeds of some benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [i for i, _ in items]
        split = [words_of(t) for _, t in items]
        self.ids: dict[str, int] = {}
        for w in sorted({w for s in split for w in s}):
            self.ids[w] = len(self.ids) + 1  # 0: a word that no item has
        self.codes = [np.array([self.ids[w] for w in s], np.int64) for s in split]
        # mask: (hashes ascending, item, place) of the items that are hashed by it
        self.seeds: dict[tuple[int, ...], tuple[np.ndarray, ...]] = {}
        for masks, least, below in ((LONG, SPAN, np.inf), (SHORT, SHORTEST, SPAN)):
            own = [k for k, code in enumerate(self.codes) if least <= len(code) < below]
            for mask in masks if own else ():
                h = [seeds(self.codes[k], mask) for k in own]
                item, at = np.repeat(own, [len(x) for x in h]), np.concatenate([np.arange(len(x)) for x in h])
                h = np.concatenate(h)
                order = np.argsort(h, kind="stable")
                self.seeds[mask] = h[order], item[order], at[order]

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, overlap, covered, first word) of every item that the text overlaps with, one row per item."""
        split = words_of(text)
        code = np.fromiter(map(self.ids.get, split, repeat(0)), np.int64, len(split))
        diagonals: set[tuple[int, int]] = set()
        known = code > 0
        for mask, (hashes, item, place) in self.seeds.items() if known.any() else ():
            n = len(code) - mask[-1]
            # Places that a mask reads must all hold benchmark words.
            at = np.flatnonzero(np.logical_and.reduce([known[p : n + p] for p in mask])) if n > 0 else known[:0]
            if not len(at):
                continue
            h = seeds(code, mask, at)
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for i in np.flatnonzero(high > low):
                span = slice(low[i], high[i])
                diagonals.update(zip(item[span].tolist(), (at[i] - place[span]).tolist()))
        by_item: dict[int, list] = {}
        for k, diagonal in diagonals:
            item = self.codes[k]
            a, b = max(0, -diagonal), min(len(item), len(code) - diagonal)
            agree = item[a:b] == code[a + diagonal : b + diagonal]
            first, last = best_stretch(agree)
            if last > first:
                by_item.setdefault(k, []).append((int(agree[first:last].sum()), a + first, a + last, a + first + diagonal, np.flatnonzero(agree[first:last]) + a + first))
        out = []
        for k, some in by_item.items():
            best = max(some, key=lambda s: (s[0], -s[3]))
            covered = len(np.unique(np.concatenate([s[4] for s in some])))
            n = len(self.codes[k])
            if best[0] >= LEAST or covered >= np.ceil(SHARE * n):
                out.append((self.items[k], best[0], covered, best[3]))
        return out


def seeds(code: np.ndarray, mask: tuple[int, ...], at: np.ndarray | None = None) -> np.ndarray:
    """Hash of every window (or of those at ``at``) over the places that the mask reads."""
    n = max(0, len(code) - mask[-1])
    out = np.zeros(n if at is None else len(at), np.uint64)
    for p in mask:
        part = code[p : p + n] if at is None else code[at + p]
        out += mixed(part) * _FACTORS[p]
    return out


def mixed(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def best_stretch(agree: np.ndarray) -> tuple[int, int]:
    """Of all stretches in which at least four of five words agree the one with the most agreeing words (the first of
    those), without words at its ends that don't agree."""
    count = np.concatenate([[0], np.cumsum(agree)])
    score = 5 * count - 4 * np.arange(len(count))  # a stretch is accepted if its score doesn't fall
    low = np.minimum.accumulate(score)
    # The longest accepted stretch that ends at each place begins where the score was first as low.
    start = np.searchsorted(-low, -score, "left")
    end = int((count - count[start]).argmax())
    at = np.flatnonzero(agree[start[end] : end])
    return (int(start[end] + at[0]), int(start[end] + at[-1] + 1)) if len(at) else (0, 0)


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Benchmark items in blocks of bounded size, read one block at a time by the caller's loop."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole(F.col("text")).alias("text")).where("item_id IS NOT NULL").distinct()
    sized = items.withColumn("n", F.greatest(F.lit(1), F.size(F.split("text", r"\s+"))))
    total = sized.agg(F.sum("n")).first()[0] or 0
    number = -(-total // BLOCK_WORDS)
    while number:
        cut = sized.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(number)))
        worst = cut.groupBy("block").agg(F.sum("n").alias("n"), F.count("*").alias("k")).where("k > 1").agg(F.max("n")).first()[0] or 0
        if worst <= 2 * BLOCK_WORDS:
            for b in range(number):
                yield [(r["item_id"], r["text"]) for r in cut.where(F.col("block") == b).select("item_id", "text").orderBy("item_id", "text").collect()]
            return
        number *= 2


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, overlap, covered, first_word) of every document and item that overlap, as stored rows.

    overlap: words that agree in the best stretch; covered: the item's words found on any diagonal; first_word: place
    in the document. A pair counts if overlap >= 13 or if four fifths of the item are covered, wherever its changed words
    lie; with words put in or left out, pieces count that hold a seed. Items of fewer than five
    words and null items match nothing; null and empty texts overlap with nothing; several rows of one item_id count as
    items of that id, repeated rows of documents each give rows. Each block of the benchmark is one pass over the
    documents; the test tables fit one block.
    """
    spark, schema = docs.sparkSession, "doc_id long, item_id long, overlap int, covered int, first_word int"
    out = None
    for items in blocks(benchmark):
        shared = spark.sparkContext.broadcast(Block(items))

        def run(frames, shared=shared):
            block = shared.value
            for frame in bytes_at_most(frames, "text"):
                rows = [(d, *m) for d, t in zip(frame["doc_id"], frame["text"]) for m in block.matches(t)]
                if rows:
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "overlap", "covered", "first_word"]).astype({"doc_id": "Int64"})

        found = written(texts(docs).mapInPandas(run, schema), "overlaps")
        shared.unpersist()
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, with their columns, that overlap with no benchmark item. Each row is judged by its own text, so
    nothing is joined; null and empty texts stay, repeated rows are judged alike, and an empty table stays empty. Between
    blocks of a large benchmark the rows left are written, so that one block at a time is held."""
    held = None
    for items in blocks(benchmark):
        if held is not None:
            docs = written(docs, "uncontaminated")
            held.unpersist()
        held = docs.sparkSession.sparkContext.broadcast(Block(items))
        docs = docs.where(_clean(held)(F.col("text")))
    return docs


def _clean(shared):
    @F.pandas_udf("boolean")
    def clean(some: pd.Series) -> pd.Series:
        return pd.Series([not t or not shared.value.matches(t) for t in some], dtype=bool)

    return clean
