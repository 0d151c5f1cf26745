"""Phrases of two and three words that stand together more often than their parts let expect.

A suffix is a word with the (at most two) words after it in its piece of text. Tasks sort the suffixes of their documents,
combine equal ones, and deal them out in ranges of leading words between sampled splitters. Within a range, suffix pointers
are sorted by three-way quicksort, one key (word) after another: in each round every open partition is parted by a pivot
word of its own into less, equal and greater. An equal partition holds one phrase, its size is the phrase's count, and it
goes on to the next word; partitions too small for any candidate are abandoned. Only phrases that begin like one of the two
splitters of their range may stand in several ranges; they are never abandoned, and their partial counts are added up.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tidewick.llm.common import LOWER, bytes_at_most, whole
from tidewick.session import written

LEAST = 10  # occurrences of a candidate
SHARE = 50  # a candidate goes if a longer one that holds it has this many hundredths of its count
TOP = 2000
BATCH = 4 << 20  # characters sorted at a time in a task
CHUNK = 1 << 20  # words numbered at a time: three of their numbers fit one 64-bit key
RANGE_CHARS = 8 << 20  # characters of text to a range
SAMPLED = 2000  # documents that splitters are taken from
SAMPLED_WORDS = 64  # suffixes of each
_BITS = 21
_BREAK = b"\xff"  # stands in no UTF-8 text
_CUTS = LOWER.translate(bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10))


# ---- suffixes of texts
def words_and_breaks(text: str) -> list[bytes]:
    """Lower-cased words of a text in order, with a break after every piece."""
    return text.encode("utf-8", "surrogatepass").translate(_CUTS).replace(_BREAK, b" \xff ").split() + [_BREAK]


def suffixes(tokens: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """(words in byte order, keys) of all suffixes; a key is three word numbers of 21 bits, from 1 on, 0 after the end."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
    numbers.pop(_BREAK, None)
    words = sorted(numbers)
    rank = np.zeros(len(words) + 2, np.int64)
    rank[[numbers[w] for w in words]] = np.arange(1, len(words) + 1)
    ranked = np.concatenate([rank[ids], [0, 0]])
    second = ranked[1:-1]
    third = np.where(second > 0, ranked[2:], 0)
    keys = (ranked[:-2] << 2 * _BITS) | (second << _BITS) | third
    return words, keys[ranked[:-2] > 0]


def chunks(texts: list[str]):
    """Words and breaks of texts in runs of at most about ``CHUNK``. A longer text is cut: a run then ends with the first
    two words of the next as lookahead, so (tokens, how many of them begin suffixes of their own)."""
    some: list[bytes] = []
    for t in texts:
        more = words_and_breaks(t)
        if some and len(some) + len(more) > CHUNK:
            yield some, len(some)
            some = []
        at = 0
        while len(more) - at > CHUNK:
            yield more[at : at + CHUNK + 2], CHUNK
            at += CHUNK
        some += more[at:]
    if some:
        yield some, len(some)


def counted(tokens: list[bytes], own: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, different keys ascending, how often) of the suffixes that begin in the first ``own`` tokens."""
    words, keys = suffixes(tokens)
    if own < len(tokens):
        keys = keys[: sum(t != _BREAK for t in tokens[:own])]
    return words, *np.unique(keys, return_counts=True)


# ---- ranges
class Splitters:
    """Ascending (lang, word, word, word) that part the ranges; a suffix belongs to the range after the last splitter that
    isn't greater. Empty words stand for the end of a piece."""

    def __init__(self, keys: list[tuple[bytes, ...]]):
        self.keys = sorted(set(keys))

    def ranges(self, lang: bytes, words: list[bytes], keys: np.ndarray) -> np.ndarray:
        """The range of each key over ``words``."""
        bounds = []
        for own, *rest in self.keys:
            low, shift = 0, 2 * _BITS
            for w in rest if own == lang else []:
                if not w:
                    break
                at = bisect_left(words, w)
                low |= (at + 1) << shift
                if at == len(words) or words[at] != w:  # lies just before the next word that there is
                    break
                shift -= _BITS
            if own <= lang:
                bounds.append(low)
        return np.searchsorted(np.array(bounds, np.int64), keys, "right")

    def open_phrases(self, k: int, lang: bytes) -> set[tuple[bytes, ...]]:
        """Beginnings (one and two words) of the two splitters of range k: what may go on in a neighbouring range."""
        near = [key[1:] for key in self.keys[max(0, k - 1) : k + 1] if key[0] == lang]
        return {key[:n] for key in near for n in (1, 2) if all(key[:n])}


def packed(words: list[bytes], keys: np.ndarray, times: np.ndarray) -> bytes:
    parts = [keys >> 2 * _BITS, (keys >> _BITS) & ((1 << _BITS) - 1), keys & ((1 << _BITS) - 1)]
    used = np.unique(np.concatenate([[0], *parts]))
    numbers = [np.searchsorted(used, p).astype("<i4").tobytes() for p in parts]
    spelt = b" ".join([words[k - 1] for k in used[1:].tolist()])
    press = zstandard.ZstdCompressor(level=1).compress
    return press(len(keys).to_bytes(8, "little") + b"".join(numbers) + times.astype("<i8").tobytes() + spelt)


def unpacked(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, their numbers (rows: first, second, third word; 0 for none), how often)."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    numbers = np.frombuffer(raw, "<i4", 3 * n, 8).reshape(3, n)
    return raw[8 + 20 * n :].split(b" ") if n else [], numbers, np.frombuffer(raw, "<i8", n, 8 + 12 * n)


# ---- sorting
def equal_partitions(keys: np.ndarray, times: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(words, pointer, size): every phrase of one to three words that begins at least ``least`` suffixes, by the number
    of its words and one suffix that begins with it.

    ``keys`` has a row per word place (0: no word), a column per suffix. Multikey three-way quicksort: all open partitions
    are parted at once, each by the word that its pivot suffix has at the partition's depth. Pointers carry the number of
    their partition. The equal part of a partition is a phrase, its size is the count, and it is parted by its next
    word; parts smaller than ``least`` are abandoned.
    """
    deepest = len(keys)
    at = np.random.default_rng(0).permutation(keys.shape[1])  # so that any pointer of a partition is a fair pivot
    at = at[keys[0, at] > 0] if deepest else at[:0]
    part, depth = np.zeros(len(at), np.int64), np.zeros(1, np.int64)
    found: list[tuple[int, int, int]] = []
    while len(at):
        word = keys[depth[part], at]
        pivot = np.zeros(len(depth), np.int64)
        pivot[part] = word
        side = np.sign(word - pivot[part]) + 1
        now = part * 3 + side
        size = np.bincount(now, weights=times[at], minlength=3 * len(depth)).astype(np.int64)
        some = np.zeros(3 * len(depth), np.int64)
        some[now] = at
        deeper = np.repeat(depth, 3) + (np.arange(3 * len(depth)) % 3 == 1)
        keep = size >= least
        equal = np.flatnonzero(keep & (np.arange(3 * len(depth)) % 3 == 1))
        found += zip(deeper[equal].tolist(), some[equal].tolist(), size[equal].tolist())
        open_ = keep & (deeper < deepest)
        alive = open_[now]
        at, now = at[alive], now[alive]
        alive = keys[deeper[now], at] > 0  # pieces that end here have no next word
        at, now = at[alive], now[alive]
        number = np.cumsum(open_) - 1
        part, depth = number[now], deeper[open_]
    return found


def phrases_of_range(blobs: list[bytes], open_: set[tuple[bytes, ...]], least: int) -> list[tuple[int, bytes, int]]:
    """(words, phrase, count) of one language in one range: the phrases whose count is ``least`` or more, the partial
    counts of the open ones, and the number of suffixes (no words)."""
    parts = [unpacked(b) for b in blobs]
    words = sorted(set().union(*(p[0] for p in parts)))
    number = {w: k for k, w in enumerate(words, 1)}
    keys = np.concatenate([np.array([0, *map(number.__getitem__, w)], np.int64)[n] for w, n, _ in parts], axis=1)
    times = np.concatenate([t for *_, t in parts])
    spelt = [b"", *words]
    out = [(0, b"", int(times.sum()))]
    for p in open_:
        hit = np.ones(len(times), bool)
        for depth, w in enumerate(p):
            hit &= keys[depth] == number.get(w, -1)
        out.append((len(p), b" ".join(p), int(times[hit].sum())))
    for n, pointer, size in equal_partitions(keys, times, least):
        phrase = tuple(spelt[k] for k in keys[:n, pointer].tolist())
        if phrase not in open_:
            out.append((n, b" ".join(phrase), size))
    return out


# ---- data sets
def _by_lang(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole(F.col("text")).alias("text"))


def _splitters(rows: DataFrame, ranges: int, documents: int) -> Splitters:
    """Quantiles of at most about ``SAMPLED`` * ``SAMPLED_WORDS`` suffixes of sampled documents, words shortened to 32 bytes.
    They decide how evenly the work is dealt out, and about nothing else."""

    def run(frames):
        rng = np.random.default_rng(0)
        for frame in bytes_at_most(frames, "text", BATCH):
            out = []
            for lang, text in zip(frame["lang"], frame["text"]):
                tokens = [*words_and_breaks(text), _BREAK, _BREAK]
                for k in rng.choice(len(tokens) - 2, min(SAMPLED_WORDS, len(tokens) - 2), replace=False).tolist():
                    some = tokens[k : k + 3]
                    if some[0] != _BREAK:
                        some = some[: some.index(_BREAK)] if _BREAK in some else some
                        out.append((lang.encode(), *[w[:32] for w in (some + [b"", b""])[:3]], max(1.0, len(tokens) / SAMPLED_WORDS)))
            yield pd.DataFrame(out, columns=["lang", "a", "b", "c", "weight"])

    sample = rows.sample(min(1.0, SAMPLED / max(1, documents)), 7)
    got = sample.mapInPandas(run, "lang binary, a binary, b binary, c binary, weight double").toPandas()
    got = sorted(zip(*(map(bytes, got[c]) for c in ("lang", "a", "b", "c")), got["weight"]))
    total = np.cumsum([g[4] for g in got])
    cuts = np.searchsorted(total, np.arange(1, ranges) / ranges * total[-1]) if got else []
    return Splitters([got[k][:4] for k in cuts])


def phrase_counts(docs: DataFrame, least: int = LEAST, ranges: int | None = None) -> DataFrame:
    """Stored rows (lang, words, phrase, n): every phrase of one to three words with at least ``least`` occurrences within
    pieces in its language, and n of all words (0 words, phrase '')."""
    spark, rows = docs.sparkSession, _by_lang(docs)
    documents, chars = rows.agg(F.count("*"), F.sum(F.length("text"))).first()
    ranges = ranges or max(2 * spark.sparkContext.defaultParallelism, -(-(chars or 0) // RANGE_CHARS))
    splitters = _splitters(rows, ranges, documents)
    ranges = len(splitters.keys) + 1

    def deal(frames):
        for frame in bytes_at_most(frames, "text", BATCH):
            out = []
            for lang, texts in frame.groupby("lang", sort=False)["text"]:
                for tokens, own in chunks(texts.tolist()):
                    words, keys, times = counted(tokens, own)
                    range_ = splitters.ranges(lang.encode(), words, keys)
                    firsts = np.flatnonzero(np.diff(range_, prepend=-1))
                    for a, b in zip(firsts, [*firsts[1:], len(keys)]):
                        out.append((int(range_[a]), lang, packed(words, keys[a:b], times[a:b])))
            yield pd.DataFrame(out, columns=["range", "lang", "suffixes"])

    def sort(frames):
        # Tasks hold one range (or a few where Spark puts them together): a bounded part of all suffixes.
        held: dict[tuple[int, str], list[bytes]] = defaultdict(list)
        for frame in frames:
            for range_, lang, blob in zip(frame["range"], frame["lang"], frame["suffixes"]):
                held[int(range_), lang].append(blob)
        for (range_, lang), blobs in held.items():
            got = phrases_of_range(blobs, splitters.open_phrases(range_, lang.encode()), least)
            yield pd.DataFrame([(lang, n, p.decode("utf-8", "replace"), k) for n, p, k in got], columns=["lang", "words", "phrase", "n"])

    dealt = rows.mapInPandas(deal, "range int, lang string, suffixes binary").repartitionById(ranges, "range")
    counts = dealt.mapInPandas(sort, "lang string, words int, phrase string, n long").groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return written(counts.where((F.col("n") >= least) | (F.col("words") == 0)), "phrase-counts")


def _first(phrase: str, words: str) -> str:
    return f"substring_index({phrase}, ' ', {words})"


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, ranges: int | None = None) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a: occurrences of the phrase; l, r: of the two parts at the cut with the lowest score; n: all words of the language;
    score: floor(10**6 a a / (l r)) in exact decimals. Ties are ranked by a (descending), then by the phrase's bytes. A null
    lang is ``und``, a null text has no words. Repeated rows count each; doc_id isn't read; an empty table gives no
    rows; other columns are ignored.
    """
    counts = phrase_counts(docs, least, ranges)
    totals = counts.where("words = 0").select("lang", F.col("n").alias("all_words"))
    known = counts.where("words > 0").select("lang", "phrase", "n")
    several = counts.where("words > 1")
    longer = several.where("words = 3").select("lang", "n", F.explode(F.array(F.expr(_first("phrase", "2")), F.expr(_first("phrase", "-2")))).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    candidates = several.join(most, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (F.lit(100) * F.col("longest") < F.lit(share) * F.col("n")))
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"), "words")
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr(_first("phrase", "k")).alias("left"), F.expr(_first("phrase", "k - words")).alias("right"))
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    # A million times a product of two such decimals has 37 digits at most.
    value = F.floor(F.expr("CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", value.cast("long"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first ``top`` of each of a few parts of a language, then of those: one task never sees a language's all candidates.
    parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    few = best.withColumn("rank", F.row_number().over(parted)).where(F.col("rank") <= top).drop("rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda w: w <> '') AS ws FROM pieces),
placed AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM worded),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
f AS (
  SELECT lang, size, phrase, count(*) AS n
  FROM (SELECT lang, k AS size, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM placed, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(ws))
  GROUP BY ALL HAVING count(*) >= 10),
held AS (
  SELECT lang, phrase, max(n) AS longest
  FROM (SELECT lang, n, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase FROM f WHERE size = 3)
  GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.phrase, c.n AS a, k,
         array_to_string(string_split(c.phrase, ' ')[1:k], ' ') AS lft, array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ') AS rgt
  FROM f AS c LEFT JOIN held AS h ON c.lang = h.lang AND c.phrase = h.phrase, (VALUES (1), (2)) AS ks(k)
  WHERE c.size > 1 AND k < c.size AND NOT coalesce(100 * h.longest >= 50 * c.n, false)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.n AS l, y.n AS r, CAST((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = lft JOIN f AS y ON y.lang = cuts.lang AND y.phrase = rgt),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT ranked.lang, rank, phrase, a, l, r, totals.n AS n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""
