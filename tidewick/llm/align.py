"""Alignment of two tokenizers' tokens over the same bytes.

Both token streams of a text spell the same bytes. One numpy state vector holds the two pointers of every document of a
batch; in each step all documents compare the byte ends under their pointers and advance A, B or both at once. Where both
ends agree a link and a cut are emitted; finished documents leave the vector. Long documents travel in several lanes that
begin at places where both tokenizers end, so one of them doesn't keep the loop running alone.

The links' id pairs are counted over all documents by Spark; a table of counts of at most ``SMALL`` pairs is broadcast,
a larger one is joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidewick.llm import tokens
from tidewick.llm.common import bytes_at_most, texts
from tidewick.session import written

PIECES = "piece_bpe_32k.model"
BATCH = 4 << 20  # characters aligned at a time
LANE = 1024  # A tokens after which a lane is cut at the next common end
SMALL = 4_000_000  # id pairs whose counts are broadcast (16 bytes each); more are joined
WORDS = 400_000  # words whose pieces a worker remembers
_SHIFT = 1 << 31  # a pair is one long: A id times this plus B id
_NOTHING = (b"", b"")  # a word that one of the tokenizers doesn't spell
_SIDES: dict[tuple[str, str], "Sides"] = {}


# ---- the two tokenizers
class ByteSide:
    """Byte-level BPE: ids of space+text, special tokens' strings as plain text."""

    def __init__(self, path: str):
        self.words = tokens.WordIds(path, plain=True)
        value = {letter: b for b, letter in enumerate(tokens.byte_letters())}
        vocabulary = self.words.tokenizer.get_vocab()
        self.bytes_of = [b""] * (1 + max(vocabulary.values()))
        for entry, k in vocabulary.items():
            # Added tokens may be spelt outside the byte letters; as plain text they are never produced.
            self.bytes_of[k] = bytes(value[c] for c in entry) if all(c in value for c in entry) else entry.encode()
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)

    def ids(self, texts_: list[str]) -> list[bytes]:
        return self.words.encode_all([" " + t for t in texts_])

    def word_ids(self, words: list[str]) -> list[bytes]:
        return self.words.of_words(words)


class PieceSide:
    """Sentence pieces: ids of the text, to which the tokenizer adds a space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        # Without a piece that holds a space after another character, or a line end, nothing is merged across the
        # beginning of a word or a line.
        self.by_word = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.space = np.array([k for k, p in enumerate(pieces) if p == "▁"], "<u4").tobytes()

    def ids(self, texts_: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self.model.encode(texts_, num_threads=1)]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """A word with a line end before it has no space; the tokenizer's own comes as a piece of its own."""
        return [raw.removeprefix(self.space) if w[:1] == "\n" else raw for w, raw in zip(words, self.ids(words))]


class Sides:
    """Ids of both tokenizers. Texts are taken word by word where both allow it, and equal words are encoded once; a
    worker remembers at most ``WORDS`` of them and those of one slice of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def spelt(self, raw_a: list[bytes], raw_b: list[bytes], want: list[bytes]) -> list[bool]:
        """Whether both sides' ids give back the wanted bytes, item by item; looked at together first."""
        ends = np.cumsum([len(w) for w in want])
        for side, raw in ((self.a, raw_a), (self.b, raw_b)):
            ids = np.frombuffer(b"".join(raw), "<u4")
            sizes = np.concatenate([[0], np.cumsum(side.sizes[ids])])[np.cumsum([len(r) // 4 for r in raw], dtype=np.int64)] if len(raw) else ends
            if len(want) and (not np.array_equal(sizes, ends) or b"".join(map(side.bytes_of.__getitem__, ids.tolist())) != b"".join(want)):
                break
        else:
            return [True] * len(want)
        return [self.spelt([x], [y], [w])[0] for x, y, w in zip(raw_a, raw_b, want)] if len(want) > 1 else [False]

    def _splits(self, text: str) -> bool:
        return self.b.by_word and "  " not in text and not text.startswith(" ") and not text.endswith(" ") and "▁" not in text and tokens.in_words(text)

    def encode(self, texts_: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids (little-endian, 4 bytes) of each text by A and by B; none where one of them doesn't spell space+text."""
        out_a: list[bytes] = []
        out_b: list[bytes] = []
        for some in tokens.slices(texts_, 1 << 20):
            if len(self.known) > WORDS:
                self.known.clear()
                self.a.words.pieces.clear()
            split = [t.replace("\n", " \n").split(" ") if t and self._splits(t) else None for t in some]
            found = [None if s is None else list(map(self.known.get, s)) for s in split]
            late = [k for k, f in enumerate(found) if f is not None and None in f]
            new = list({w for k in late for w, f in zip(split[k], found[k]) if f is None})
            new_a, new_b = self.a.word_ids(new), self.b.word_ids(new)
            right = self.spelt(new_a, new_b, [(w if w[:1] == "\n" else " " + w).encode("utf-8", "surrogatepass") for w in new])
            self.known.update((w, (x, y) if ok else _NOTHING) for w, x, y, ok in zip(new, new_a, new_b, right))
            for k in late:
                found[k] = list(map(self.known.__getitem__, split[k]))
            for t, f in zip(some, found):
                if f is None:
                    raw_a, raw_b = (side.ids([t])[0] for side in (self.a, self.b))
                    if not t or not self.spelt([raw_a], [raw_b], [b" " + t.encode("utf-8", "surrogatepass")])[0]:
                        raw_a = raw_b = b""
                elif _NOTHING in f:
                    raw_a = raw_b = b""
                else:
                    raw_a, raw_b = b"".join([x for x, _ in f]), b"".join([x for _, x in f])
                out_a.append(raw_a)
                out_b.append(raw_b)
        return out_a, out_b


def sides(path_a: str, path_b: str) -> Sides:
    """One per Python worker and files."""
    if (path_a, path_b) not in _SIDES:
        _SIDES[path_a, path_b] = Sides(path_a, path_b)
    return _SIDES[path_a, path_b]


_SPELT: list[bytes] = []


def spellings(n: int) -> list[bytes]:
    """The first n of: id 0 before ``,`` and ``|`` (A), ``,`` and ``;`` (B), then id 1, and so on."""
    _SPELT.extend(b"%d%c" % (c >> 2, b",|,;"[c & 3]) for c in range(len(_SPELT), n))
    return _SPELT


# ---- lockstep
def merged(ends_a: np.ndarray, ends_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``ends_a`` and ``ends_b``) of every pair of tokens that end together, in no particular order.

    Document d holds the tokens from ``at_a[d]`` up to ``stop_a[d]`` and from ``at_b[d]`` up to ``stop_b[d]``; ends
    grow strictly within a document. All documents advance in each step.
    """
    links_a, links_b = [], []
    alive = (at_a < stop_a) & (at_b < stop_b)
    i, j, last_i, last_j = at_a[alive], at_b[alive], stop_a[alive], stop_b[alive]
    while len(i):
        a, b = ends_a[i], ends_b[j]
        on_a, on_b = a <= b, b <= a
        both = on_a & on_b
        links_a.append(i[both])
        links_b.append(j[both])
        i, j = i + on_a, j + on_b
        alive = (i < last_i) & (j < last_j)
        if not alive.all():
            i, j, last_i, last_j = i[alive], j[alive], last_i[alive], last_j[alive]
    return (np.concatenate(links_a), np.concatenate(links_b)) if links_a else (np.empty(0, np.int64),) * 2


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray, lane: int = LANE):
    """(stop_a, stop_b, at_a, at_b) of ``merged``: documents of more than ``lane`` A tokens are cut after tokens that end
    together, the first such after each ``lane`` tokens."""
    begin_a, begin_b, end_a, end_b = [], [], [], []
    for d in range(len(starts_a) - 1):
        a, b = int(starts_a[d]), int(starts_b[d])
        last_a, last_b = int(starts_a[d + 1]), int(starts_b[d + 1])
        while last_a - a > lane:
            k, found = a + lane - 1, None
            while k < last_a - 1 and found is None:
                some = ends_a[k : min(k + 64, last_a - 1)]
                at = b + np.searchsorted(ends_b[b:last_b], some)
                hit = np.flatnonzero((at < last_b) & (ends_b[np.minimum(at, last_b - 1)] == some))
                found = (k + int(hit[0]), int(at[hit[0]])) if len(hit) else None
                k += 64
            if found is None:
                break
            begin_a.append(a), begin_b.append(b), end_a.append(found[0] + 1), end_b.append(found[1] + 1)
            a, b = found[0] + 1, found[1] + 1
        begin_a.append(a), begin_b.append(b), end_a.append(last_a), end_b.append(last_b)
    return tuple(np.array(x, np.int64) for x in (end_a, end_b, begin_a, begin_b))


class Aligned:
    """The tokens of a batch of texts and their links: ids_a, ids_b (all documents behind one another), starts_a, starts_b
    (of each document), link_a, link_b (places of tokens that end together, in order)."""

    def __init__(self, some: list[str | None], both: Sides):
        raw_a, raw_b = both.encode([t or "" for t in some])
        a, b = both.a, both.b
        self.ids_a, self.ids_b = (np.frombuffer(b"".join(r), "<u4").astype(np.int64) for r in (raw_a, raw_b))
        self.starts_a, self.starts_b = (np.concatenate([[0], np.cumsum([len(x) // 4 for x in r])]).astype(np.int64) for r in (raw_a, raw_b))
        self.ends_a, self.ends_b = np.cumsum(a.sizes[self.ids_a]), np.cumsum(b.sizes[self.ids_b])  # a document's bytes are equal on both sides
        link_a, link_b = merged(self.ends_a, self.ends_b, *lanes(self.ends_a, self.ends_b, self.starts_a, self.starts_b))
        order = np.argsort(link_a, kind="stable")
        self.link_a, self.link_b = link_a[order], link_b[order]
        self.first_link = np.searchsorted(self.link_a, self.starts_a)

    def spelt_groups(self) -> Iterator[bytes]:
        """Of each document ``a1,a2|b1;a3|b2,b3``: decimal ids of the A and B tokens of each group, in order."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        last_a, last_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        last_a[self.link_a], last_b[self.link_b] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # links before a token
        before_b = np.concatenate([[0], self.link_b + 1])  # B tokens of all earlier groups
        place_a = np.arange(n_a) + before_b[group_a]
        place_b = np.arange(n_b) + self.link_a[group_b] + 1
        codes = np.empty(n_a + n_b, np.int64)
        codes[place_a] = self.ids_a * 4 + last_a
        codes[place_b] = self.ids_b * 4 + 2 + last_b
        spell = spellings(4 * max(int(self.ids_a.max(initial=0)), int(self.ids_b.max(initial=0))) + 4)
        starts = self.starts_a + self.starts_b
        for d in range(len(starts) - 1):
            yield b"".join(map(spell.__getitem__, codes[starts[d] : starts[d + 1]].tolist()))[:-1]

    def pairs(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each document the different id pairs (A id * 2**31 + B id) that it links, ascending, and how often."""
        key = self.ids_a[self.link_a] * _SHIFT + self.ids_b[self.link_b]
        number = np.repeat(np.arange(len(self.starts_a) - 1), np.diff(self.first_link))
        order = np.lexsort((key, number))
        key, number = key[order], number[order]
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (number[1:] != number[:-1])])) if len(key) else np.empty(0, np.int64)
        times = np.diff(np.append(first, len(key)))
        cuts = np.searchsorted(number[first], np.arange(1, len(self.starts_a) - 1))
        return list(zip(np.split(key[first], cuts), np.split(times, cuts)))


# ---- data sets
def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One stored row per document: doc_id, part, row (its number in the task that made it), n_a, n_b, n_groups, n_links,
    groups_sha256, and the different id pairs it links (``pairs``: A id * 2**31 + B id) with how often (``times``).

    A is a byte-level file, B a sentence-piece model. Texts that are null or empty, or that one of the tokenizers doesn't
    give back byte by byte, have no tokens: zeros, '' and no pairs. Repeated rows give a row each, a null doc_id stays null,
    an empty table gives no rows; other columns are ignored.
    """
    path_a, path_b = path_a or tokens.vocabulary(), path_b or tokens.vocabulary(PIECES)

    def run(frames):
        part, row = TaskContext.get().partitionId(), 0
        both = sides(path_a, path_b)
        for frame in bytes_at_most(frames, "text", BATCH):
            done, out = Aligned(frame["text"].tolist(), both), []
            for d, (doc_id, spelt, (pairs, times)) in enumerate(zip(frame["doc_id"], done.spelt_groups(), done.pairs())):
                n_a, n_b = (int(s[d + 1] - s[d]) for s in (done.starts_a, done.starts_b))
                links = int(times.sum())
                out.append((None if pd.isna(doc_id) else int(doc_id), part, row, n_a, n_b, links, links, hashlib.sha256(spelt).hexdigest() if n_a else "", pairs, times))
                row += 1
            yield pd.DataFrame(out, columns=["doc_id", "part", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]).astype({"doc_id": "Int64"})

    schema = "doc_id long, part int, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    return written(texts(docs).mapInPandas(run, schema), "alignments")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold each id pair, and whether no other pair of its B id is held by more. Counts
    are combined before the shuffle, so a common pair costs a row a task."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("k"))
    counts = written(each.groupBy("pair").agg(F.sum("k").alias("n")), "pair-counts").withColumn("b", F.col("pair").bitwiseAND(_SHIFT - 1))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return written(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def scored(aligned: DataFrame, counts: DataFrame, small: int = SMALL) -> DataFrame:
    """``aligned`` with n_best (links whose pair is its B id's most frequent, ties included) and count_sum (corpus counts
    summed over links)."""
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= small:
        table = counts.orderBy("pair").toPandas()  # at most ``small`` rows of 17 bytes
        shared = aligned.sparkSession.sparkContext.broadcast((table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64), table["best"].to_numpy(bool)))

        @F.pandas_udf("n_best long, count_sum long")
        def sums(pairs: pd.Series, times: pd.Series) -> pd.DataFrame:
            known, n, best = shared.value
            sizes = pairs.map(len).to_numpy(np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            at = np.searchsorted(known, np.concatenate([np.empty(0, np.int64), *pairs]).astype(np.int64))
            k = np.concatenate([np.empty(0, np.int64), *times]).astype(np.int64)
            total = [np.concatenate([[0], np.cumsum(x)]) for x in ((k * best[at], k * n[at]) if len(at) else (k, k))]
            return pd.DataFrame({c: t[starts[1:]] - t[starts[:-1]] for c, t in zip(("n_best", "count_sum"), total)})

        return aligned.withColumn("s", sums("pairs", "times")).select(*columns[:5], "s.n_best", "s.count_sum", "groups_sha256")
    each = aligned.select("part", "row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("part", "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("k"))
    # A common pair stands in nearly every document: its rows are dealt to several copies of its count.
    salts = 16
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = each.withColumn("salt", F.pmod(F.xxhash64("part", "row"), F.lit(salts)).cast("int")).join(salted, ["pair", "salt"])
    sums_ = found.groupBy("part", "row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum"))
    joined = aligned.drop("pairs", "times").join(sums_, ["part", "row"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")}).select(*columns)


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, small: int = SMALL) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; the cases of
    ``alignments`` hold."""
    aligned = alignments(docs, path_a, path_b)
    return scored(aligned, pair_counts(aligned), small)
