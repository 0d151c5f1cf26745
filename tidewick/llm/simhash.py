"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits. Correlated bits are grouped into parts, so that a common pattern meets in one part and the
others stay selective. Two fingerprints within ``radius`` bits agree, for any thresholds t_1..t_m that add up to
radius - m + 1, on some part i within t_i bits (t_i = -1: the part isn't probed). For every fingerprint a dynamic
programme picks the thresholds with the fewest probes and estimated candidates, from value counts over all
fingerprints. Probes meet stored parts by key; every meeting is verified over all 64 bits.

Keys that many fingerprints share would give all pairs of a group. Radius 2 has an exact way without pairs: two
fingerprints are within 2 bits if and only if some value lies within 1 bit of both, so fingerprints at such keys are
joined through those values (at most 65 fingerprints to a value, 65 values to a fingerprint).

The stage that drops near copies takes these links as candidates and holds them against the texts: Jaccard similarity
>= 0.8. Similar texts can lie too many bits apart for fingerprints (a passage put on or cut off moves up to ten of 64), so
an exact prefix-filter join adds those that they don't meet.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import bytes_at_most, texts, words
from tidewick.llm.components import labels
from tidewick.session import written

BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
PROBE = 10  # a probe costs as much as so many candidates
CROWD = 32  # fingerprints stored at one key before it is left to the exact way without pairs


# ---- fingerprints
def shingle_hashes(tokens: list[bytes], size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included; a shorter text is one run."""
    if not tokens:
        return np.empty(0, np.uint64)
    runs = zip(*(tokens[i:] for i in range(size))) if len(tokens) >= size else [tuple(tokens)]
    hashed = map(xxhash.xxh64_intdigest, map(b" ".join, runs), itertools.repeat(seed))
    return np.fromiter(hashed, np.uint64, max(1, len(tokens) - size + 1))


def fingerprint(text: str | None, size: int = 3) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; no words: zero. As a signed 64-bit number."""
    return majority(shingle_hashes(words(text), size))


def majority(hashes: np.ndarray) -> int:
    cells = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + 256 * np.arange(8)
    votes = np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ BYTE_BITS
    return int(np.packbits(2 * votes.ravel() > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fp (bigint) of every whole text."""

    def run(frames):
        for frame in bytes_at_most(frames, "text"):
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fp": [fingerprint(t, size) for t in frame["text"]]})

    return texts(docs).mapInPandas(run, "doc_id long, fp long")


# ---- parts and thresholds
def bit_counts(prints: DataFrame) -> np.ndarray:
    """How often bits i and j are set together, over all fingerprints."""

    def run(frames):
        total = np.zeros((64, 64))
        for frame in frames:
            bits = np.unpackbits(frame["fp"].to_numpy("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        yield pd.DataFrame({"cell": np.arange(4096), "n": total.ravel().astype(np.int64)})

    rows = prints.select("fp").mapInPandas(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(4096)
    for r in rows:
        out[r["cell"]] = r["n"]
    return out.reshape(64, 64)


def correlated_parts(counts: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Split the bits into parts of nearly equal width, each grown from the bits most correlated with it."""
    p = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((counts / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, out = list(range(64)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def value_of(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each fingerprint, side by side."""
    out = np.zeros(len(fp), np.int64)
    for place, bit in enumerate(bits):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


def pieces(bits: list[int], most: int = 11) -> list[list[int]]:
    """A part's bits in pieces small enough to count every value."""
    k = -(-len(bits) // most)
    return [bits[i::k] for i in range(k)]


def piece_counts(prints: DataFrame, parts: list[list[int]]) -> list[list[np.ndarray]]:
    """For each part and piece: how many fingerprints have each value."""
    cut = [pieces(bits) for bits in parts]

    def run(frames):
        total = [[np.zeros(1 << len(b), np.int64) for b in part] for part in cut]
        for frame in frames:
            fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for i, part in enumerate(cut):
                for j, b in enumerate(part):
                    total[i][j] += np.bincount(value_of(fp, b), minlength=1 << len(b))
        for i, part in enumerate(total):
            for j, counts in enumerate(part):
                at = np.flatnonzero(counts)
                yield pd.DataFrame({"part": i, "piece": j, "value": at, "n": counts[at]})

    rows = prints.select("fp").mapInPandas(run, "part int, piece int, value int, n long").groupBy("part", "piece", "value").agg(F.sum("n").alias("n")).collect()
    out = [[np.zeros(1 << len(b)) for b in part] for part in cut]
    for r in rows:
        out[r["part"]][r["piece"]][r["value"]] = r["n"]
    return out


def near_shares(counts: np.ndarray, reach: int) -> np.ndarray:
    """[d, v]: share of fingerprints whose piece differs from v in exactly d bits, d = 0..reach."""
    width = int(np.log2(len(counts)))
    by = np.zeros((reach + 1, len(counts)))
    by[0] = counts / max(counts.sum(), 1)
    at = np.arange(len(counts))
    for bit in range(width):  # one bit at a time: equal there, or differing there
        moved = by[:, at ^ (1 << bit)]
        by[1:] += moved[:-1]
    return by


def near_by(part: list[np.ndarray], values: list[np.ndarray], reach: int) -> np.ndarray:
    """[row, d]: estimated share within d bits of each value of a part, its pieces taken as independent."""
    out = None
    for shares, v in zip(part, values):
        own = shares[:, v]
        if out is None:
            out = own
            continue
        out = np.stack([sum(out[a] * own[d - a] for a in range(d + 1)) for d in range(reach + 1)])
    return np.cumsum(out, axis=0).T


def ball(bits: list[int], reach: int) -> np.ndarray:
    """XOR masks that change at most ``reach`` of the bits; none for -1."""
    masks = [sum(1 << b for b in c) for d in range(reach + 1) for c in itertools.combinations(bits, d)]
    return np.array(masks, np.uint64)


def thresholds(cost: np.ndarray, radius: int) -> np.ndarray:
    """[row, part]: thresholds of the least total cost that add up to radius - parts + 1.

    ``cost[row, part, t + 1]`` is the cost of threshold t = -1..radius.
    """
    n, parts, levels = cost.shape
    budget = radius + 1  # spent as t + 1 per part
    best = np.full((n, budget + 1), np.inf)
    best[:, 0] = 0
    chosen = []
    for i in range(parts):
        nxt, pick = np.full((n, budget + 1), np.inf), np.zeros((n, budget + 1), np.int8)
        for spent in range(budget + 1):
            for level in range(min(levels - 1, spent) + 1):
                total = best[:, spent - level] + cost[:, i, level]
                better = total < nxt[:, spent]
                nxt[better, spent], pick[better, spent] = total[better], level
        best = nxt
        chosen.append(pick)
    out, at, row = np.zeros((n, parts), np.int8), np.full(n, budget), np.arange(n)
    for i in reversed(range(parts)):
        level = chosen[i][row, at]
        out[:, i] = level - 1
        at = at - level
    return out


def part_number(n: int, radius: int) -> int:
    """Parts that make probes and evenly spread candidates fewest."""

    def cost(m: int) -> float:
        width, spare = 64 // m, radius + 1
        levels = [spare // m + (i < spare % m) - 1 for i in range(m)]
        sizes = [sum(_choose(width, d) for d in range(t + 1)) for t in levels]
        return sum(s * (PROBE + n / 2.0**width) for s in sizes)

    return min(range(1, 7), key=cost)


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def part_keys(prints: DataFrame, radius: int, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(stored, probes), both with part, key, id, fp: each fingerprint's parts as they are, and the part values it
    must look up so that every fingerprint within ``radius`` bits is met from it. ``prints`` has id and fp."""
    n = prints.count()
    m = parts or part_number(n, radius)
    groups = correlated_parts(bit_counts(prints), n, m)
    counts = piece_counts(prints, groups)
    shares = [[near_shares(c, radius) for c in part] for part in counts]
    masks = np.array([sum(1 << b for b in g) for g in groups], np.uint64)
    sizes = np.array([np.cumsum([_choose(len(g), d) for d in range(radius + 1)]) for g in groups], float)
    schema = "part int, key long, id long, fp long"

    def frame_of(part, keys, ids, fps):
        return pd.DataFrame({"part": np.full(len(ids), part, np.int32), "key": keys.view(np.int64), "id": ids, "fp": fps.view(np.int64)})

    def store(frames):
        for frame in frames:
            fp, ids = frame["fp"].to_numpy(np.int64).view(np.uint64), frame["id"].to_numpy(np.int64)
            for i in range(m):
                yield frame_of(i, fp & masks[i], ids, fp)

    def probe(frames):
        balls: dict[tuple[int, int], np.ndarray] = {}
        for frame in frames:
            fp, ids = frame["fp"].to_numpy(np.int64).view(np.uint64), frame["id"].to_numpy(np.int64)
            cost = np.zeros((len(fp), m, radius + 2))
            for i, g in enumerate(groups):
                values = [value_of(fp, b) for b in pieces(g)]
                cost[:, i, 1:] = n * near_by(shares[i], values, radius) + PROBE * sizes[i]
            levels = thresholds(cost, radius)
            for i, g in enumerate(groups):
                for t in np.unique(levels[:, i]):
                    if t < 0:
                        continue
                    moves = balls.setdefault((i, int(t)), ball(g, int(t)))
                    rows = np.flatnonzero(levels[:, i] == t)
                    for at in range(0, len(rows), step := max(1, 500_000 // len(moves))):
                        some = rows[at : at + step]
                        keys = ((fp[some] & masks[i])[:, None] ^ moves).ravel()
                        yield frame_of(i, keys, np.repeat(ids[some], len(moves)), np.repeat(fp[some], len(moves)))

    return prints.mapInPandas(store, schema), prints.mapInPandas(probe, schema)


# ---- links
def apart(a: str = "fp", b: str = "other_fp"):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_links(distinct: DataFrame, parts: int | None = None) -> DataFrame:
    """Edges (a, b) between fingerprints that differ in 1 or 2 bits, enough to connect all that are linked.

    ``distinct`` has one row per fingerprint in column fp.
    """
    prints = distinct.select(F.col("fp").alias("id"), "fp")
    stored, probes = part_keys(prints, 2, parts)
    stored, probes = written(stored, "simhash-stored"), written(probes, "simhash-probes")
    crowded = written(stored.groupBy("part", "key").count().where(F.col("count") > CROWD).select("part", "key"), "simhash-crowded")
    other = stored.select("part", "key", F.col("fp").alias("other_fp"))
    met = (
        probes.join(crowded, ["part", "key"], "left_anti").select("part", "key", "fp")
        .join(other.join(crowded, ["part", "key"], "left_anti"), ["part", "key"])
        .where((F.col("fp") != F.col("other_fp")) & (apart() <= 2))
        .select(F.col("fp").alias("a"), F.col("other_fp").alias("b"))
    )
    dense = probes.select("part", "key", "fp").union(stored.select("part", "key", "fp")).join(crowded, ["part", "key"], "left_semi").select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(64)), lambda i: F.when(i == 64, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    values = dense.select("fp", F.explode(flips).alias("value"))
    lead = values.groupBy("value").agg(F.min("fp").alias("lead"), F.count("*").alias("n")).where("n > 1").select("value", "lead")
    bridged = values.join(lead, "value").where(F.col("fp") != F.col("lead")).select(F.col("fp").alias("a"), F.col("lead").alias("b")).distinct()
    return met.union(bridged)


def _classes(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Stored: (doc_id, fp) of every document, and (fp, lowest), the smallest doc_id of each fingerprint."""
    prints = written(fingerprints(docs, size), "simhash-prints")
    return prints, written(prints.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "simhash-classes")


def near_pairs(docs: DataFrame, size: int = 3, parts: int | None = None) -> DataFrame:
    """Pairs (a < b) of documents whose fingerprints differ in at most two bits, enough to connect all that link: every
    document with the first of its fingerprint, and the firsts of fingerprints that ``near_links`` connects."""
    prints, classes = _classes(docs, size)
    ends = near_links(classes.select("fp"), parts)
    for end in ("a", "b"):
        ends = ends.join(classes.select(F.col("fp").alias(end), F.col("lowest").alias(f"{end}_id")), end)
    alike = prints.join(classes, "fp").select(F.col("doc_id").alias("a_id"), F.col("lowest").alias("b_id"))
    both = ends.select("a_id", "b_id").union(alike).where("a_id != b_id")
    return both.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def near_groups(docs: DataFrame, size: int = 3, parts: int | None = None) -> DataFrame:
    """One row per document: doc_id, fp (bigint), component_id.

    Documents link if their fingerprints differ in at most two bits; component_id is the smallest doc_id that can be
    reached, the document's own included. Texts without words have fingerprint zero and link like any other. Null
    texts count as empty; repeated rows share a fingerprint. A null doc_id gets a row but names no component unless
    nothing else is in it (then null). An empty table gives no rows; other columns are ignored.
    """
    prints, classes = _classes(docs, size)
    root = labels(near_links(classes.select("fp"), parts))
    placed = classes.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("label", "fp"))
    least = placed.where(F.col("label").isNotNull()).groupBy("root").agg(F.min("lowest").alias("least"))
    named = placed.join(least, "root", "left").select("fp", F.coalesce("least", "lowest").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


# ---- similar texts
SIMILAR = 0.8
PIVOTS = 3
SKETCH_BITS = 21  # cells that count shingles for the order of prefixes
SEEN_CELLS = 16  # cells to each prefix shingle that occurs twice, in the filter that leaves most others out
MOST_CELLS = 1 << 28  # of that filter; with fewer to a shingle more pass it, and the join after it leaves them out


class WordHashes(dict):
    """XXH64 of words, kept for as long as there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 42)
        return h


def shingles(tokens: list[bytes], hashes: WordHashes, size: int = 5) -> np.ndarray:
    """Distinct hashes of every run of ``size`` words; a shorter text is one run."""
    if not tokens:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    width, n = min(size, len(own)), max(1, len(own) - size + 1)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ own[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(32)))


def needed(share: float, n):
    """The least whole number of shingles that is at least ``share`` of n; rounding errors make it no larger."""
    return np.ceil(share * n - 1e-6)


def _cells(rows: DataFrame) -> np.ndarray:
    """Sum of the packed counts in (block, counts), one row per task and block."""

    def add(frame):
        total = sum(np.frombuffer(zlib.decompress(c), "<u4").astype(np.int64) for c in frame["counts"])
        return pd.DataFrame({"block": frame["block"].iloc[:1], "counts": [np.minimum(total, 2**32 - 1).astype("<u4").tobytes()]})

    got = rows.groupBy("block").applyInPandas(add, "block int, counts binary").collect()
    parts = {r["block"]: np.frombuffer(r["counts"], "<u4") for r in got}
    return np.concatenate([parts[k] for k in sorted(parts)]) if parts else np.empty(0, "<u4")


def _packed(counts: np.ndarray, blocks: int = 16) -> pd.DataFrame:
    return pd.DataFrame({"block": np.arange(blocks, dtype=np.int32), "counts": [zlib.compress(c.astype("<u4").tobytes(), 1) for c in np.split(counts, blocks)]})


def same_and_counts(docs: DataFrame, size: int) -> DataFrame:
    """Rows of two kinds: id and same, a 128-bit hash of a text's words; block and counts, how many texts of the task
    hold shingles of each cell."""

    def run(frames):
        hashes, counts = WordHashes(), np.zeros(1 << SKETCH_BITS, np.uint32)
        for frame in bytes_at_most(frames, "text", 4 << 20):
            same, one = [], np.uint32(1)
            for text in frame["text"]:  # one text's words at a time
                tokens = words(text)
                np.add.at(counts, (shingles(tokens, hashes, size) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), one)
                same.append(xxhash.xxh3_128_digest(b" ".join(tokens)))
            yield pd.DataFrame({"id": frame["doc_id"].to_numpy(), "same": same, "block": None, "counts": None}).astype({"id": "Int64", "block": "Int32"})
        if counts.any():
            packed = _packed(counts)
            yield pd.DataFrame({"id": None, "same": None, "block": packed["block"], "counts": packed["counts"]}).astype({"id": "Int64", "block": "Int32"})

    return docs.mapInPandas(run, "id long, same binary, block int, counts binary")


def prefixes(docs: DataFrame, counts: np.ndarray, similarity: float, size: int) -> DataFrame:
    """id, n, prefix: each text's number of shingles, and the rarest of them in an order that all texts share. Two texts
    of the wanted similarity have one in common at least, whatever the order; by rare ones first, few others do."""
    level = np.minimum(255, 8 * np.log2(1.0 + counts)).astype(np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def run(frames):
        hashes = WordHashes()
        for frame in bytes_at_most(frames, "text", 4 << 20):
            sizes, out = [], []
            for text in frame["text"]:
                x = shingles(words(text), hashes, size)
                order = np.argsort(shared.value[(x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                sizes.append(len(x))
                out.append(x[order[: len(x) - int(needed(similarity, len(x))) + 1]].view(np.int64))
            yield pd.DataFrame({"id": frame["doc_id"].to_numpy(), "n": np.array(sizes, np.int32), "prefix": out})

    return docs.mapInPandas(run, "id long, n int, prefix array<long>").where("n > 0")


def shared_tokens(stored: DataFrame) -> DataFrame:
    """key, id, n, at, held: the prefix shingles of ``prefixes`` that more than one row holds, their places in the
    prefix and how many rows hold them. Most others are left out before the join by a filter whose size follows the number
    of such shingles, so that the share of others that pass doesn't grow with the table."""
    keys = written(stored.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("held")).where("held > 1"), "similar-keys")
    return passed(stored, keys).join(keys, "key")


def passed(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """key, id, n, at of the prefix shingles among ``keys`` and of few others."""
    size = 128 * -(-min(MOST_CELLS, SEEN_CELLS * keys.count()) // 128)  # whole bytes in each of 16 blocks

    def cell_of(key):  # by the low bits: the order of prefixes favours some values of the high ones
        return (((key.view(np.uint64) & np.uint64(0xFFFFFFFF)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)

    def cells(frames):
        seen = np.zeros(size // 8, np.uint8)
        for frame in frames:
            cell = cell_of(frame["key"].to_numpy(np.int64))
            np.bitwise_or.at(seen, cell >> 3, np.left_shift(1, cell & 7).astype(np.uint8))
        if seen.any():
            yield pd.DataFrame({"block": np.arange(16, dtype=np.int32), "bits": [zlib.compress(c.tobytes(), 1) for c in np.split(seen, 16)]})

    def either(frame):
        total = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(c), np.uint8) for c in frame["bits"]])
        return pd.DataFrame({"block": frame["block"].iloc[:1], "bits": [total.tobytes()]})

    got = keys.select("key").mapInPandas(cells, "block int, bits binary").groupBy("block").applyInPandas(either, "block int, bits binary").collect()
    bits = b"".join(bytes(r["bits"]) for r in sorted(got, key=lambda r: r["block"]))
    shared = stored.sparkSession.sparkContext.broadcast(bits)

    def run(frames):
        seen = np.frombuffer(shared.value, np.uint8)
        for frame in frames:
            if not len(seen) or not len(frame):
                continue
            lengths = frame["prefix"].map(len).to_numpy()
            key = np.concatenate(frame["prefix"].to_list()).astype(np.int64)
            cell = cell_of(key)
            some = np.flatnonzero((seen[cell >> 3] >> (cell & 7)) & 1)
            row = np.repeat(np.arange(len(frame)), lengths)
            at = np.arange(len(key)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            yield pd.DataFrame({"key": key[some], "id": frame["id"].to_numpy()[row[some]], "n": frame["n"].to_numpy()[row[some]], "at": at[some].astype(np.int32)})

    return stored.mapInPandas(run, "key long, id long, n int, at int")


def shingle_sets(docs: DataFrame, size: int = 5) -> DataFrame:
    """id, shingles: the distinct hashes of each text's runs of ``size`` words, a shorter text being one run."""

    def run(frames):
        hashes = WordHashes()
        for frame in bytes_at_most(frames, "text"):
            yield pd.DataFrame({"id": frame["doc_id"], "shingles": [shingles(words(t), hashes, size).view(np.int64) for t in frame["text"]]})

    return docs.mapInPandas(run, "id long, shingles array<long>")


def similar_links(docs: DataFrame, similarity: float = SIMILAR, size: int = 5) -> DataFrame:
    """Edges (a, b) between documents whose sets of 5-word shingles have Jaccard similarity >= ``similarity``: enough of
    them to connect all that are.

    Candidates are the pairs that SimHash links (``near_pairs``) and, for similar texts that lie more bits apart, those of
    an exact prefix-filter join; both are held against the whole sets.

    The join: All shingles are put in one order, those of rarely hit cells of a count sketch first.
    Of n shingles a similar text shares at least ``similarity`` * n, so the first n - that + 1 hold one that both have
    among their first. The order decides only about the work; every similar pair meets in any order.

    Documents of the same words hang on the first of them, which alone is compared with others. At shingles that few
    prefixes hold, common ones are counted and pairs verified that can still reach the similarity. At a crowded one,
    documents are first held against pivots, those with the most crowded shingles, which lie in the middle of a group;
    the group then hangs together without its pairs. What is still in different components there is verified pair by
    pair afterwards, so that no link is lost.
    """
    rows = texts(docs).where("doc_id IS NOT NULL")
    made = written(same_and_counts(rows, size), "similar-same")
    prints, counts = made.where("same IS NOT NULL").select("id", "same"), _cells(made.where("block IS NOT NULL").select("block", "counts"))
    first = written(prints.groupBy("same").agg(F.min("id").alias("first")), "similar-first")
    copies = written(prints.join(first, "same").where(F.col("id") != F.col("first")).select(F.col("id").alias("a"), F.col("first").alias("b")), "similar-copies")
    if not len(counts):
        return copies
    gone = copies.join(first, F.col("a") == F.col("first"), "left_anti").select("a").distinct()
    firsts = rows.join(gone, F.col("doc_id") == F.col("a"), "left_anti")
    near = near_pairs(firsts)
    stored = written(prefixes(firsts, counts, similarity, size), "similar-prefixes")
    tokens = written(shared_tokens(stored), "similar-tokens")
    light, crowd = tokens.where(F.col("held") <= CROWD), tokens.where(F.col("held") > CROWD)
    spare = crowd.groupBy("id").agg(F.count("*").alias("spare"))
    pairs = written(near.union(_met(light, spare, similarity)).distinct(), "similar-pairs")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(crowd.select("id")).distinct()
    involved = written(involved, "similar-ids")
    sets = written(shingle_sets(rows.join(involved, rows["doc_id"] == involved["id"], "left_semi"), size), "similar-sets")
    edges = written(_verified(pairs, sets, similarity).union(copies), "similar-edges")
    if not crowd.take(1):
        return edges
    # Pivots: in each of some shares of a crowded key's documents, the one with the most crowded shingles.
    packed = written(crowd.join(spare, "id"), "similar-crowd")
    best = packed.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(PIVOTS))).agg(F.max(F.struct("spare", "id", "n", "at")).alias("p"))
    pivots = best.select("key", F.col("p.id").alias("other"), F.col("p.n").alias("other_n"), F.col("p.at").alias("other_at"))
    edges = written(edges.union(_verified(_first_met(packed.join(pivots, "key"), similarity), sets, similarity)), "similar-edges")
    at = written(labels(edges), "similar-labels")
    marked = packed.join(at, packed["id"] == at["node"], "left").select("key", "id", "n", "at", F.coalesce("label", "id").alias("la"))
    # Keys whose documents all hang together need no pairs.
    divided = marked.groupBy("key").agg(F.min("la").alias("lo"), F.max("la").alias("hi")).where("lo < hi").select("key")
    marked = written(marked.join(divided, "key", "left_semi"), "similar-divided")
    other = marked.select("key", F.col("id").alias("other"), F.col("n").alias("other_n"), F.col("at").alias("other_at"), F.col("la").alias("lb"))
    rest = marked.join(other, (marked["key"] == other["key"]) & (F.col("la") < F.col("lb")) & _reachable(similarity))
    return edges.union(_verified(_first_met(rest, similarity), sets, similarity))


def _common(similarity: float, n, m):
    """Shingles that sets of n and m must share."""
    return F.ceil((n + m) * F.lit(similarity / (1 + similarity)) - F.lit(1e-6))


def _reachable(similarity: float):
    """If the first shingle that two texts share is this one, those from there on are enough."""
    n, m = F.col("n"), F.col("other_n")
    return F.least(n - F.col("at"), m - F.col("other_at")) >= _common(similarity, n, m)


def _first_met(met: DataFrame, similarity: float) -> DataFrame:
    some = met.where((F.col("id") != F.col("other")) & _reachable(similarity))
    return some.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _met(light: DataFrame, spare: DataFrame, similarity: float) -> DataFrame:
    """Pairs that share a key and can reach the similarity by the keys they share, the crowded ones that they may share
    besides (``spare``), and what comes after both."""
    other = light.select("key", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("at").alias("bt"))
    mine = light.select("key", F.col("id").alias("a"), F.col("n").alias("na"), F.col("at").alias("ta"))
    fits = F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(similarity) - F.lit(1e-6)
    met = mine.join(other, (mine["key"] == other["key"]) & (F.col("a") < F.col("b")) & fits)
    seen = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("k"), F.max("ta").alias("ta"), F.max("bt").alias("bt"))
    sa, sb = spare.select(F.col("id").alias("a"), F.col("spare").alias("sa")), spare.select(F.col("id").alias("b"), F.col("spare").alias("sb"))
    seen = seen.join(sa, "a", "left").join(sb, "b", "left")
    more = F.least(F.coalesce("sa", F.lit(0)), F.coalesce("sb", F.lit(0)))
    after = F.least(F.col("na") - 1 - F.col("ta"), F.col("nb") - 1 - F.col("bt"))
    return seen.where(F.col("k") + more + after >= _common(similarity, F.col("na"), F.col("nb"))).select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    x, y = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    share = both / F.greatest(F.lit(1), F.size("x") + F.size("y") - both)
    return pairs.join(x, "a").join(y, "b").where(share >= similarity).select("a", "b")


def drop_similar(docs: DataFrame, similarity: float = SIMILAR) -> DataFrame:
    """Rows of ``docs``, with their columns: of each group of similar documents the one with the smallest doc_id.

    SimHash groups and texts that its fingerprints can't meet are compared by their shingles (``similar_links``).
    doc_id names a document: rows that repeat one stay or go together. Rows without doc_id stay. Texts without words
    are similar to each other only. An empty table stays empty.
    """
    at = labels(similar_links(docs, similarity))
    gone = written(at.where("node != label").select(F.col("node").alias("_gone")), "similar-gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
