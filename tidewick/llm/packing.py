"""Packing pieces of documents into sequences by length patterns.

The histogram of piece lengths, in bins of a few tokens, is all that planning needs. Every pattern of at most
``depth`` bins that fills a sequence is a column; non-negative least squares finds how often each pattern is repeated
so that together they use up the histogram. Counts are rounded down and trimmed until no bin is overdrawn, and patterns
are filled with the longest pieces that fit. What is left is packed by best fit, longest first, also over counts of
lengths. Plans are run-length coded (pattern, repeats), so their size depends on the sequence length and not on the
number of documents. Each piece has a rank within its length; rank and plan give its sequence by arithmetic, without
collecting or joining pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewick.llm import tokens
from tidewick.llm.common import bytes_at_most, texts
from tidewick.session import written

ROOM = 2048
GRAIN = 8  # tokens to a bin
DEPTH = 3  # pieces to a pattern


# ---- pieces
def cut(n: int, room: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole if they fit; else full pieces, of which the first may be shorter."""
    if n <= room:
        return [(0, n)]
    first = n % room
    out = [(0, first)] if first else []
    return out + [(at, room) for at in range(first, n, room)]


def pieces(docs: DataFrame, room: int = ROOM, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents as stored rows: doc_id, piece, start, length, ids_crc32, part, place (and ids).

    ``place`` counts pieces of the same length before this one in ``part``, the task that made both.
    """
    path = vocabulary or tokens.vocabulary()

    def run(frames):
        part, seen = TaskContext.get().partitionId(), np.zeros(room + 1, np.int64)
        for frame in bytes_at_most(frames, "text", 2 << 20):
            rows = []
            for doc_id, ids in zip(frame["doc_id"], tokens.document_ids(frame["text"].tolist(), path)):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                for k, (start, n) in enumerate(cut(len(ids) // 4, room)):
                    raw = ids[4 * start : 4 * (start + n)]
                    rows.append((doc_id, k, start, n, zlib.crc32(raw), part, int(seen[n]), np.frombuffer(raw, "<u4").astype(np.int32) if with_ids else None))
                    seen[n] += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "place", "ids"]).astype({"doc_id": "Int64"})
            yield out if with_ids else out.drop(columns="ids")

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long" + ", ids array<int>" * with_ids
    return written(texts(docs).mapInPandas(run, schema), "pieces")


# ---- planning, over counts of lengths
def patterns(bins: int, depth: int) -> np.ndarray:
    """Every way to write ``bins`` as a sum of at most ``depth`` bin sizes, one column each: how often a bin occurs."""
    found: list[list[int]] = []

    def grow(left: int, most: int, so_far: list[int]) -> None:
        if left == 0:
            found.append(so_far)
        elif len(so_far) < depth:
            for size in range(min(left, most), 0, -1):
                if size * (depth - len(so_far)) >= left:
                    grow(left - size, size, so_far + [size])

    grow(bins, bins, [])
    out = np.zeros((bins + 1, len(found)), np.float64)
    for k, sizes in enumerate(found):
        for size in sizes:
            out[size, k] += 1
    return out


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 600) -> np.ndarray:
    """x >= 0 of least ||a x - b||, by the active-set method: take in the column with the steepest descent, solve on
    the columns taken in, and step back to the border where one would turn negative."""
    x, inside = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    floor = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(steps):
        slope = a.T @ (b - a @ x)
        slope[inside] = -np.inf
        if slope.max(initial=-np.inf) <= floor:
            break
        inside[int(slope.argmax())] = True
        while inside.any():
            on = np.flatnonzero(inside)
            want, held = np.linalg.lstsq(a[:, on], b, rcond=None)[0], x[on]
            low = want <= 0
            if not low.any():
                x[on] = want
                break
            step = (held[low] / np.maximum(held[low] - want[low], 1e-300)).min()
            x[on] = held + step * (want - held)
            gone = on[low & (x[on] <= 1e-12)]
            x[gone], inside[gone] = 0, False
    return x


def fitted(bin_counts: np.ndarray, depth: int = DEPTH) -> list[tuple[list[tuple[int, int]], int]]:
    """([(bin, times)], repeats) that together draw at most ``bin_counts`` pieces from each bin (bins 1..n)."""
    a = patterns(len(bin_counts) - 1, depth)
    total = max(1.0, float(bin_counts.sum()))
    x = np.floor(nnls(a[1:], bin_counts[1:] / total) * total + 1e-6).astype(np.int64)
    used = a.astype(np.int64)
    over = used @ x - bin_counts
    for size in range(len(bin_counts) - 1, 0, -1):
        for k in np.flatnonzero((used[size] > 0) & (x > 0)):
            if over[size] <= 0:
                break
            less = min(int(x[k]), -(-int(over[size]) // int(used[size, k])))
            x[k] -= less
            over = over - less * used[:, k]
    return [([(int(s), int(used[s, k])) for s in np.flatnonzero(used[:, k])], int(x[k])) for k in np.flatnonzero(x)]


def best_fit(lengths: dict[int, int], room: int) -> list[tuple[list[tuple[int, int]], int]]:
    """([(length, times)], repeats) that place all of ``lengths`` (length: count), longest first, each into the
    fullest open sequences that still take it. Works on counts: sequences filled alike are one entry."""
    open_: dict[int, list[list]] = {}  # room left: [[contents, repeats]]
    spaces: list[int] = []

    def put(space: int, contents: list, repeats: int) -> None:
        if space not in open_:
            open_[space] = []
            insort(spaces, space)
        open_[space].append([contents, repeats])

    for size in sorted(lengths, reverse=True):
        left = lengths[size]
        while left:
            at = bisect_left(spaces, size)
            if at == len(spaces):
                each = min(room // size, left)
                full, rest = divmod(left, each)
                put(room - each * size, [(size, each)], full)
                if rest:
                    put(room - rest * size, [(size, rest)], 1)
                break
            space = spaces[at]
            entry = open_[space][-1]
            each = min(space // size, left)
            take = min(entry[1], left // each)
            entry[1] -= take
            contents = entry[0]
            if not entry[1]:
                open_[space].pop()
                if not open_[space]:
                    del open_[space]
                    spaces.pop(at)
            put(space - each * size, contents + [(size, each)], take)
            left -= take * each
    return [(contents, repeats) for entries in open_.values() for contents, repeats in entries]


def drawn(plan: list[tuple[list[tuple[int, int]], int]], free: np.ndarray, room: int, grain: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns of bins as patterns of lengths, taken off ``free`` (count of each length): all but the last piece are the
    longest left in their bins, the last is the longest left that still fits, in its bin or not. Repeats that find no
    pieces are left out."""
    out = []
    for contents, repeats in plan:
        bins = sorted((s for s, times in contents for _ in range(times)), reverse=True)
        while repeats:
            lengths: list[int] = []
            for k, size in enumerate(bins):
                left = room - sum(lengths)
                most, least = (min(size * grain, left), (size - 1) * grain) if k + 1 < len(bins) else (left, 0)
                usable = free[least + 1 : most + 1].copy()
                for n in lengths:
                    if least < n <= most:
                        usable[n - least - 1] -= 1
                at = np.flatnonzero(usable > 0)
                if not len(at):
                    break
                lengths.append(least + 1 + int(at[-1]))
            if len(lengths) < len(bins):
                break
            each = {n: lengths.count(n) for n in lengths}
            take = min(repeats, *(int(free[n]) // times for n, times in each.items()))
            for n, times in each.items():
                free[n] -= times * take
            out.append((list(each.items()), take))
            repeats -= take
    return out


def planned(counts: np.ndarray, room: int, grain: int = GRAIN, depth: int = DEPTH) -> list[tuple[list[tuple[int, int]], int]]:
    """([(length, times)], repeats) that place every piece: fitted patterns first, the residual by best fit. Where that
    takes more sequences than best fit alone would, patterns are repeated half as often, and so on."""
    all_ = {n: int(counts[n]) for n in np.flatnonzero(counts)}
    alone = best_fit(all_, room)
    if room % grain:  # the last bin's rounded-up size may not exceed the room
        return alone
    least = sum(r for _, r in alone)
    in_bins = np.bincount(-(-np.arange(room + 1) // grain), weights=counts, minlength=room // grain + 1).astype(np.int64)
    plan = fitted(in_bins, depth)
    while plan:
        free = counts.copy()
        some = drawn(plan, free, room, grain)
        some += best_fit({n: int(free[n]) for n in np.flatnonzero(free)}, room)
        if sum(r for _, r in some) <= least:
            return some
        plan = [(contents, repeats // 2) for contents, repeats in plan if repeats > 1]
    return alone


class Plan:
    """Runs of ranks of each length: the k-th piece of a run goes to sequence base + k // times."""

    def __init__(self, counts: np.ndarray, room: int, grain: int = GRAIN, depth: int = DEPTH):
        """``counts[n]`` pieces have n ids."""
        self.sequences = 0
        runs: dict[int, list[tuple[int, int, int]]] = {}  # length: (first rank, base, times)
        next_rank = np.zeros(room + 1, np.int64)
        for contents, repeats in planned(np.asarray(counts, np.int64), room, grain, depth):
            for n, times in contents:
                runs.setdefault(n, []).append((int(next_rank[n]), self.sequences * times, times))
                next_rank[n] += times * repeats
            self.sequences += repeats
        flat = [(n, *run) for n, some in runs.items() for run in sorted(some)]
        self.lengths, self.ranks, self.slots, self.times = (np.array(c, np.int64) for c in zip(*sorted(flat))) if flat else [np.empty(0, np.int64)] * 4

    def sequence(self, lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(_joint(self.lengths, self.ranks), _joint(lengths, ranks), side="right") - 1
        return (self.slots[at] + ranks - self.ranks[at]) // self.times[at]


def _joint(lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    return (np.asarray(lengths, np.int64) << 44) | np.asarray(ranks, np.int64)


# ---- packing
def pack(parts: DataFrame, room: int = ROOM, grain: int = GRAIN, depth: int = DEPTH) -> DataFrame:
    """``parts`` (as from ``pieces``) with sequence_id and offset; every piece is placed exactly once.

    Within a sequence longer pieces come first, then by doc_id (nulls first), piece, part and place.
    """
    local = parts.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part")
    firsts = written(local.withColumn("first", F.sum("n").over(before) - F.col("n")), "piece-ranks")
    counts = np.zeros(room + 1, np.int64)
    for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length, at most ``room``
        counts[r["length"]] = r["n"]
    plan = Plan(counts, room, grain, depth)

    @F.pandas_udf("long")
    def sequence(length: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(plan.sequence(length.to_numpy(), rank.to_numpy()))

    # Both sides grow with the number of tasks: merged by key, never broadcast.
    ranked = parts.join(firsts.select("length", "part", "first").hint("merge"), ["length", "part"])
    placed = ranked.withColumn("sequence_id", sequence("length", F.col("first") + F.col("place")))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "part", "place")
    return placed.withColumn("offset", F.sum("length").over(inside) - F.col("length")).drop("part", "place", "first")


def packed_documents(docs: DataFrame, room: int = ROOM, vocabulary: str | None = None, grain: int = GRAIN, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for).

    Null texts are empty (one end id). Repeated rows are packed each; a null doc_id stays null. An empty table gives no
    rows; other columns are ignored.
    """
    got = pack(pieces(docs, room, vocabulary, with_ids), room, grain)
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)
