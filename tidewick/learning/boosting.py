"""Gradient-boosted trees on histograms, with missing values of their own.

Inputs are binned once, to a byte each, by quantiles that Spark computes; a missing value (NULL or NaN) has a bin of its own.
A level of a tree costs one aggregate: every block of rows adds up gradients, curvatures and counts per open node, input
and bin, and only these sums (of a size that depends on nodes, inputs and bins) reach the driver, which picks the splits.
For each split both sides are tried for missing values. Leaves are second-order steps.

Rows stay in blocks of at most about ``BLOCK_ROWS`` rows on the cluster. Each block carries its scores, which a finished tree
moves on; every ``CUT`` trees the blocks are checkpointed to the shared folder, so a lost executor costs at most so many
trees' work on its blocks. Rows that fit one block need no exchange of sums: its task adds up and splits by itself.

A trained forest is a handful of flat arrays over complete trees. Spark applies them by array expressions in one
projection, without Python.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewick.session import shared_dir, written

BINS = 64  # bins of known values; the next number is the missing bin
DEPTH = 5
LEAST_ROWS = 20  # rows of a leaf
LEAST_CURVATURE = 1e-3
BLOCK_ROWS = 250_000
CUT = 25  # trees between checkpoints


@dataclass
class Forest:
    """Complete trees of ``depth`` levels: node k's children are 2k+1 and 2k+2. ``feature``, ``cut`` and ``missing_right``
    have a row per tree and a column per inner node, ``value`` a column per leaf. A node that isn't split sends all rows
    left (an infinite cut)."""

    inputs: list[str]
    depth: int
    base: float
    logistic: bool
    feature: np.ndarray
    cut: np.ndarray
    missing_right: np.ndarray
    value: np.ndarray

    # ---- applying
    def raw(self) -> Column:
        """The sum of the trees' leaves for a row's inputs."""
        inner = 2**self.depth - 1
        x = F.array(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in self.inputs])
        feature, cut = _array(self.feature, "int"), _array(self.cut, "double")
        missing, value = _array(self.missing_right.astype(int), "int"), _array(self.value, "double")

        def leaf(tree: Column) -> Column:
            def step(node: Column, _: Column) -> Column:
                at = tree * F.lit(inner) + node
                right = F.coalesce((F.get(x, F.get(feature, at)) > F.get(cut, at)).cast("int"), F.get(missing, at))
                return node * F.lit(2) + F.lit(1) + right

            last = F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(0), step)
            return F.get(value, tree * F.lit(inner + 1) + last - F.lit(inner))

        if not len(self.feature):
            return F.lit(self.base)
        return F.aggregate(F.sequence(F.lit(0), F.lit(len(self.feature) - 1)), F.lit(self.base), lambda total, tree: total + leaf(tree))

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``prediction``; for classes 0 and 1 also ``prob``, the probability of 1."""
        if not self.logistic:
            return rows.withColumn("prediction", self.raw())
        prob = rows.withColumn("prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-self.raw())))
        return prob.withColumn("prediction", (F.col("prob") > 0.5).cast("double"))

    # ---- storing
    def save(self, spark: SparkSession, path: str) -> None:
        row = (self.inputs, self.depth, self.base, self.logistic, *[a.ravel().tolist() for a in (self.feature, self.cut, self.missing_right.astype(int), self.value)])
        spark.createDataFrame([row], "inputs array<string>, depth int, base double, logistic boolean, feature array<int>, cut array<double>, missing_right array<int>, value array<double>").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Forest:
    r = spark.read.parquet(path).first()
    inner = 2 ** r["depth"] - 1
    shaped = lambda name, kind, width: np.array(r[name], kind).reshape(-1, width)
    return Forest(list(r["inputs"]), r["depth"], r["base"], r["logistic"], shaped("feature", int, inner), shaped("cut", float, inner),
                  shaped("missing_right", bool, inner), shaped("value", float, inner + 1))


def _array(values: np.ndarray, kind: str) -> Column:
    """A constant array, as text that the optimiser folds once."""
    spelt = ",".join("Infinity" if v == np.inf else repr(v) for v in values.ravel().tolist())
    return F.split(F.lit(spelt), ",").cast(f"array<{kind}>")


# ---- rows in blocks
@dataclass
class Block:
    bins: np.ndarray  # a byte per row and input
    y: np.ndarray
    weight: np.ndarray
    score: np.ndarray

    def slopes(self, logistic: bool) -> tuple[np.ndarray, np.ndarray]:
        """First and second derivative of the weighted loss at the score."""
        if not logistic:
            return self.weight * (self.score - self.y), self.weight
        p = 1 / (1 + np.exp(-self.score))
        return self.weight * (p - self.y), self.weight * p * (1 - p)

    def sums(self, tree: "Tree", logistic: bool) -> np.ndarray:
        """(node, input, bin, of gradients, curvatures and rows) over the open level of a growing tree."""
        width, inputs = 2**tree.level, self.bins.shape[1]
        node = tree.walk(self.bins, tree.level) - (width - 1)
        out = np.zeros((3, width, inputs, BINS + 1))
        for k, w in enumerate((*self.slopes(logistic), None)):
            for f in range(inputs):
                out[k, :, f] = np.bincount(node * (BINS + 1) + self.bins[:, f], weights=w, minlength=width * (BINS + 1)).reshape(width, -1)
        return np.moveaxis(out, 0, -1)

    def moved(self, tree: "Tree", value: np.ndarray) -> "Block":
        leaf = tree.walk(self.bins, tree.depth) - (2**tree.depth - 1)
        return Block(self.bins, self.y, self.weight, self.score + value[leaf])


class Tree:
    """A tree over bins while it grows: a row of node k goes right if its bin is above ``bin[k]``, and if it misses the
    value as ``missing_right[k]`` says."""

    def __init__(self, depth: int):
        inner = 2**depth - 1
        self.depth, self.level = depth, 0
        self.feature, self.bin, self.missing_right = np.zeros(inner, int), np.full(inner, BINS), np.zeros(inner, bool)
        self.split = np.zeros(inner, bool)

    def walk(self, bins: np.ndarray, levels: int) -> np.ndarray:
        node, rows = np.zeros(len(bins), int), np.arange(len(bins))
        for _ in range(levels):
            x = bins[rows, self.feature[node]]
            right = np.where(x == BINS, self.missing_right[node], x > self.bin[node])
            node = 2 * node + 1 + right
        return node

    def grow(self, sums: np.ndarray, penalty: float) -> bool:
        """Split the nodes of the open level by their sums and set the steps of their children (a node that isn't split
        hands its own on); False if none could be split."""
        first, width = 2**self.level - 1, 2**self.level
        if not self.level:
            self.step = _step(sums[0, 0].sum(axis=0)[None], penalty)
        steps = self.step.repeat(2)
        for k in range(width):
            found = best_split(sums[k], penalty)
            if found:
                self.split[first + k] = True
                self.feature[first + k], self.bin[first + k], self.missing_right[first + k] = found[1:4]
                steps[2 * k : 2 * k + 2] = _step(np.stack(found[4:]), penalty)
        self.step, self.level = steps, self.level + 1
        return bool(self.split[first : first + width].any())

    def closed(self) -> np.ndarray:
        """The steps of all leaves of the full depth; the tree grows no more."""
        steps = self.step.repeat(2 ** (self.depth - self.level))
        self.level = self.depth
        return steps


def _step(sums: np.ndarray, penalty: float) -> np.ndarray:
    return -sums[:, 0] / np.maximum(sums[:, 1] + penalty, 1e-12)


def best_split(sums: np.ndarray, penalty: float) -> tuple[float, int, int, bool, np.ndarray, np.ndarray] | None:
    """(gain, input, last bin to the left, whether missing values go right, sums of the left and of the right side) of the
    best split of one node, the first of equals; None if no split gains or leaves both sides enough rows. ``sums``:
    (input, bin, 3)."""
    total = sums[0].sum(axis=0)
    known = np.cumsum(sums[:, :BINS], axis=1)  # to the left of each cut; the last cut parts known from missing
    left = np.stack([known + sums[:, BINS:], known], axis=2)  # missing to the left, missing to the right
    right = total - left
    gain = _worth(left, penalty) + _worth(right, penalty) - _worth(total, penalty)
    fair = (np.minimum(left[..., 2], right[..., 2]) >= LEAST_ROWS) & (np.minimum(left[..., 1], right[..., 1]) >= LEAST_CURVATURE)
    gain = np.where(fair, gain, -np.inf)
    at = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[at]), int(at[0]), int(at[1]), bool(at[2]), left[at], right[at]) if gain[at] > 1e-12 else None


def _worth(sums: np.ndarray, penalty: float) -> np.ndarray:
    return sums[..., 0] ** 2 / np.maximum(sums[..., 1] + penalty, 1e-300)


# ---- training
def cuts_of(rows: DataFrame, inputs: list[str]) -> list[np.ndarray]:
    """Up to ``BINS`` - 1 ascending cuts of each input; a value equal to a cut lies below it."""
    shares = [k / BINS for k in range(1, BINS)]
    known = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in inputs]
    row = rows.agg(*[F.percentile_approx(x, shares, 10_000).alias(f"x{k}") for k, x in enumerate(known)]).first()
    return [np.unique(np.array(row[f"x{k}"] or [], float)) for k in range(len(inputs))]


def _blocks(rows: DataFrame, inputs: list[str], label: str, weight: str | None, cuts: list[np.ndarray], base: float):
    def binned(frames):
        for frame in frames:
            bins = np.empty((len(frame), len(inputs)), np.uint8)
            for k, (c, cut) in enumerate(zip(inputs, cuts)):
                x = frame[c].to_numpy(float)
                bins[:, k] = np.where(np.isnan(x), BINS, np.searchsorted(cut, x, "left"))
            w = frame["_w"].to_numpy(float)
            yield pd.DataFrame({"block": [pickle.dumps((bins, frame["_y"].to_numpy(float), w))]})

    def joined(parts):
        some = [pickle.loads(bytes(r["block"])) for r in parts]
        if some:
            bins, y, w = (np.concatenate(x) for x in zip(*some))
            yield Block(bins, y, w, np.full(len(y), base))

    plain = rows.select(*[F.col(c).cast("double").alias(c) for c in inputs], F.col(label).cast("double").alias("_y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w"))
    parts = max(1, -(-rows.count() // BLOCK_ROWS))
    return plain.repartition(parts).mapInPandas(binned, "block binary").rdd.mapPartitions(joined)


def train(rows: DataFrame, inputs: list[str], label: str, rounds: int, rate: float, logistic: bool = False, weight: str | None = None,
          depth: int = DEPTH, penalty: float = 0.0) -> Forest:
    """``rounds`` trees for squared error, or for classes 0 and 1 (``logistic``), of rows whose label is known.

    Rows without a label are left out. Without rows, or where no split is allowed, trees are single leaves.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    rows = written(rows.where(F.col(label).isNotNull()).select(*dict.fromkeys([*inputs, label, *([weight] if weight else [])])), "train")
    w = F.col(weight) if weight else F.lit(1.0)
    total, mass = rows.agg(F.sum(F.col(label) * w), F.sum(w)).first()
    mean = (total / mass) if mass else 0.0
    share = min(max(mean, 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share))) if logistic else float(mean)
    cuts = cuts_of(rows, inputs)
    blocks = _blocks(rows, inputs, label, weight, cuts, base).persist(StorageLevel.MEMORY_AND_DISK)
    parts = blocks.getNumPartitions()
    inner = 2**depth - 1
    forest = Forest(list(inputs), depth, base, logistic, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner), bool), np.zeros((0, inner + 1)))
    grown: list[tuple[np.ndarray, ...]] = []
    if parts == 1 and mass:  # the sums of the only block are those of all rows: its task need not hand them over
        trees = blocks.map(lambda b: _grown(b, rounds, rate, depth, penalty, logistic)).first()
        grown = [(t.feature, _real_cuts(t, cuts), t.missing_right, v) for t, v in trees]
        rounds = 0
    before = None
    for k in range(rounds if mass else 0):
        tree = Tree(depth)
        while tree.level < depth:
            sums = _added(blocks.map(lambda b, tree=tree: b.sums(tree, logistic)), parts)
            if before is not None:  # the blocks with the last tree's scores are stored by now
                before.unpersist()
                before = None
            if not tree.grow(sums, penalty):
                break
        value = tree.closed() * rate
        grown.append((tree.feature, _real_cuts(tree, cuts), tree.missing_right, value))
        before, blocks = blocks, blocks.map(lambda b, tree=tree, value=value: b.moved(tree, value)).persist(StorageLevel.MEMORY_AND_DISK)
        if (k + 1) % CUT == 0:
            blocks.checkpoint()
    if before is not None:
        before.unpersist()
    blocks.unpersist()
    if grown:
        forest.feature, forest.cut, forest.missing_right, forest.value = (np.stack(x) for x in zip(*grown))
    return forest


def _grown(block: Block, rounds: int, rate: float, depth: int, penalty: float, logistic: bool) -> list[tuple[Tree, np.ndarray]]:
    """All trees from one block that holds every row (at most ``BLOCK_ROWS``)."""
    out = []
    for _ in range(rounds):
        tree = Tree(depth)
        while tree.level < depth and tree.grow(block.sums(tree, logistic), penalty):
            pass
        value = tree.closed() * rate
        block = block.moved(tree, value)
        out.append((tree, value))
    return out


def _added(sums, parts: int) -> np.ndarray:
    return sums.treeReduce(np.add) if parts > 16 else sums.reduce(np.add)


def _real_cuts(tree: Tree, cuts: list[np.ndarray]) -> np.ndarray:
    """Cuts of values for those of bins; a bin after the last cut takes all known values."""
    out = np.full(len(tree.feature), np.inf)
    for k in np.flatnonzero(tree.split):
        own = cuts[tree.feature[k]]
        out[k] = own[tree.bin[k]] if tree.bin[k] < len(own) else np.inf
    return out
