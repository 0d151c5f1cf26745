"""Severity of toxic texts by cumulative-link ordinal regression.

P(grade <= k | x) = sigmoid(t_k - w.x): one weight vector for all grades, ordered thresholds t_1 < t_2 < .... The
expected severity is the sum of P(grade >= k). Features are words and their beginnings (log of one plus the
count per thousand words), which lets inflected forms share a weight. Which of them are used is decided on the labelled sample: those whose share
of documents differs significantly between clean and graded texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import bytes_at_most, texts
from tidewick.session import written

SAMPLE = 20_000  # labelled documents that the model is fitted on, by the smallest hash of doc_id
FEATURES = 4096
SIGNIFICANT = 4.5  # standard errors between the classes
BEGINNINGS = (3, 5)
GRADES = 3
PER = 1000  # counts are per so many words
CUT = 0.4  # expected severity from which a document counts as toxic
REMEMBERED = 200_000
_WORD = re.compile(r"\w+")


def features_of(word: str) -> list[str]:
    return ["=" + word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def counts_of(text: str) -> Counter:
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for f in features_of(word):
            out[f] += n
    return out


# ---- the model
class Ordinal:
    """Thresholds and shared weights; ``fit`` minimises the penalised negative log-likelihood by Adam steps."""

    def __init__(self, names: list[str], grades: int):
        self.names, self.grades = names, grades
        self.weights, self.thresholds = np.zeros(len(names)), np.full(grades, 30.0)

    def fit(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, penalty: float = 2e-5, steps: int = 1500) -> "Ordinal":
        n, k = len(y), self.grades
        share = np.array([(np.sum(y <= j) + 0.5) / (n + 1) for j in range(k)])
        start = np.log(share / (1 - share))
        gaps = np.log(np.maximum(np.diff(start), 1e-2))
        theta = np.concatenate([self.weights, start[:1], gaps])
        m, v, f = np.zeros_like(theta), np.zeros_like(theta), len(self.names)
        for t in range(1, steps + 1):
            w, cuts = theta[:f], self._cuts(theta[f:])
            z = np.bincount(rows, values * w[cols], minlength=n)
            bounds = np.concatenate([[-np.inf], cuts, [np.inf]])
            # d log p / d upper = sigmoid(-upper) + r and d log p / d lower = -(sigmoid(lower) + r): finite however
            # improbable the grade is.
            up, low = _sigmoid(z - bounds[y + 1]), _sigmoid(bounds[y] - z)
            r = 1 / np.expm1(np.minimum(bounds[y + 1] - bounds[y], 700.0))
            du, dl = up + r, low + r
            grad = np.zeros_like(theta)
            grad[:f] = np.bincount(cols, values * (du - dl)[rows], minlength=f) / n + penalty * w
            by_cut = np.array([-(du[y == j].sum() - dl[y == j + 1].sum()) for j in range(k)]) / n
            grad[f] = by_cut.sum()
            for j in range(1, k):
                grad[f + j] = by_cut[j:].sum() * math.exp(theta[f + j])
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            theta = theta - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.weights, self.thresholds = theta[:f], self._cuts(theta[f:])
        return self

    @staticmethod
    def _cuts(raw: np.ndarray) -> np.ndarray:
        return raw[0] + np.concatenate([[0], np.cumsum(np.exp(np.minimum(raw[1:], 20)))])

    def at_least(self, z: np.ndarray) -> np.ndarray:
        """[row, k]: P(grade >= k + 1)."""
        return _sigmoid(np.asarray(z)[:, None] - self.thresholds)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


# ---- fitting
def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """doc_id, text, toxic of at most ``bound`` labelled documents; null labels count as none, of several the highest."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = written(known.orderBy(F.xxhash64("_id"), "_id").limit(bound), "severity-labels")
    # ``chosen`` has at most ``bound`` rows.
    return written(texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic"), "severity-sample")


def select_features(sample: DataFrame, most: int = FEATURES) -> list[str]:
    """Features with significantly different document shares in the two classes, the most significant first."""

    def run(frames):
        seen: dict[str, list[int]] = {}
        for frame in bytes_at_most(frames, "text"):
            for text, toxic in zip(frame["text"], frame["toxic"]):
                for f in counts_of(text):
                    seen.setdefault(f, [0, 0])[1 if toxic > 0 else 0] += 1
        names = list(seen)
        for at in range(0, len(names), 50_000):
            some = names[at : at + 50_000]
            yield pd.DataFrame({"f": some, "clean": [seen[f][0] for f in some], "toxic": [seen[f][1] for f in some]})

    size = {r["toxic"] > 0: r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return []
    a, b = size[True], size[False]
    found = sample.mapInPandas(run, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = (F.col("clean") + F.col("toxic") + 1.0) / (a + b + 2.0)
    z = (F.col("toxic") / F.lit(float(a)) - F.col("clean") / F.lit(float(b))) / F.sqrt(share * (1 - share) * (1.0 / a + 1.0 / b))
    return [r["f"] for r in found.where("toxic + clean >= 3").withColumn("z", z).where(F.abs("z") >= SIGNIFICANT).orderBy(F.desc(F.abs("z")), "f").limit(most).collect()]


def fit(docs: DataFrame, labels: DataFrame, grades: int = GRADES, bound: int = SAMPLE) -> Ordinal:
    """Fit on labelled documents. ``labels.toxic`` holds grades (0 clean, 1..). A yes/no label has no grades, so those
    marked 1 are graded 1..``grades`` by how densely they hold the selected features of toxic texts."""
    sample = labelled_sample(docs, labels, bound)
    names = select_features(sample)
    index = {f: i for i, f in enumerate(names)}

    def run(frames):
        for frame in bytes_at_most(frames, "text"):
            rows = []
            for doc_id, text, toxic in zip(frame["doc_id"], frame["text"], frame["toxic"]):
                hit = [(index[f], n) for f, n in counts_of(text).items() if f in index]
                rows.append((doc_id, toxic, max(1, len(_WORD.findall(text))), [i for i, _ in hit], [n for _, n in hit]))
            yield pd.DataFrame(rows, columns=["doc_id", "toxic", "n", "cols", "counts"])

    if not names:
        return Ordinal([], grades)
    rows = sample.mapInPandas(run, "doc_id long, toxic int, n int, cols array<int>, counts array<int>").collect()  # at most ``bound``
    rows.sort(key=lambda r: (r["doc_id"], r["n"], r["cols"], r["counts"]))
    y = np.array([r["toxic"] for r in rows])
    lengths = [len(r["cols"]) for r in rows]
    at = np.repeat(np.arange(len(rows)), lengths)
    cols = np.array([c for r in rows for c in r["cols"]], np.int64)
    share = np.array([c for r in rows for c in r["counts"]], float) / np.array([r["n"] for r in rows])[at]
    if y.max() <= 1:
        whole = np.array([n[0] == "=" for n in names])
        lean = np.bincount(cols, (y[at] > 0) * 1.0, minlength=len(names)) > 0.5 * np.bincount(cols, minlength=len(names))
        density = np.bincount(at, share * (lean & whole)[cols], minlength=len(rows))
        steps = np.quantile(density[y > 0], np.arange(1, grades) / grades)
        y = np.where(y > 0, 1 + np.searchsorted(steps, density, side="left"), 0)
    return Ordinal(names, grades).fit(at, cols, np.log1p(PER * share), np.minimum(y, grades))


# ---- scoring
def features_sum(model: Ordinal):
    """A function of whole texts that gives w.x for each."""
    index = {f: i for i, f in enumerate(model.names)}  # at most FEATURES entries
    hits: dict[str, tuple[int, ...]] = {}

    def of(word: str) -> tuple[int, ...]:
        if word not in hits:
            if len(hits) >= REMEMBERED:
                hits.clear()
            hits[word] = tuple(index[f] for f in features_of(word) if f in index)
        return hits[word]

    def run(some) -> np.ndarray:
        z = np.zeros(len(some))
        for r, text in enumerate(some):
            split = _WORD.findall((text or "").lower())
            seen: dict[int, int] = {}
            for word in split:
                for i in hits[word] if word in hits else of(word):
                    seen[i] = seen.get(i, 0) + 1
            if seen:
                z[r] = np.dot(model.weights[list(seen)], np.log1p(PER / len(split) * np.array(list(seen.values()))))
        return z

    return run


def score(docs: DataFrame, model: Ordinal, cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, severity (expected, 0..grades), grade (most probable), toxic (severity >= cut).

    Whole texts are read; null and empty ones have no features and get the severity of the thresholds alone. Repeated
    rows are scored each, null doc_ids kept, other columns ignored. Without labels of both kinds nothing is toxic.
    """

    def run(frames):
        weigh = features_sum(model)
        for frame in bytes_at_most(frames, "text"):
            above = model.at_least(weigh(frame["text"]))
            probs = np.diff(np.column_stack([np.zeros(len(above)), 1 - above, np.ones(len(above))]), axis=1)
            severity = above.sum(axis=1)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "severity": severity, "grade": probs.argmax(axis=1).astype(np.int32), "toxic": severity >= cut})

    return texts(docs).mapInPandas(run, "doc_id long, severity double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """Rows of ``docs``, with their columns, that the model fitted on ``docs`` and ``labels`` doesn't call toxic. Each
    row is judged by its own text, so nothing is joined."""
    model = fit(docs, labels)

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weigh = features_sum(model)  # words are remembered from batch to batch
        for some in batches:
            yield pd.Series(model.at_least(weigh(some)).sum(axis=1) < cut)

    return docs.where(clean(F.col("text")))
