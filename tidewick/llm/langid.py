"""Language identification by nearest centroid over character n-grams.

A text becomes counts of letter 1- to 3-grams, hashed into a fixed number of cells, weighted by inverse document
frequency over all training texts and scaled to length one. Each language is described by several centroids, found by
spherical k-means on a bounded sample of its labelled texts. A text goes to the language of the centroid with the
highest cosine, and is rejected if it lies farther from that centroid than nearly all texts the centroid came from.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.llm.common import bytes_at_most, texts
from tidewick.session import written

CELLS = 4096
SAMPLE = 1_000  # labelled texts per language that centroids are fitted on, by the smallest hash
CENTROIDS = 4
INSIDE = 0.995  # share of a centroid's own sample that its radius takes in
MARGIN = 1.2
UNKNOWN = "und"
_CHUNK = 1 << 20


# ---- vectors
@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-cased letter, or 0."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def counts_of(text: str) -> np.ndarray | None:
    """Counts per cell of a whole text; None if it has no letter. Word borders count, runs of other characters don't."""
    total, found, before = np.zeros(CELLS, np.int64), False, np.zeros(0, np.uint32)
    for at in range(0, len(text), _CHUNK):
        code = _letters()[np.frombuffer(text[at : at + _CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")]
        fresh = len(before)
        a = np.concatenate([before, code]).astype(np.uint64)
        found = found or bool(a.any())
        seen = []
        for n in (1, 2, 3):
            if len(a) < n:
                continue
            h, some = np.zeros(len(a) - n + 1, np.uint64), np.zeros(len(a) - n + 1, bool)
            for k in range(n):
                part = a[k : k + len(h)]
                h = h * np.uint64(0x100000001B3) + part
                some |= part > 0
            # Grams that end in what an earlier chunk has counted are left out.
            keep = some.copy()
            keep[: max(0, fresh - n + 1)] = False
            h = (h[keep] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            seen.append(h >> np.uint64(52))
        if seen:
            total += np.bincount(np.concatenate(seen).astype(np.int64), minlength=CELLS)
        before = code[-2:] if len(code) > 1 else np.concatenate([before, code])[-2:]
    return total if found else None


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return (v / max(float(np.sqrt((v * v).sum())), 1e-12)).astype(np.float32)


# ---- fitting
class Centroids:
    def __init__(self, idf: np.ndarray, names: list[str], vectors: np.ndarray, radii: np.ndarray):
        self.idf, self.names, self.vectors, self.radii = idf, names, vectors, radii

    def nearest(self, counts: np.ndarray) -> tuple[str, float, bool]:
        """(language, cosine in 0..1, rejected)."""
        cosine = self.vectors @ unit(counts, self.idf)
        k = int(cosine.argmax())
        return self.names[k], float(min(1.0, max(0.0, cosine[k]))), bool(1 - cosine[k] > self.radii[k])


def inverse_frequency(training: DataFrame) -> np.ndarray:
    """log((1 + n) / (1 + documents with the cell)) + 1, over all training texts."""

    def run(frames):
        df = np.zeros(CELLS + 1, np.int64)
        for frame in bytes_at_most(frames, "text"):
            for text in frame["text"]:
                counts = counts_of(text)
                df[CELLS] += 1
                if counts is not None:
                    df[:CELLS] += counts > 0
        yield pd.DataFrame({"cell": np.arange(CELLS + 1), "n": df})

    out = np.zeros(CELLS + 1)
    for r in training.select("text").mapInPandas(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return np.log((1 + out[CELLS]) / (1 + out[:CELLS])) + 1


def spherical_means(x: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, radii) of unit vectors. Starts from far-apart rows; an empty cluster is left out."""
    centres = [x[0]]
    for _ in range(min(k, len(x)) - 1):
        gap = 1 - (x @ np.array(centres).T).max(axis=1)
        if gap.max() < 1e-6:
            break
        centres.append(x[int(gap.argmax())])
    c = np.array(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        sums = np.array([x[own == j].sum(axis=0) for j in range(len(c)) if (own == j).any()])
        new = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if new.shape == c.shape and np.allclose(new, c, atol=1e-6):
            break
        c = new
    near = x @ c.T
    own, gap = near.argmax(axis=1), 1 - near.max(axis=1)
    radii = np.array([MARGIN * np.quantile(gap[own == j], INSIDE) if (own == j).any() else 0.0 for j in range(len(c))])
    return c.astype(np.float32), radii


def fit(training: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Centroids:
    """From rows with doc_id, text, lang (none null). Frequencies cover all rows, centroids a sample per language."""
    idf = inverse_frequency(training)
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = training.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).withColumn("at", F.row_number().over(order)).where(F.col("at") <= sample)
    chosen = written(ids.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct(), "langid-sample")
    # ``chosen`` has at most ``sample`` rows per language.
    some = training.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))).select("lang", "text")

    def vectors(frames):
        for frame in bytes_at_most(frames, "text"):
            got = [counts_of(t) for t in frame["text"]]
            yield pd.DataFrame([(lang, unit(c, idf).tobytes()) for lang, c in zip(frame["lang"], got) if c is not None], columns=["lang", "v"])

    def means(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v, np.float32) for v in sorted(frame["v"])])
        c, radii = spherical_means(x, centroids)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "v": [r.tobytes() for r in c], "radius": radii})

    rows = some.mapInPandas(vectors, "lang string, v binary").groupBy("lang").applyInPandas(means, "lang string, v binary, radius double").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["v"])))
    stacked = np.stack([np.frombuffer(bytes(r["v"]), np.float32) for r in rows]) if rows else np.zeros((0, CELLS), np.float32)
    return Centroids(idf, [r["lang"] for r in rows], stacked, np.array([r["radius"] for r in rows]))


# ---- predicting
def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """One row per document: doc_id, nearest (language), score (its cosine), rejected.

    Whole texts are read. A null text, one without letters, and every text if nothing was learned, is ``und`` with
    score 0 and rejected. Ties go to the first language by name.
    """

    def run(frames):
        for frame in bytes_at_most(frames, "text"):
            rows = []
            for text in frame["text"]:
                counts = counts_of(text) if model.names else None
                rows.append((UNKNOWN, 0.0, True) if counts is None else model.nearest(counts))
            out = pd.DataFrame(rows, columns=["nearest", "score", "rejected"])
            out.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy())
            yield out.astype({"doc_id": "Int64"})

    return texts(docs).mapInPandas(run, "doc_id long, nearest string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's digits is 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document, learned from those not held out with a lang.

    ``lang_pred`` names the nearest language even where the distance speaks against it; ``rejected`` says so.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    training = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    got = predict(rows, fit(training))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("nearest").alias("lang_pred"), "score", "rejected")
