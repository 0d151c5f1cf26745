"""Personal data: fixed patterns, and a linear-chain conditional random field for what they don't spell out.

The field labels words as email, ip, card, phone or none. Its features are shapes (letters, digits and signs with
repeats shortened) of a word and its neighbours, and counts of digits, dots and signs; it never sees a word itself. It is
trained from a small labelled table by penalised maximum likelihood and decoded by Viterbi. Only words with a digit or
an ``@`` can be personal data here; all others are fixed to none, so they part a text into short chains, and chains of many
documents are decoded together, one step of all chains at a time.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import bytes_at_most, texts, whole
from tidewick.session import written

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
SAMPLE = 6000  # chains of the labelled table
LONGEST = 64  # words of a chain that is trained on
LEAST = 3  # chains that a feature must occur in
SURE = 0.95  # probability that each word of an added span must have
TEXTS = 4 << 20  # characters searched at a time

# ---- fixed patterns
_LABEL = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive repeats and the look behind read every digit a bounded number of times.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Every second digit from the right is doubled (and its own digits added up); the sum ends in 0."""
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _LABEL.match(text, at + 1) if start < at else None
        # A text in which an @ stands far behind the last one is read backwards once for each @ only up to that one.
        end = domain.end() if domain else at + 1
        if domain:
            out.append((start, end))
        at = text.find("@", end)
    return out


def fixed_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind as in ``KINDS``. Each kind is searched on its own,
    leftmost and without overlaps; matches that fail their check are dropped and not tried again."""
    if not _MARK.search(text):
        return []
    found = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m.group().split("."))):
            found.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            found.append((*m.span(), 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda s: (s[0], s[2]))]


# ---- words, chains, features
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_RUNS = [(re.compile(p), s) for p, s in ((r"[^\W\d_]+", "a"), (r"[0-9]{1,3}(?![0-9])", "d"), (r"[0-9]{4,}", "D"), (r"([^\w])\1+", r"\1"))]


def shape(word: str) -> str:
    """Letters as one ``a``, up to three digits as ``d``, more as ``D``, repeats of a sign as one; at most 16 of these."""
    for run, to in _RUNS:
        word = run.sub(to, word[:4096])
    return word[:16]


def features(word: str, before: str, after: str) -> list[str]:
    digits = sum(c.isdigit() for c in word[:4096])
    return ["bias", "=" + shape(word), "<" + shape(before)[:6], ">" + shape(after)[:6], f"digits {min(digits, 20)}", f"dots {min(word.count('.'), 4)}",
            f"at {min(word.count('@'), 2)}", f"first {shape(word[:1])}", f"dash {min(word.count('-'), 3)}"]


def chains(text: str) -> list[list[tuple[int, int, list[str]]]]:
    """Runs of neighbouring words with a digit or ``@``: (start, end, features) of each word."""
    if not _MARK.search(text):
        return []
    out, last, words = [], -2, list(_WORD.finditer(text))
    for k, m in enumerate(words):
        if _MARK.search(m.group()):
            if k != last + 1:
                out.append([])
            near = [words[j].group() if 0 <= j < len(words) else "" for j in (k - 1, k + 1)]
            out[-1].append((*m.span(), features(m.group(), *near)))
            last = k
    return out


def word_labels(chain: list[tuple[int, int, list[str]]], spans: list[tuple[int, int, str]]) -> list[int]:
    """The label of each word: the kind, first in ``KINDS``, of the spans that it overlaps; else none."""
    out = []
    for a, b, _ in chain:
        kinds = [KINDS.index(k) + 1 for s, e, k in spans if s < b and a < e]
        out.append(min(kinds, default=0))
    return out


# ---- the field
class Field:
    """Weights of (feature, label) and of neighbouring labels."""

    def __init__(self, names: list[str], labels: int = len(LABELS)):
        self.names = {n: k for k, n in enumerate(names)}
        self.emit, self.move = np.zeros((len(names) + 1, labels)), np.zeros((labels, labels))  # the last row is of unknown features

    def padded(self, some: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """(chain, step, feature) numbers and the chains' lengths."""
        sizes = np.array([len(c) for c in some])
        most = max((len(f) for c in some for f in c), default=0)
        out = np.full((len(some), sizes.max(initial=0), most), len(self.names))
        for k, c in enumerate(some):
            for t, fs in enumerate(c):
                out[k, t, : len(fs)] = [self.names.get(f, len(self.names)) for f in fs]
        return out, sizes

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        return self.emit[numbers].sum(axis=2)

    def forward(self, scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log of the sums over label sequences up to each step, from each step on, and over all."""
        n, most, labels = scores.shape
        ahead, back = np.empty_like(scores), np.zeros_like(scores)
        for t in range(most):
            ahead[:, t] = scores[:, t] if t == 0 else scores[:, t] + _log_sum(ahead[:, t - 1, :, None] + self.move, 1)
        for t in range(most - 2, -1, -1):
            inside = (t + 1 < sizes)[:, None]
            back[:, t] = np.where(inside, _log_sum(self.move + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2), 0)
        return ahead, back, _log_sum(ahead[np.arange(n), sizes - 1], 1)

    def gradient(self, numbers: np.ndarray, sizes: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray, np.ndarray]:
        """Penalised mean negative log-likelihood of the labels, and its slopes."""
        n, most, _ = numbers.shape
        scores = self.scores(numbers)
        ahead, back, total = self.forward(scores, sizes)
        inside = np.arange(most) < sizes[:, None]
        share = np.exp(np.where(inside[..., None], ahead + back - total[:, None, None], -np.inf))
        gold = np.zeros_like(share)
        gold[(*np.nonzero(inside), y[inside])] = 1
        emit = np.zeros_like(self.emit)
        np.add.at(emit, numbers.reshape(n * most, -1), (share - gold).reshape(n * most, 1, -1))
        move, value = np.zeros_like(self.move), total.sum() - (scores * gold).sum()
        for t in range(1, most):
            on = sizes > t
            both = np.exp(ahead[on, t - 1, :, None] + self.move + (scores[on, t] + back[on, t])[:, None, :] - total[on, None, None])
            move += both.sum(axis=0)
            np.add.at(move, (y[on, t - 1], y[on, t]), -1)
            value -= self.move[y[on, t - 1], y[on, t]].sum()
        emit[-1] = 0
        return value / n + penalty / 2 * ((self.emit**2).sum() + (self.move**2).sum()), emit / n + penalty * self.emit, move / n + penalty * self.move

    def fit(self, some: list[list[list[str]]], labels: list[list[int]], penalty: float = 1e-4, steps: int = 150) -> "Field":
        """Adam steps over all chains; with no chain every word stays unlabelled."""
        if not some:
            self.move[:, 0] = self.emit[:, 0] = 9.0
            return self
        numbers, sizes = self.padded(some)
        y = np.zeros(numbers.shape[:2], int)
        for k, own in enumerate(labels):
            y[k, : len(own)] = own
        first = [np.zeros_like(self.emit), np.zeros_like(self.move)]
        second = [np.zeros_like(self.emit), np.zeros_like(self.move)]
        for t in range(1, steps + 1):
            _, *slopes = self.gradient(numbers, sizes, y, penalty)
            for w, g, m, v in zip((self.emit, self.move), slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return self

    def decode(self, some: list[list[list[str]]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of each chain the likeliest label sequence (Viterbi; ties to the first label) and each word's probability of
        its label. Chains are taken in groups of like length."""
        order = sorted(range(len(some)), key=lambda k: len(some[k]))
        paths: list = [None] * len(some)
        sure: list = [None] * len(some)
        at = 0
        while at < len(order):
            group = [order[at]]
            at += 1
            while at < len(order) and len(group) < 4096 and len(some[order[at]]) * (len(group) + 1) <= 65536:
                group.append(order[at])
                at += 1
            numbers, sizes = self.padded([some[k] for k in group])
            scores = self.scores(numbers)
            best, came = scores[:, 0], []
            ends = [best]
            for t in range(1, scores.shape[1]):
                step = best[:, :, None] + self.move
                came.append(step.argmax(axis=1))
                best = scores[:, t] + step.max(axis=1)
                ends.append(best)
            ahead, back, total = self.forward(scores, sizes)
            share = np.exp(ahead + back - total[:, None, None])
            path = np.zeros(scores.shape[:2], int)
            rows = np.arange(len(group))
            for t in range(scores.shape[1] - 1, -1, -1):
                here = ends[t].argmax(axis=1)
                if t + 1 < scores.shape[1]:
                    here = np.where(sizes - 1 == t, here, came[t][rows, path[:, t + 1]])
                path[:, t] = here
            for r, k in enumerate(group):
                paths[k] = path[r, : sizes[r]]
                sure[k] = share[r, np.arange(sizes[r]), paths[k]]
        return paths, sure


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


# ---- spans of the field
_EDGE = {"phone": "+("}


def added_spans(text: str, base: list[tuple[int, int, str]], chain, path: np.ndarray, sure: np.ndarray) -> list[tuple[int, int, str]]:
    """Spans of neighbouring words with one label, each word ``SURE``; edges lose signs, and what overlaps a fixed span is
    left out. An email or ip is a word of its own."""
    out, k = [], 0
    while k < len(path):
        e = k + 1
        while e < len(path) and path[e] == path[k] and path[k] > 2:
            e += 1
        if path[k] and (sure[k:e] >= SURE).all():
            kind, a, b = LABELS[path[k]], chain[k][0], chain[e - 1][1]
            while a < b and not text[a].isalnum() and text[a] not in _EDGE.get(kind, ""):
                a += 1
            while b > a and not text[b - 1].isalnum():
                b -= 1
            if a < b and not any(s < b and a < t for s, t, _ in base):
                out.append((a, b, kind))
        k = e
    return out


def spelt(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


# ---- data sets
def labelled(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A labelled table from the documents themselves: at most ``sample`` different chains (of at most ``LONGEST`` words),
    by the smallest hash, with the labels that the fixed patterns give: ``words`` (a list of feature lists, as JSON) and
    ``labels``. Null and empty texts have no chains."""

    def run(frames):
        for frame in bytes_at_most(frames, "text", TEXTS):
            out = []
            for text in frame["text"]:
                if text:
                    spans = fixed_spans(text)
                    for c in chains(text):
                        if len(c) <= LONGEST:
                            near = [s for s in spans if s[0] < c[-1][1] and c[0][0] < s[1]]
                            out.append((json.dumps([f for *_, f in c]), word_labels(c, near)))
            yield pd.DataFrame(out, columns=["words", "labels"])

    got = _marked(docs).select("text").mapInPandas(run, "words string, labels array<int>").distinct()
    return got.orderBy(F.xxhash64("words"), "words", "labels").limit(sample)


def fit(labelled_: DataFrame) -> Field:
    """A field from a labelled table (``words``, ``labels``: as ``labelled`` gives them) of a size fit for the driver."""
    rows = sorted((r["words"], list(r["labels"])) for r in labelled_.select("words", "labels").where("words IS NOT NULL AND labels IS NOT NULL").collect())
    some, labels = [json.loads(w) for w, _ in rows], [y for _, y in rows]
    seen: dict[str, int] = {}
    for c in some:
        for f in {f for fs in c for f in fs}:
            seen[f] = seen.get(f, 0) + 1
    return Field(sorted(f for f, n in seen.items() if n >= min(LEAST, len(some)))).fit(some, labels)


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id and text; texts without a digit and @ hold nothing and stay on the JVM's side as null."""
    return texts(docs).withColumn("text", F.when(F.col("text").rlike("[0-9@]"), F.col("text")))


def find(docs: DataFrame, field: Field) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (spans of the fixed patterns), base_sha256 (of those
    spans, ``kind:start:end`` joined by commas), spans (those and the field's, joined alike; ends are exclusive).

    Null and empty texts have no spans. Repeated rows give a row each, a null doc_id stays null, an empty table gives
    no rows; other columns are ignored. Spans of equal start are ordered by kind as in ``KINDS``.
    """

    def run(frames):
        for frame in bytes_at_most(frames, "text", TEXTS):
            some = [t or "" for t in frame["text"]]
            base, linked = [fixed_spans(t) for t in some], [chains(t) for t in some]
            paths, sure = field.decode([[f for *_, f in c] for own in linked for c in own])
            out, at = [], 0
            for doc_id, text, own, cs in zip(frame["doc_id"], some, base, linked):
                more = []
                for c in cs:
                    near = [s for s in own if s[0] < c[-1][1] and c[0][0] < s[1]]
                    more += added_spans(text, near, c, paths[at], sure[at])
                    at += 1
                counts = [sum(k == kind for *_, k in own) for kind in KINDS]
                out.append((None if pd.isna(doc_id) else int(doc_id), *counts, hashlib.sha256(spelt(own).encode()).hexdigest(), spelt(own + more)))
            yield pd.DataFrame(out, columns=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]).astype({"doc_id": "Int64"})

    return _marked(docs).mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
