"""Counts of words put together in Arrow, and the recurrent model's windows against plain loops."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewick.llm import recurrent
from tidewick.llm.common import words

TEXTS = ["", " ", "One two", "one  TWO\tthree one", "a a a b", "Ä ä\x0bz", "two"] * 5


def test_counts_of_parts_are_added():
    parts = []
    for kind, texts in ((pa.string(), TEXTS), (pa.large_string(), TEXTS[:9]), (pa.string(), [""])):
        found = recurrent.split_words(pa.array(texts, kind))[0].value_counts()
        parts.append(pa.table([found.field(0).cast(pa.binary()), found.field(1)], ["word", "n"]))
    got = recurrent.added_counts(parts)
    want = Counter(w for t in [*TEXTS, *TEXTS[:9]] for w in words(t))
    assert got.schema.names == ["word", "n"] and got["word"].type == pa.binary() and got["n"].type == pa.int64()
    assert len(got) == len(want) and dict(zip(got["word"].to_pylist(), got["n"].to_pylist())) == want


@pytest.mark.parametrize("most", [1, 4, 500_000])
def test_word_counts_with_parts_passed_on_early(spark, most):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    got = recurrent.word_counts(frame, most).collect()
    want = Counter(w for t in TEXTS for w in [*words(t), recurrent.END])
    assert len(got) == len(want) and {bytes(r.word): r.n for r in got} == want
    assert recurrent.word_counts(frame.where("false"), most).collect() == []


def test_long_words_are_passed_on_early(monkeypatch):
    """A task holds bytes of words within a bound, however few the words are."""
    runs = []

    class Table:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            runs.append(run)
            raise StopIteration

    with pytest.raises(StopIteration):
        recurrent.word_counts(Table())
    monkeypatch.setattr(recurrent, "BYTES", 1000)
    texts = [c * 700 for c in "abcdefgh"] * 2
    batches = [pa.RecordBatch.from_arrays([pa.array([t])], ["text"]) for t in texts]
    taken, got = 0, Counter()

    def given():
        nonlocal taken
        for taken, batch in enumerate(batches, 1):
            yield batch

    before_last = 0
    for rows in runs[0](given()):
        before_last += taken < len(batches)
        got.update(dict(zip(rows["word"].to_pylist(), rows["n"].to_pylist())))
    assert before_last > 2 and got == Counter(w for t in texts for w in [*words(t), recurrent.END])


def test_sums_of_one_few_and_many_rows():
    rng = np.random.default_rng(5)
    symbols = rng.permutation(np.r_[np.repeat([7, 2040], recurrent.MANY + 9), np.repeat([3, 9], recurrent.MANY), np.repeat(np.arange(20, 40), 3), np.arange(100, 150)])
    for some in (symbols, symbols[symbols >= 100], symbols[symbols == 7], symbols[(symbols >= 20) & (symbols < 40)]):
        rows = rng.standard_normal((len(some), 6))
        names, got = recurrent._sums(some, rows)
        want = np.zeros((2048, 6))
        np.add.at(want, some, rows)
        assert sorted(names.tolist()) == np.unique(some).tolist() and got == pytest.approx(want[names])


def model(seed):
    rng = np.random.default_rng(seed)
    return {k: (0.3 * rng.standard_normal(s)).astype(np.float32) for k, s in recurrent.SHAPES.items()}, rng


def step(p, h, word):
    """Gates and the next state of rows of states, plainly."""
    x, a, k = p["x"][word] + p["b"], h @ p["u"], recurrent.HIDDEN
    z, r = (1 / (1 + np.exp(-(x[..., s] + a[..., s]))) for s in (slice(k), slice(k, 2 * k)))
    n = np.tanh(x[..., 2 * k :] + r * a[..., 2 * k :])
    return z, r, n, a[..., 2 * k :], n + z * (h - n)


def test_scores_equal_a_plain_loop_over_words(monkeypatch):
    p, rng = model(4)
    documents = [rng.integers(0, 2048, n).astype(np.int16) for n in [1, 1, 2, 300, 7, 0, *rng.integers(1, 90, 40)]]
    exact = {k: v.astype(float) for k, v in p.items()}
    want = []
    for d in documents:
        h, total, before = np.zeros((1, recurrent.HIDDEN)), 0.0, 5
        for word in d.astype(int):
            h, before = step(exact, h, before)[-1], word
            total += recurrent.log_likelihood(exact, h, np.array([word]))[0]
        want.append(total)
    for abreast, full in ((1024, 4096), (16, 64), (3, 1)):
        monkeypatch.setattr(recurrent, "ABREAST", abreast)
        monkeypatch.setattr(recurrent, "FULL", full)
        assert recurrent.score_batch(p, documents, 5) == pytest.approx(want, rel=1e-5)
    assert recurrent.score_batch(p, [], 5).tolist() == []


def test_training_equals_plain_windows():
    """Several windows with documents that begin in them and streams that have ended, in float64 and step by step."""
    p, rng = model(6)
    documents = [np.r_[np.where(rng.random(n) < 0.3, 2047, rng.integers(1, 2047, n)), 0] for n in rng.integers(1, 60, 70)]
    q = {k: v.astype(float) for k, v in p.items()}
    assert recurrent.train(p, documents, rate=0.05) == sum(map(len, documents))

    k, streams = recurrent.HIDDEN, [[] for _ in range(recurrent.STREAMS)]
    for d in sorted(documents, key=len, reverse=True):
        min(streams, key=lambda s: sum(map(len, s))).append(d)
    longest = max(sum(map(len, s)) for s in streams)
    words_, first = np.full((longest, len(streams)), -1), np.zeros((longest, len(streams)), bool)
    for i, s in enumerate(streams):
        first[np.cumsum([0, *map(len, s)])[:-1], i] = True
        words_[: sum(map(len, s)), i] = np.concatenate(s)
    memory, state, last = {n: np.full(v.shape, 1e-3) for n, v in q.items()}, np.zeros((len(streams), k)), np.zeros(len(streams), int)
    for at in range(0, longest, recurrent.WINDOW):
        g, kept, states = {n: np.zeros(v.shape) for n, v in q.items()}, [], []
        for t in range(at, min(longest, at + recurrent.WINDOW)):
            past = np.where(first[t] | (last < 0), 0, last)
            h = state * ~first[t][:, None]
            *gates, state = step(q, h, past)
            kept.append((t, past, h, gates))
            states.append(state)
            last = words_[t]
        targets = np.concatenate([words_[t] for t, *_ in kept])
        real, out = targets >= 0, {}
        by_state = np.zeros((len(targets), k))
        by_state[real] = recurrent.log_likelihood(q, np.concatenate(states)[real], targets[real], out, scale=1 / real.sum())[1]
        g |= out
        back = np.zeros(state.shape)
        for (t, past, h, (z, r, n, a)), own in zip(kept[::-1], np.split(by_state, len(kept))[::-1]):
            d = own + back
            dn = d * (1 - z) * (1 - n * n)
            dx = np.concatenate([d * (h - n) * z * (1 - z), dn * a * r * (1 - r), dn], axis=1)
            da = np.concatenate([dx[:, : 2 * k], dn * r], axis=1)
            np.add.at(g["x"], past, dx)
            g["b"] += dx.sum(axis=0)
            g["u"] += h.T @ da
            back = (d * z + da @ q["u"].T) * ~first[t][:, None]
        for n in q:
            memory[n] += g[n] ** 2
            q[n] -= 0.05 * g[n] / np.sqrt(memory[n])
    for n in q:
        assert p[n] == pytest.approx(q[n], abs=2e-4), n
