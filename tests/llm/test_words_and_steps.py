"""Words of texts in Arrow, and the recurrent model's steps."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewick.llm import recurrent
from tidewick.llm.common import words

ODD = ["", " ", "One two", " one  TWO\tthree\n", "a\x0bb\x0cc\rd", "x\x1cy\x85z w　v u", "ÄÖ Straße İI ſ", "\x00 \x1f", "😀 ok\n\n", "end "]


def test_arrow_words_equal_the_words_of_each_text():
    for kind in (pa.string(), pa.large_string()):
        split, n = recurrent.split_words(pa.array(ODD, kind))
        assert recurrent.apart(np.array(split.to_pylist(), object), n)[2].tolist() == words(ODD[2])
        assert split.to_pylist() == [w for t in ODD for w in words(t)] and n.tolist() == [len(words(t)) for t in ODD]
    assert [len(x) for x in recurrent.split_words(pa.array(["", ""]))] == [0, 2]
    every = "".join(chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000)
    assert recurrent.split_words(pa.array([every]))[0].to_pylist() == words(every)


def test_symbols_and_rare_words_equal_a_count_by_hand():
    lexicon = [b"two", b"one", b"ok"]
    for own in (lexicon, [*lexicon, b""], []):
        place = {w: i for i, w in enumerate(own)}
        texts = [*ODD, "rare rare two rare", "b a b"]
        places, n, split = recurrent.symbols(pa.array(texts), pa.array(own, pa.binary()))
        want = [[*words(t), recurrent.END] for t in texts]
        assert [p.tolist() for p in recurrent.apart(places, n)] == [[place.get(w, -1) for w in ws] for ws in want]
        lists, times = recurrent._rare(places, n, split)
        got = [dict(zip(w, k, strict=True)) for w, k in zip(lists.to_pylist(), times.to_pylist(), strict=True)]
        assert got == [Counter(w for w in ws if w not in place) for ws in want]


def test_slices_pass_on_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(ODD)], ["text"])
    for limit in (1, 9, 1 << 20):
        cut = list(recurrent.slices([batch, batch.slice(0, 0), batch], limit))
        assert [t for b in cut for t in b["text"].to_pylist()] == ODD * 2
        assert all(len(b) == 1 or sum(len(t.encode()) for t in b["text"].to_pylist()) <= limit for b in cut)


def model():
    rng = np.random.default_rng(3)
    return {k: 0.3 * rng.standard_normal(s) for k, s in recurrent.SHAPES.items()}, rng


def test_log_likelihood_beyond_the_range_of_exp():
    p, rng = model()
    p["bc"][3], p["bw"][5, 7], p["bw"][6] = 2000, 3000, -4000
    h, t = rng.standard_normal((60, recurrent.HIDDEN)), np.r_[5 * 64 + 7, 6 * 64 + 1, rng.integers(0, 2048, 58)]
    want = []
    for state, word in zip(h, t):
        a, b = state @ p["wc"] + p["bc"], state @ p["ww"][word // 64] + p["bw"][word // 64]
        want.append(sum(x[i] - x.max() - np.log(np.exp(x - x.max()).sum()) for x, i in ((a, word // 64), (b, word % 64))))
    grads = {}
    ll, dh = recurrent.log_likelihood(p, h, t, grads)
    assert ll == pytest.approx(want) == recurrent.log_likelihood(p, h, t) and np.isfinite(dh).all() and all(np.isfinite(g).all() for g in grads.values())


def test_one_step_of_training_follows_the_gradient_by_differences():
    """One window from cleared states: what every weight moves by is told by differences of the windows' loss."""
    p, rng = model()
    documents = [rng.integers(0, 2048, n) for n in rng.integers(3, 30, 40)]
    p = {k: v.astype(np.float32) for k, v in p.items()}
    loss = lambda q: -recurrent.score_batch(q, documents, documents[0][-1]).sum()
    moved = {k: v.copy() for k, v in p.items()}
    streams = [[] for _ in range(recurrent.STREAMS)]
    for d in sorted(documents, key=len, reverse=True):
        min(streams, key=lambda s: sum(map(len, s))).append(d)
    if max(sum(map(len, s)) for s in streams) > recurrent.WINDOW:
        documents = documents[:20]
    n = recurrent.train(moved, documents, rate=0.05)
    for k in ("u", "wc", "ww", "x", "b", "bc"):
        step = (moved[k] - p[k]).astype(float)
        g = -step / 0.05  # of g / sqrt(0.001 + g * g)
        g = g * np.sqrt(1e-3 / np.maximum(1e-9, 1 - g * g))
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        up, down = ({m: v.astype(float) for m, v in p.items()} for _ in range(2))
        up[k][at] += 1e-2
        down[k][at] -= 1e-2
        assert g[at] == pytest.approx((loss(up) - loss(down)) / 2e-2 / n, rel=0.05)


def test_scoring_does_not_depend_on_how_many_go_abreast(monkeypatch):
    p, rng = model()
    p = {k: v.astype(np.float32) for k, v in p.items()}
    some = [rng.integers(0, 2048, n) for n in rng.integers(1, 60, 50)]
    want = recurrent.score_batch(p, some, 0)
    monkeypatch.setattr(recurrent, "ABREAST", 7)
    assert recurrent.score_batch(p, some, 0) == pytest.approx(want, rel=1e-5)
