"""Log-likelihood of whole documents under a gated recurrent model with a class-factored output.

Words are counted over all training documents. The most frequent ones are the network's vocabulary; every other word is
the symbol OTHER times its smoothed share among other words, so the model is a distribution over all words. The
network's output is factored, P(word) = P(class) P(word | class), with classes of equal size by frequency, and starts
from the counted shares. Training is by truncated backpropagation in numpy: each task trains a copy on its own
documents, and copies are averaged by the words they have seen. Every training document is in one of two rounds. In scoring
the state is carried from window to window through a document of any length.

Rare words are not held anywhere as a whole: their counts are joined to the documents that use them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidewick.llm.common import texts, words  # noqa: F401  (what split_words has to equal)
from tidewick.session import written

CLASSES, PER_CLASS = 32, 64
SHORTLIST = CLASSES * PER_CLASS - 1  # the last symbol is OTHER
OTHER = SHORTLIST
HIDDEN = 16
HEAD = 150_000  # most frequent words at most, whose counts every task gets
WINDOW = 32
STREAMS = 32
TILE = 16  # words of one class that are few
MANY = 16  # rows of one symbol whose sum is a product
ABREAST = 1024  # documents that advance side by side in scoring
BYTES = 32 << 20  # words that a task holds beyond one slice of texts
SIDE_BY_SIDE = 8_000_000  # words of the documents that scoring takes together; their texts aren't kept
FULL = 4096  # states whose words are looked at together in scoring
ROUNDS = 2
PRIOR = 100_000
END = b""  # no word is empty
LN10 = math.log(10)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's digits is 1 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# ---- words
def slices(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of at most ``limit`` bytes of text (one row at least). Every row is passed on."""
    for batch in batches:
        sizes, start, total = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one text after another, and how many each text has; for one text the same as ``words``."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    n, flat_ = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
    real = pc.greater(pc.binary_length(flat_), 0)  # before the first space of a text or behind its last there is no word
    if not pc.all(real, min_count=0).as_py():
        n = np.bincount(np.repeat(np.arange(len(n)), n)[real.to_numpy(zero_copy_only=False)], minlength=len(n))
        flat_ = flat_.filter(real)
    return flat_.cast(pa.large_binary() if pa.types.is_large_string(flat_.type) else pa.binary()), n


def symbols(text: pa.Array, lexicon: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Places in the lexicon (-1: not there) of the words and the end of each text, how many those are, and all words."""
    split, n = split_words(text)
    places = np.empty(len(split) + len(n), np.int64)
    ends = np.zeros(len(places), bool)
    ends[np.cumsum(n + 1) - 1] = True
    places[~ends] = pc.fill_null(pc.index_in(split, lexicon.cast(split.type)), -1).to_numpy(zero_copy_only=False)
    places[ends] = pc.fill_null(pc.index_in(pa.array([END], lexicon.type), lexicon), -1)[0].as_py()
    return places, n + 1, split


def apart(ids: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    return np.split(ids, np.cumsum(n)[:-1])


# ---- counts
def added_counts(parts: list[pa.Table]) -> pa.Table:
    """(word, n) of all parts, each word once."""
    return pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns({"word": "word", "n_sum": "n"})


def word_counts(training: DataFrame, most: int = 500_000) -> DataFrame:
    """(word, n) over all whole texts, the end of each counted as the empty word; stored rows. Slices are counted one by one
    and their counts added; a task that holds more than ``most`` words then, or ``BYTES``, passes them on."""

    def run(batches):
        parts, held, heavy, ends = [], 0, 0, 0
        for batch in slices(batches, 4 << 20):
            found = split_words(batch["text"])[0].value_counts()
            parts.append(pa.table([found.field(0).cast(pa.binary()), found.field(1)], ["word", "n"]))
            held, heavy, ends = held + len(found), heavy + parts[-1].nbytes, ends + len(batch)
            if held > 2 * most or heavy > 2 * BYTES:
                parts = [added_counts(parts)]
                held, heavy = len(parts[0]), parts[0].nbytes
                if held > most or heavy > BYTES:
                    yield from parts[0].to_batches(100_000)
                    parts, held, heavy = [], 0, 0
        if ends:
            parts.append(pa.table([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], ["word", "n"]))
            yield from added_counts(parts).to_batches(100_000)
        parts = None
        pa.default_memory_pool().release_unused()  # the worker stays for the stages behind

    return written(training.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


class Lexicon:
    """The most frequent words (at most ``HEAD``), by falling count, and totals over all."""

    def __init__(self, counts: DataFrame, most: int = HEAD):
        total = counts.agg(F.sum("n"), F.count("*")).first()
        self.tokens, self.types = int(total[0] or 0), int(total[1])
        # Classes of counts, eight to a doubling: the lowest class from which on no more than ``most`` words follow.
        level = F.floor(F.log2("n") * 8)
        left, lowest = most, None
        for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
            if r["count"] > left:
                break
            left, lowest = left - r["count"], r["level"]
        head = counts.where(level >= lowest).collect() if lowest is not None else []
        head.sort(key=lambda r: (-r["n"], bytes(r["word"])))
        self.words = [bytes(r["word"]) for r in head]
        self.counts = np.array([r["n"] for r in head], np.int64)
        self.bulk = self.tokens + 0.5 * (self.types + 1)
        self.base = np.log10((self.counts + 0.5) / self.bulk)
        self.other = max(1e-12, 1.0 - float(((self.counts[:SHORTLIST] + 0.5) / self.bulk).sum()))


# ---- the network
SHAPES = {"x": (SHORTLIST + 1, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,),
          "ww": (CLASSES, HIDDEN, PER_CLASS), "bw": (CLASSES, PER_CLASS)}


def started(lexicon: Lexicon, seed: int = 11) -> dict[str, np.ndarray]:
    """Small random weights; output biases from the counted shares, so that the first guess is the unigram model."""
    rng = np.random.default_rng(seed)
    out = {k: (0.1 * rng.standard_normal(s)).astype(np.float32) for k, s in SHAPES.items()}
    share = np.full(SHORTLIST + 1, 1e-9)
    n = min(SHORTLIST, len(lexicon.counts))
    share[:n] = (lexicon.counts[:n] + 0.5) / lexicon.bulk
    share[OTHER] = lexicon.other
    by_class = share.reshape(CLASSES, PER_CLASS)
    out["bc"] = np.log(by_class.sum(axis=1)).astype(np.float32)
    out["bw"] = np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32)
    for k in ("wc", "ww"):
        out[k] *= 0.1
    out["b"][:] = 0
    return out


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def shaped(v: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k], at = v[at : at + n].reshape(s).astype(np.float32), at + n
    return out


def _room(room: dict, name: str, shape: tuple, kind) -> np.ndarray:
    """An array of any content, in the place of the one that ``room`` held by this name."""
    n = math.prod(shape)
    kept = room.get(name)
    if kept is None or len(kept) < n or kept.dtype != kind:
        kept = room[name] = np.empty(n + n // 4, kind)
    return kept[:n].reshape(shape)


def _softmax(a: np.ndarray, place: np.ndarray, chosen: np.ndarray, careful: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log of the softmax of rows of ``a`` at the chosen columns, for every place; the exponentials (``a`` becomes them) and
    each row's total, so that exponentials over totals are the softmax. ``careful``: for numbers that exp doesn't keep apart."""
    if careful:
        a -= a.max(axis=1, keepdims=True)
    own = a.reshape(-1).take(place * a.shape[1] + chosen)
    np.exp(a, out=a)
    total = a @ np.ones(a.shape[1], a.dtype)
    return own - np.log(total.take(place)), a, total


def _apart(total: np.ndarray) -> bool:
    return bool(1e-20 < total.min(initial=1) <= total.max(initial=1) < 1e20)


def _less_chosen(e: np.ndarray, total: np.ndarray, place: np.ndarray, chosen: np.ndarray, scale: float) -> np.ndarray:
    """Makes ``e`` the gradient of the negative logs times each row's total, and returns what to multiply rows by for
    ``scale`` times that."""
    e.reshape(-1)[place * e.shape[1] + chosen] -= total.take(place)
    return (e.dtype.type(scale) / total)[:, None]


def _with_biases(weights: np.ndarray, biases: np.ndarray) -> np.ndarray:
    """Biases as a last row, which meets a state of one more place that is always 1."""
    return np.concatenate([weights, biases[..., None, :]], axis=-2)


def _places(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, slice]], int]:
    """Each word's place when the words of a class are a run of rows; the classes of at most ``TILE`` words, which come first
    and take ``TILE`` rows each; the others with their rows; all rows."""
    n = np.bincount(c, minlength=CLASSES)
    few = n <= TILE
    thin, thick = np.flatnonzero(few & (n > 0)), np.flatnonzero(~few)
    own, some = n[thick], len(thin) * TILE
    ends = some + np.cumsum(own)
    shift = np.zeros(CLASSES, np.int64)
    shift[thin], shift[thick] = np.arange(0, some, TILE), ends - own
    shift -= np.cumsum(n) - n
    order = np.argsort(c.astype(np.int16), kind="stable")
    place = np.empty(len(c), np.int64)
    place[order] = np.arange(len(c)) + np.repeat(shift, n)
    runs = [(k, slice(e - m, e)) for k, m, e in zip(thick.tolist(), own.tolist(), ends.tolist())]
    return place, thin, runs, runs[-1][1].stop if runs else some


def log_likelihood(p, h: np.ndarray, target: np.ndarray, grads: dict | None = None, scale: float = 1.0):
    """Natural log P(target) for rows of states; with ``grads``, also the gradient of its loss, times ``scale``, by the states."""
    one = np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)
    top, weights = _with_biases(p["wc"], p["bc"]), _with_biases(p["ww"], p["bw"])
    if grads is None:
        return _output(top, weights, one, target, {})
    ll, out, by_top, by_class = _output(top, weights, one, target, {}, scale)
    grads["wc"], grads["bc"], grads["ww"], grads["bw"] = by_top[:HIDDEN], by_top[HIDDEN], by_class[:, :HIDDEN], by_class[:, HIDDEN]
    return ll, out


def _output(top: np.ndarray, weights: np.ndarray, one: np.ndarray, target: np.ndarray, room: dict, scale: float | None = None, careful: bool = False):
    """Natural log P(target) for rows of states that end in 1; with ``scale``, also the gradients of its loss by states, by
    the classes' layer ``top`` and by the classes' matrices ``weights`` (all with biases); ``one`` is lost then. Words of a class
    stand together and go through its matrix at once, the classes of few words side by side. ``room`` keeps arrays."""
    kind, every = np.result_type(one, weights), np.arange(len(one))
    c, w = np.divmod(target, PER_CLASS)
    place, thin, thick, size = _places(c)
    some, owned = len(thin) * TILE, weights.take(thin, axis=0)
    hs = _room(room, "states by class", (size, HIDDEN + 1), kind)
    hs[:some] = 0  # a row without a word
    hs[place] = one
    a, b = _room(room, "classes", (len(one), CLASSES), kind), _room(room, "words", (size, PER_CLASS), kind)
    np.dot(one, top, out=a)
    np.matmul(hs[:some].reshape(-1, TILE, HIDDEN + 1), owned, out=b[:some].reshape(-1, TILE, PER_CLASS))
    for k, at in thick:
        np.dot(hs[at], weights[k], out=b[at])
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        ll, a, total_a = _softmax(a, every, c, careful)
        by_word, b, total_b = _softmax(b, place, w, careful)
    if not (careful or _apart(total_a) and _apart(total_b)):  # rare
        return _output(top, weights, one, target, room, scale, True)
    ll += by_word
    if scale is None:
        return ll
    over = _less_chosen(a, total_a, every, c, scale)
    one *= over
    by_top = one.T @ a
    out = a @ top[:HIDDEN].T
    out *= over
    over = _less_chosen(b, total_b, place, w, scale)
    hs *= over
    by_class, back = _room(room, "by class", weights.shape, kind), _room(room, "back", (size, HIDDEN), kind)
    by_class[:] = 0
    tiles = b[:some].reshape(-1, TILE, PER_CLASS)
    by_class[thin] = hs[:some].reshape(-1, TILE, HIDDEN + 1).transpose(0, 2, 1) @ tiles
    np.matmul(tiles, owned[:, :HIDDEN].transpose(0, 2, 1), out=back[:some].reshape(-1, TILE, HIDDEN))
    for k, at in thick:
        np.dot(hs[at].T, b[at], out=by_class[k])
        np.dot(b[at], weights[k, :HIDDEN].T, out=back[at])
    back *= over
    out += back.take(place, axis=0)
    return ll, out, by_top, by_class


def _sums(symbols_: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols, each once, and the sums of their rows; those of one row need no sum, and those of many are a product each."""
    order = np.argsort(symbols_.astype(np.int16), kind="stable")  # symbols are few
    n = np.bincount(symbols_)
    single, more, many = np.flatnonzero(n == 1), np.flatnonzero((n > 1) & (n <= MANY)), np.flatnonzero(n > MANY)
    counts, of = n[more], n.take(symbols_.take(order))
    out = np.empty((len(more) + len(many) + len(single), rows.shape[1]), rows.dtype)
    if len(more):
        np.add.reduceat(rows.take(order[(of > 1) & (of <= MANY)], axis=0), np.cumsum(counts) - counts, axis=0, out=out[: len(more)])
    own, ones, end = rows.take(order[of > MANY], axis=0), np.ones(len(rows), rows.dtype), 0
    for i, k in enumerate(n[many].tolist(), len(more)):
        np.dot(ones[:k], own[end : end + k], out=out[i])
        end += k
    out[len(more) + len(many) :] = rows.take(order[of == 1], axis=0)
    return np.concatenate([more, many, single]), out


def _adapt(p: np.ndarray, memory: np.ndarray, g: np.ndarray, rate: float) -> None:
    """One step against ``g`` (which is lost), each weight at a rate that falls with its squared gradients so far."""
    some = g * g
    memory += some
    np.sqrt(memory, out=some)
    g *= rate
    g /= some
    p -= g


def train(p: dict[str, np.ndarray], documents: list[np.ndarray], rate: float = 0.05) -> int:
    """Truncated backpropagation (in place) over whole documents dealt to parallel streams; returns the words seen.

    The state is carried over windows and cleared at the start of each document; gradients stop at window borders.
    Gates and states of a step are columns, one for each stream, in arrays that every window uses again.
    """
    streams: list[list[np.ndarray]] = [[] for _ in range(STREAMS)]
    length = [0] * STREAMS
    for d in sorted(documents, key=len, reverse=True):
        k = length.index(min(length))
        streams[k].append(d)
        length[k] += len(d)
    if not any(length):
        return 0
    steps, end = max(length), documents[0][-1]
    target, first = np.full((steps, STREAMS), -1, np.int64), np.zeros((steps, STREAMS), bool)
    for k, docs in enumerate(streams):
        at = 0
        for d in docs:
            target[at : at + len(d), k], first[at, k] = d, True
            at += len(d)
    before = np.concatenate([np.full((1, STREAMS), end), target[:-1]])
    before[first | (before < 0)] = end
    stays, begins = (~first).astype(np.float32)[:, None], first.any(axis=1)
    both, cell = 2 * HIDDEN, (HIDDEN, STREAMS)
    # Weights as training holds them: biases with their layer, and those of the two gates of exp(-x) with the other sign.
    sign = np.repeat(np.array([-1, -1, 1], np.float32), HIDDEN)
    x, u, b = p["x"] * sign, np.ascontiguousarray((p["u"] * sign).T), p["b"] * sign
    top, weights = _with_biases(p["wc"], p["bc"]), _with_biases(p["ww"], p["bw"])
    layers = [(own, np.full(own.shape, 1e-3, np.float32)) for own in (weights, top, u, b)]
    x_memory, room = np.full(x.shape, 1e-3, np.float32), {}
    x_gates, h_gates = (np.empty((WINDOW, 3 * HIDDEN, STREAMS), np.float32) for _ in range(2))  # the former become the gates
    states, kept = np.zeros((WINDOW + 1, *cell), np.float32), np.empty(cell, np.float32)  # states' first one: before the window
    by, ones = np.empty((WINDOW, 4, *cell), np.float32), np.ones((both, STREAMS), np.float32)
    dh, before_, by_new, other = (np.empty((WINDOW, *cell), np.float32) for _ in range(4))
    turned = np.empty((HIDDEN, 4 * HIDDEN), np.float32)
    turned[:, 3 * HIDDEN :] = np.eye(HIDDEN)  # the gate that keeps a state
    forth = list(zip(x_gates[:, :both], x_gates[:, :HIDDEN], x_gates[:, HIDDEN:both], x_gates[:, both:], h_gates, h_gates[:, :both], h_gates[:, both:], states[1:]))
    back_ = list(zip(dh, dh[:, None], by, by.reshape(WINDOW, 4 * HIDDEN, STREAMS)))
    add, subtract, multiply, divide, exp, tanh, dot = np.add, np.subtract, np.multiply, np.divide, np.exp, np.tanh, np.dot
    for at in range(0, steps, WINDOW):
        t, past, stay, begin = target[at : at + WINDOW], before[at : at + WINDOW].ravel(), stays[at : at + WINDOW], begins[at : at + WINDOW].tolist()
        m = len(t)
        add(x.take(past, axis=0).reshape(m, STREAMS, 3 * HIDDEN).transpose(0, 2, 1), b[:, None], out=x_gates[:m])
        h = states[0]
        with np.errstate(over="ignore"):  # a gate of 1 / (1 + exp(-x)) with exp(-x) beyond the floats is 0
            for j, (zr, z, r, new, g, g_zr, g_n, out) in enumerate(forth[:m]):
                if begin[j]:
                    h = h * stay[j]
                dot(u, h, g)
                add(zr, g_zr, zr)
                exp(zr, zr)
                add(zr, ones, zr)
                divide(g_n, r, kept)
                add(new, kept, new)
                tanh(new, new)
                subtract(h, new, out)
                divide(out, z, out)
                add(out, new, out)
                h = out
        inputs = multiply(states[:m], stay, out=before_[:m])
        target_, one = t.ravel(), _room(room, "states", (m * STREAMS, HIDDEN + 1), np.float32)
        one.reshape(m, STREAMS, HIDDEN + 1)[:, :, :HIDDEN] = states[1 : m + 1].transpose(0, 2, 1)
        one[:, HIDDEN] = 1
        real = np.flatnonzero(target_ >= 0)
        if len(real) == len(one):
            _, by_state, by_top, by_class = _output(top, weights, one, target_, room, 1.0 / len(one))
        else:
            by_state = np.zeros((len(one), HIDDEN), np.float32)
            _, by_state[real], by_top, by_class = _output(top, weights, one.take(real, axis=0), target_[real], room, 1.0 / max(1, len(real)))
        dh[:m] = by_state.reshape(m, STREAMS, HIDDEN).transpose(0, 2, 1)
        # What a state's gradient is multiplied by for each gate: for all steps at once, so that the way back is short.
        np.reciprocal(x_gates[:m, :both], out=x_gates[:m, :both])
        z, r, n, own, change, rest = x_gates[:m, :HIDDEN], x_gates[:m, HIDDEN:both], x_gates[:m, both:], by[:m], by_new[:m], other[:m]
        subtract(1, z, out=rest)
        multiply(n, n, out=change)
        subtract(1, change, out=change)
        multiply(change, rest, out=change)
        subtract(n, inputs, out=own[:, 0])
        multiply(rest, z, out=rest)
        multiply(own[:, 0], rest, out=own[:, 0])
        multiply(change, r, out=own[:, 2])
        subtract(r, 1, out=rest)
        multiply(rest, h_gates[:m, both:], out=rest)
        multiply(rest, own[:, 2], out=own[:, 1])
        own[:, 3] = z
        turned[:, : 3 * HIDDEN] = u.T
        back = np.zeros(cell, np.float32)
        for j in range(m - 1, -1, -1):
            d, d_, factors, flat_ = back_[j]
            add(d, back, d)
            multiply(d_, factors, factors)
            dot(turned, flat_, back)
            if begin[j]:
                back *= stay[j]
        gates = _room(room, "gates", (m * STREAMS, 3 * HIDDEN), np.float32)
        gates.reshape(m, STREAMS, 3, HIDDEN)[:] = own[:, :3].transpose(0, 3, 1, 2)
        by_u = gates.T @ inputs.transpose(0, 2, 1).reshape(-1, HIDDEN)
        multiply(change, dh[:m], out=change)
        gates.reshape(m, STREAMS, 3, HIDDEN)[:, :, 2] = change.transpose(0, 2, 1)
        words_, g = _sums(past, gates)
        some, own = x.take(words_, axis=0), x_memory.take(words_, axis=0)
        by_b = g.sum(axis=0)
        _adapt(some, own, g, rate)
        x[words_], x_memory[words_] = some, own
        for (own, own_memory), g in zip(layers, (by_class, by_top, by_u, by_b)):
            _adapt(own, own_memory, g, rate)
        states[0] = h
    p["x"][:], p["u"][:], p["b"][:] = x * sign, u.T * sign, b * sign
    p["wc"][:], p["bc"][:], p["ww"][:], p["bw"][:] = top[:HIDDEN], top[HIDDEN], weights[:, :HIDDEN], weights[:, HIDDEN]
    return sum(length)


def score_batch(p: dict[str, np.ndarray], documents: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log-likelihood of each whole document under the network. Documents advance side by side, the longest
    first, each from a cleared state; states stay from one window to the next. Gates lie one behind the other."""
    out, kind = np.zeros(len(documents)), p["x"].dtype
    lengths = np.array([len(d) for d in documents], np.int64)
    order = np.argsort(-lengths, kind="stable")
    signs, one = np.array([-1, -1, 1], kind)[:, None, None], np.ones((), kind)
    table, u = (np.ascontiguousarray(x.reshape(-1, 3, HIDDEN).transpose(1, 0, 2) * signs) for x in (p["x"] + p["b"], p["u"]))
    top, weights, room = _with_biases(p["wc"], p["bc"]), _with_biases(p["ww"], p["bw"]), {}
    states, targets, owners = (np.empty((FULL + ABREAST, *s), k) for s, k in (((HIDDEN,), kind), ((), np.int64), ((), np.int64)))
    for some in range(0, len(order), ABREAST):
        own = order[some : some + ABREAST]
        length, joined = lengths[own], np.concatenate([documents[i] for i in own])
        starts = np.cumsum(length) - length
        total, h, before = np.zeros(len(own)), np.zeros((len(own), HIDDEN), kind), np.full(len(own), end, np.int64)
        at, held, n = 0, 0, int(np.count_nonzero(length))
        while n:
            # Steps in which the same documents go on.
            steps = min(int(length[n - 1]) - at, max(1, (FULL - held) // n))
            rows = slice(held, held + steps * n)
            now = targets[rows].reshape(steps, n)
            now[:] = joined.take(starts[:n] + np.arange(at, at + steps)[:, None])
            owners[rows].reshape(steps, n)[:] = np.arange(n)
            past = np.concatenate([before[:n], targets[rows][: (steps - 1) * n]])
            x = table.take(past, axis=1).reshape(3, steps, n, HIDDEN)
            g = _room(room, "gates", (3, n, HIDDEN), kind)
            zr, z, r, new, h = g[:2], g[0], g[1], g[2], h[:n]
            with np.errstate(over="ignore"):  # a gate of 1 / (1 + exp(-x)) with exp(-x) beyond the floats is 0
                for x_zr, x_n, state in zip(x[:2].swapaxes(0, 1), x[2], states[rows].reshape(steps, n, HIDDEN)):
                    np.matmul(h, u, out=g)
                    np.add(zr, x_zr, out=zr)
                    np.exp(zr, out=zr)
                    np.add(zr, one, out=zr)
                    np.divide(new, r, out=new)
                    np.add(new, x_n, out=new)
                    np.tanh(new, out=new)
                    np.subtract(h, new, out=state)
                    np.divide(state, z, out=state)
                    np.add(state, new, out=state)
                    h = state
            at, held, before = at + steps, held + steps * n, now[-1]
            while n and length[n - 1] == at:
                n -= 1
            if held >= FULL - n or not n:
                ones = _room(room, "states", (held, HIDDEN + 1), kind)
                ones[:, :HIDDEN], ones[:, HIDDEN] = states[:held], 1
                ll = _output(top, weights, ones, targets[:held], room)
                total += np.bincount(owners[:held], ll, minlength=len(total))
                h, before, held = h.copy(), before.copy(), 0
        out[own] = total
    return out


def network_ids(places: np.ndarray) -> np.ndarray:
    return np.where((places < 0) | (places >= SHORTLIST), OTHER, places)


def fit(training: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """All documents are dealt over the rounds, each to one; every task trains a copy on its own of the round. Copies are averaged, weighted by words, in Spark. The
    weights before the round count as ``PRIOR`` words, so that little text changes them little."""
    p = started(lexicon)
    size = len(flat(p))
    short = lexicon.words[:SHORTLIST]
    for k in range(rounds):
        now = flat(p)

        def run(batches, now=now):
            index, own, seen, held, n = pa.array(short, pa.binary()), shaped(now), 0, [], 0
            for batch in slices(batches, 4 << 20):
                places, lengths, _ = symbols(batch["text"], index)
                held += apart(network_ids(places), lengths)
                n += len(places)
                if n >= 500_000:
                    seen += train(own, held)
                    held, n = [], 0
            if held:
                seen += train(own, held)
            if seen:
                v = flat(own).astype(float) * seen
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(v), pa.array(np.full(size, float(seen)))], ["at", "v", "n"])

        some = training.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k).select("text")
        rows = some.mapInArrow(run, "at int, v double, n double").groupBy("at").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect()  # one per weight
        total, weight = PRIOR * now.astype(float), np.full(size, float(PRIOR))
        for r in rows:
            total[r["at"]] += r["v"]
            weight[r["at"]] += r["n"]
        p = shaped(total / weight)
    return p


# ---- documents
def _rare(places: np.ndarray, n: np.ndarray, split: pa.Array) -> tuple[pa.Array, pa.Array]:
    """For each text its words and ends that are not in the lexicon, each once, and how often."""
    ends = np.cumsum(n) - 1
    found, owner = np.flatnonzero(places < 0), np.repeat(np.arange(len(n)), n)
    owner = owner[found]
    is_end = found == ends[owner]
    strange = split.take(pa.array((found - owner)[~is_end])).cast(pa.binary())
    if is_end.any():
        strange = pa.concat_arrays([strange, pa.array([END] * int(is_end.sum()), pa.binary())])
        owner = np.concatenate([owner[~is_end], owner[is_end]])
    coded = strange.dictionary_encode()
    kinds = max(1, len(coded.dictionary))
    keys, times = np.unique(owner * kinds + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(keys // kinds, minlength=len(n)))]), pa.int32())
    return pa.ListArray.from_arrays(at, coded.dictionary.take(pa.array(keys % kinds))), pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document.

    Null texts are empty: one end. Repeated rows are scored each; a null doc_id counts as training and stays null.
    Without training documents every word is unknown. An empty table gives no rows; other columns are ignored.
    """
    rows = texts(docs)
    training = rows.where(~held_out(F.col("doc_id")))
    counts = word_counts(training)
    lexicon = Lexicon(counts)
    p = fit(training, lexicon)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((lexicon.words, lexicon.base, p, math.log10(lexicon.other)))
    index_here: dict[str, pa.Array] = {}

    def run(batches):
        head, base, net, other = shared.value
        index = index_here.get("index")
        if index is None:
            index = index_here["index"] = pa.array(head, pa.binary())
        by_place = np.append(base, 0.0)  # the last one is the place -1
        by_other = by_place.copy()
        by_other[: min(SHORTLIST, len(base))] = 0
        def scored_rows(held):
            documents = [d for _, ids, n in held for d in apart(ids, n)]
            ll, at = score_batch(net, documents, int(documents[0][-1])) / LN10, 0
            for (*columns, others, lists, times), _, n in held:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(others + ll[at : at + len(n)]), lists, times],
                                                 ["doc_id", "row", "n_tokens", "n_head", "head_score", "network", "rare", "times"])
                at += len(n)

        part, at, held, size, heavy = TaskContext.get().partitionId() << 33, 0, [], 0, 0
        for batch in slices(batches, 12 << 20):
            places, n, split = symbols(batch["text"], index)
            starts = np.cumsum(n) - n
            # Among other words a word has its share of theirs; that of rare ones is joined later.
            beyond = np.add.reduceat((places < 0) | (places >= SHORTLIST), starts, dtype=np.int64)
            others = np.add.reduceat(by_other[places], starts) - beyond * other
            columns = [batch["doc_id"].take(pa.array(np.arange(len(n)))),  # a copy: texts aren't kept
                       pa.array(part + at + np.arange(len(n))), pa.array(n), pa.array(np.add.reduceat(places >= 0, starts, dtype=np.int64)),
                       pa.array(np.add.reduceat(by_place[places], starts)), others, *_rare(places, n, split)]
            held.append((columns, network_ids(places).astype(np.int16), n))
            at, size, heavy = at + len(n), size + len(places), heavy + columns[-2].nbytes
            if size >= SIDE_BY_SIDE or heavy >= BYTES:
                yield from scored_rows(held)
                held, size, heavy = [], 0, 0
        if held:
            yield from scored_rows(held)

    schema = "doc_id long, row long, n_tokens long, n_head long, head_score double, network double, rare array<binary>, times array<long>"
    scored = written(rows.mapInArrow(run, schema), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    # The lexicon's own words need no join.
    least = int(lexicon.counts.min()) if len(lexicon.counts) else 0
    small = counts.where(F.col("n") < least) if least else counts
    found = rare.join(small, "word", "left")
    c = F.coalesce("n", F.lit(0))
    sums = found.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(lexicon.bulk))).alias("rare_score"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("n_rare"))
    whole = scored.drop("rare", "times").join(sums, "row", "left")
    rest = F.coalesce("rare_score", F.lit(0.0))
    return whole.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"), (F.col("head_score") + rest).alias("base_score"), (F.col("network") + rest).alias("score"))
