"""Personal data, token alignment and phrases against brute force and awkward rows."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.test_operators import AWKWARD, awkward, docs, empty  # noqa: F401
from tidewick.llm import align, phrases, pii, queries, tokens


# ---- 11
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def slow_spans(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and slow_luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return [(a, b, pii.KINDS[k]) for a, k, b in sorted(out)]


ODD = ["", "a@b.c@d.e", "x@y", "@a.b", "a@-.-", "a@b..c", "a.b@c.d.", "1.2.3.4.5.6.7.8", "1.2.3", "256.1.1.1 0255.1.1.1", "1.2.3.4.", "4111 1111-1111 1111", "4111  1111 1111 1111",
       "4111111111111112", "+1 (386) 555-3733", "+1((((((", "+12345678901 +49 (0) 30-1234567-", "é@ü.de ä1@x.yz", "++1 234 567 8901", "٣٣٣.1.1.1", "a@b.c,d@e.f", "4111-1111-1111-1111@x.de"]


@pytest.mark.parametrize("text", ODD)
def test_fixed_spans_of_odd_texts(text):
    assert pii.fixed_spans(text) == slow_spans(text)


def test_fixed_spans_of_random_texts():
    rng = np.random.default_rng(3)
    for _ in range(4000):
        text = "".join(rng.choice(list("1234 5-.@+()ab,"), rng.integers(0, 60)))
        assert pii.fixed_spans(text) == slow_spans(text), text
    assert pii.fixed_spans("1" * 300_000 + " " + "a." * 200_000 + " " + "@" * 100_000) == []


def test_personal_data_query(spark, docs):  # noqa: F811
    got = {r.doc_id: r for r in queries.QUERIES["op11_field_personal"](spark, SF).collect()}
    found = 0
    for r in docs.collect():
        want, mine = slow_spans(r.text or ""), got.pop(r.doc_id)
        assert [mine[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in want) for k in pii.KINDS]
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert mine.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) <= set(mine.spans.split(","))
        found += len(want)
        if not re.search("[0-9@]", r.text or ""):
            assert mine.spans == ""
    assert not got and found > 10


def test_field_gradient_and_decoding_by_enumeration():
    rng = np.random.default_rng(0)
    names = [f"f{k}" for k in range(6)]
    field = pii.Field(names, 3)
    field.emit, field.move = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    field.emit[-1] = 0
    some = [[[names[k] for k in rng.choice(6, 2, replace=False)] for _ in range(n)] for n in (1, 4, 2, 3)]
    labels = [[int(x) for x in rng.integers(0, 3, len(c))] for c in some]
    numbers, sizes = field.padded(some)
    y = np.zeros(numbers.shape[:2], int)
    for k, own in enumerate(labels):
        y[k, : len(own)] = own

    def weight(chain, path):
        rows = [sum(field.emit[field.names[f]] for f in fs) for fs in chain]
        return sum(r[p] for r, p in zip(rows, path)) + sum(field.move[a, b] for a, b in zip(path, path[1:]))

    paths, sure = field.decode(some)
    value, emit, move = field.gradient(numbers, sizes, y, 0.01)
    want = 0.0
    for chain, own, path, p in zip(some, labels, paths, sure):
        every = {q: weight(chain, q) for q in product(range(3), repeat=len(chain))}
        total = np.log(sum(np.exp(list(every.values()))))
        assert tuple(path) == max(every, key=every.get)
        assert np.allclose(p, [sum(np.exp(w - total) for q, w in every.items() if q[t] == path[t]) for t in range(len(chain))])
        want += total - every[tuple(own)]
    assert np.isclose(value, want / 4 + 0.005 * ((field.emit**2).sum() + (field.move**2).sum()))
    for grad, w in ((emit, field.emit), (move, field.move)):
        for at in np.ndindex(w.shape):
            if grad is emit and at[0] == 6:
                continue
            old, around = w[at], []
            for step in (1e-5, -1e-5):
                w[at] = old + step
                around.append(field.gradient(numbers, sizes, y, 0.01)[0])
            w[at] = old
            assert np.isclose((around[0] - around[1]) / 2e-5, grad[at], atol=1e-6)


def test_field_adds_what_patterns_miss_and_leaves_numbers_alone(spark):
    rng = np.random.default_rng(1)
    made = []
    for i in range(400):
        d = "".join(map(str, rng.integers(0, 10, 10)))
        made.append((i, f"call +1 ({d[:3]}) 555-{d[3:7]} now, mail q{d[:2]}.{d[2:4]}@mail{d[4]}.example.com or see {d[:4]} items, 3.{d[5]} and v{d[6:]} of 20{d[:2]}"))
    some = spark.createDataFrame(made, "doc_id long, text string")
    field = pii.fit(pii.labelled(some))
    fresh = "phone (212) 555-0199 please, not 1234 items nor 3.1 of 2024"
    plain = "in 2024 there were 1234 items, 3.5 of v8071 and 17"
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame([(1, fresh), (2, plain)], "doc_id long, text string"), field).collect()}
    assert rows[1].n_phone == 0 and rows[1].spans == f"phone:{fresh.index('(')}:{fresh.index(' please')}"
    assert rows[2].spans == ""


def test_personal_data_awkward(spark, awkward, empty):  # noqa: F811
    field = pii.fit(pii.labelled(awkward))
    got = pii.find(awkward, field).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, *_ in AWKWARD)
    assert pii.find(empty, pii.fit(pii.labelled(empty))).count() == 0
    long = spark.createDataFrame([(1, "7 " * 200_000), (2, "9" * 500_000), (3, "a@b.co " * 50_000)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_email) for r in pii.find(long, field).collect()) == [(1, 0), (2, 0), (3, 50_000)]
    nothing = pii.fit(pii.labelled(empty))
    assert [r.spans for r in pii.find(spark.createDataFrame([(1, "5 6 a@b.co")], "doc_id long, text string"), nothing).collect()] == ["email:4:10"]


# ---- 12
@pytest.fixture(scope="module")
def both_sides():
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.vocabulary())
    tok.encode_special_tokens = True
    side = align.ByteSide(tokens.vocabulary())
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary(align.PIECES))

    def slow(text):
        spelt = (" " + text).encode() if text else b""
        a, b = (tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        bytes_a = [side.bytes_of[k] for k in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, b)]
        if b"".join(bytes_a) != spelt or b"".join(bytes_b) != spelt or not text:
            return [], [], [], []
        ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
        links = [(i, j) for i, e in enumerate(ends_a) for j in [ends_b.index(e) if e in set(ends_b) else -1] if j >= 0]
        groups, i0, j0 = [], 0, 0
        for i, j in links:
            groups.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
            i0, j0 = i + 1, j + 1
        return a, b, groups, [(a[i], b[j]) for i, j in links]

    return slow


def slow_alignment(some, slow):
    each = [(i, *slow(t)) for i, t in some]
    counts = Counter(p for *_, links in each for p in links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted((i or -1, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                   hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "") for i, a, b, groups, links in each)


def aligned_rows(df):
    return sorted((r[0] or -1, *r[1:]) for r in map(tuple, df.collect()))


@pytest.mark.parametrize("small", [10**6, 0])
def test_alignment_equals_brute_force(spark, docs, both_sides, small):  # noqa: F811
    some = [(r.doc_id, r.text) for r in docs.collect()]
    got = align.align(docs, small=small)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert aligned_rows(got) == slow_alignment(some, both_sides)


ODD_TEXTS = [None, "", " ", "a", " a", "a ", "a  b", "é中文 ü", "x▁y", "<|endoftext|> <s> </s>", "a\nb\r\nc", "\t;\r x", "\x00 \x01", "don't 12,345 '' s", "ﬁ① ½ é", "🙂🙂 🙂", "a b　c", "\n", "   ", "ab" * 3000]


@pytest.mark.parametrize("small", [10**6, 0])
def test_alignment_of_odd_texts(spark, awkward, empty, both_sides, monkeypatch, small):  # noqa: F811
    monkeypatch.setattr(align, "WORDS", 2)
    some = list(enumerate(ODD_TEXTS, 1)) + [(i, t) for i, t, *_ in AWKWARD if t is None or len(t) < 1000]
    made = spark.createDataFrame(some, "doc_id long, text string").selectExpr("*", "1 AS part", "'x' AS row", "2 AS pairs")
    assert aligned_rows(align.align(made, small=small)) == slow_alignment(some, both_sides)
    assert align.align(awkward, small=small).count() == len(AWKWARD) and align.align(empty, small=small).count() == 0


def test_lockstep_lanes_link_alike():
    rng = np.random.default_rng(2)
    ends, starts = [[], []], [[0], [0]]
    for n in (1, 0, 5000, 40, 3):
        for side, share in ((0, 0.5), (1, 0.4)):
            inner = np.flatnonzero(rng.random(3 * n) < share) + 1
            own = np.union1d(inner[inner < 3 * n], [3 * n] if n else [])
            ends[side].append(own + 10**6 * len(starts[side]))
            starts[side].append(starts[side][-1] + len(own))
    a, b = (np.concatenate(e) for e in ends)
    want = sorted((int(i), int(np.flatnonzero(b == x)[0])) for i, x in enumerate(a) if x in set(b.tolist()))
    for lane in (1, 7, 100, 10**6):
        got = align.merged(a, b, *align.lanes(a, b, np.array(starts[0]), np.array(starts[1]), lane))
        assert sorted(zip(*map(np.ndarray.tolist, got))) == want


# ---- 13
def slow_phrases(some, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in some:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i : i + k])) for k in (1, 2, 3) for i in range(len(ws) - k + 1))
    out = defaultdict(list)
    longest = defaultdict(int)
    for (lang, p), a in f.items():
        if len(p) == 3 and a >= least:
            for q in (p[:2], p[1:]):
                longest[lang, q] = max(longest[lang, q], a)
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least and not 100 * longest[lang, p] >= share * a > 0:
            score, _, l, r = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -score) for lang, some in out.items() for rank, (score, a, p, l, r) in enumerate(sorted(some)[:top], 1))


def phrase_rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("ranges, chunk, top", [(1, 1 << 20, 2000), (60, 700, 2000), (7, 50, 5)])
def test_phrases_equal_brute_force(spark, docs, monkeypatch, ranges, chunk, top):  # noqa: F811
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    want = slow_phrases([(r.lang, r.text) for r in docs.collect()], top=top)
    assert len(want) > 4 and phrase_rows(phrases.collocations(docs, top=top, ranges=ranges)) == want


def test_phrases_of_hot_words_and_pairs(spark):
    """A third of all words are one word, and one pair goes before many different words."""
    made = [("en", f"hot hot hot hot and also x{i % 7} then hot pair y{i} goes. On\tand on; hot pair y{i % 3}!") for i in range(400)]
    made += [(None, "Ä ä Ä ä, Zed zed ZED"), ("", "a b a b a b"), ("fr", None), ("fr", " \t .,;")] * 12
    some = spark.createDataFrame(made, "lang string, text string").repartition(8)
    want = slow_phrases(made)
    for ranges in (1, 16, 200):
        assert phrase_rows(phrases.collocations(some, ranges=ranges)) == want


def test_phrases_awkward(awkward, empty, spark):  # noqa: F811
    some = awkward.unionByName(awkward).unionByName(awkward).unionByName(awkward)
    want = slow_phrases([(lang, t) for _, t, lang, _ in AWKWARD] * 4)
    assert want and phrase_rows(phrases.collocations(some)) == want
    assert phrases.collocations(empty).count() == 0


def test_equal_partitions_are_counts():
    rng = np.random.default_rng(4)
    keys = rng.zipf(1.5, (3, 5000)) % 30 + 1
    keys[1, rng.random(5000) < 0.2] = 0
    keys[2, (keys[1] == 0) | (rng.random(5000) < 0.2)] = 0
    times = rng.integers(1, 4, 5000)
    want = Counter()
    for col, k in zip(keys.T.tolist(), times.tolist()):
        for n in (1, 2, 3):
            if all(col[:n]):
                want[tuple(col[:n])] += k
    got = {tuple(keys[:n, at].tolist()): size for n, at, size in phrases.equal_partitions(keys, times, 10)}
    assert got == {p: k for p, k in want.items() if k >= 10}
