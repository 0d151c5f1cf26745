"""Token ids of whole texts by a public byte-level BPE file."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import regex

END_ID = 0  # appended to every document
VOCABULARY = "byte_bpe_50k.json"

# Before a single space, and on both sides of a single line end, the tokenizer always starts a new piece, so a text can
# be encoded word by word and equal words once. Other white space next to those breaks that; such texts are encoded as
# they are.
_UNSAFE = re.compile(r"\s \s|\s \Z|\s\n|\n\s|\n\Z|\A\n")
_OTHER_SPACE = re.compile(r"[^\S \n]")
# Words of these characters (assigned in Unicode long ago) are cut into the tokenizer's pieces here and go straight to its
# model; all others pass through the tokenizer as a whole.
_SIMPLE = re.compile(r"\n?[!-~¡-ɏ]*")
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TOGETHER = 1 << 20  # characters of texts split into words at a time
_KNOWN: dict[tuple[str, bool], "WordIds"] = {}


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others by
    the letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def slices(texts: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Runs of texts of at most ``limit`` characters (one text at least)."""
    some, total = [], 0
    for t in texts:
        if some and total + len(t) > limit:
            yield some
            some, total = [], 0
        some.append(t)
        total += len(t)
    if some:
        yield some


def in_words(text: str) -> bool:
    """False where the text has to be encoded as a whole (plain searches settle all but rare texts)."""
    if _OTHER_SPACE.search(text):
        return not _UNSAFE.search(text)
    return not (" \n" in text or "\n " in text or "\n\n" in text or "   " in text or text.startswith("\n") or text.endswith(("\n", "  ")))


class Known(dict):
    """Ids of words with ``before`` before them. Marks after letters are a piece of their own, as is a line end: such
    words are put together from what is kept. Those with marks are kept besides, and can be let go again by themselves."""

    def __init__(self, owner: WordIds, before: str):
        self.owner, self.before, self.marked = owner, before, []
        self.space = owner.letters[ord(" ")] if before else ""

    def __missing__(self, word: str) -> bytes:
        own = self.owner
        if own.plain_words and word.isascii():
            if word.isalpha():  # no special token can be inside
                ids = self[word] = own._model_ids(self.space + word)
                return ids
            stem = word.rstrip(_MARKS)
            if stem.isalpha():
                marks = word[len(stem) :]
                return self._with_marks(word, self[stem] + (own.pieces.get(marks) or own._piece(marks)))
        if not own.direct or not _SIMPLE.fullmatch(word) or own.special and own.has_special(word):
            ids = own._encode([word if word[:1] == "\n" else self.before + word])[0]
        elif word[:1] == "\n":
            return own._piece("\n") + own.first[word[1:]] if len(word) > 1 else own._piece(word)
        else:
            stem = word.rstrip(_MARKS)
            if not stem.isalpha():
                ids = b"".join(map(own._piece, own.cut(self.before + word)))
            elif len(stem) < len(word):
                return self._with_marks(word, self[stem] + own._piece(word[len(stem) :]))
            else:
                ids = own._model_ids(self.space + own._spelt(word))
        self[word] = ids
        return ids

    def _with_marks(self, word: str, ids: bytes) -> bytes:
        self[word] = ids
        self.marked.append(word)
        return ids

    def forget_marked(self) -> None:
        for word in self.marked:
            self.pop(word, None)
        self.marked.clear()

    def clear(self) -> None:
        super().clear()
        self.marked.clear()


class WordIds:
    """Ids (little-endian, 4 bytes) of words met so far. Memory is bounded: with more than ``most`` words it starts anew,
    with a third as many that have marks behind them besides, it forgets those.
    With ``plain``, strings of special tokens inside a text are ordinary text."""

    def __init__(self, path: str, most: int = 300_000, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.tokenizer.encode_special_tokens = plain
        self.many = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.model = self.tokenizer.model
        form = json.loads(self.tokenizer.to_str())
        before = form["pre_tokenizer"] or {}
        self.direct = form["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        self.special = [] if plain else [t["content"] for t in form["added_tokens"]]
        self.has_special = re.compile("|".join(map(re.escape, self.special))).search
        self.plain_words = self.direct and not any(t.rstrip(_MARKS).isalpha() or not t.rstrip(_MARKS) for t in self.special)
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = dict(enumerate(byte_letters()))
        self.first = Known(self, "")  # words that begin a text or a line
        self.later = Known(self, " ")  # words after a space, or with a line end before them
        self.pieces: dict[str, bytes] = {}

    def __len__(self) -> int:
        return len(self.first) + len(self.later) - self._marked()

    def _marked(self) -> int:
        return len(self.first.marked) + len(self.later.marked)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.many(texts, add_special_tokens=False)]

    def _spelt(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.letters)

    def _model_ids(self, spelt: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.pieces[piece] = self._model_ids(self._spelt(piece))
        return ids

    def _bound(self) -> None:
        if len(self) > self.most:
            self.first.clear()
            self.later.clear()
        if self._marked() > self.most // 3:
            self.first.forget_marked()
            self.later.forget_marked()
        if len(self.pieces) > self.most // 3:
            self.pieces.clear()

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words after a space, or with a line end before them; those after a space are not remembered."""
        self._bound()
        return list(map(Known(self, " ").__getitem__, words))

    def _some(self, texts: list[str]) -> list[bytes]:
        self._bound()
        out, first, later = [], self.first.__getitem__, self.later.__getitem__
        for t in texts:
            if in_words(t):
                begin, *after = t.replace("\n", " \n").split(" ")
                out.append(first(begin) + b"".join(map(later, after)))
            else:
                out.append(None)
        rest = iter(self._encode([t for t, ids in zip(texts, out) if ids is None]))
        return [next(rest) if ids is None else ids for ids in out]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without an end id."""
        return list(chain.from_iterable(map(self._some, slices(texts, _TOGETHER))))


def encoder(path: str, plain: bool = False) -> WordIds:
    """One per Python worker and file."""
    if (path, plain) not in _KNOWN:
        _KNOWN[path, plain] = WordIds(path, plain=plain)
    return _KNOWN[path, plain]


def document_ids(texts: list[str], path: str, end: int = END_ID) -> list[bytes]:
    """Ids of each whole text with the end id, as little-endian unsigned 32-bit numbers."""
    tail = int(end).to_bytes(4, "little")
    return [ids + tail for ids in encoder(path).encode_all(texts)]
