"""Words with marks behind them are kept by the tokenizer's table of words."""

from tidewick.llm import tokens


def test_words_with_marks_are_looked_up_once(monkeypatch):
    known, text = tokens.WordIds(tokens.vocabulary()), "Yes, no. Häuser; yes, (no) no. Häuser; Yes, no."
    first, missed, plain = known.encode_all([text]), [], tokens.Known.__missing__
    monkeypatch.setattr(tokens.Known, "__missing__", lambda self, word: missed.append(word) or plain(self, word))
    assert known.encode_all([text]) == first == known._encode([text]) and not missed


def test_kept_words_with_marks_are_bounded():
    known = tokens.WordIds(tokens.vocabulary(), most=90)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(60):
        text = " ".join(f"{letters[k % 26]}{a}{mark}" for a in letters[: 1 + k % 5] for mark in (",", ".", ";", "!", "?", ":", "...", "?!"))
        assert known.encode_all([text]) == known._encode([text])
        assert known._marked() <= 90 // 3 + 40 and len(known.later) + len(known.first) == len(known) + known._marked()
