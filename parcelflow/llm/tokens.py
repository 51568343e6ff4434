"""Token ids of whole texts by the tokenizers library, with a memory of units.

A text is cut at single blanks, where neither public vocabulary lets a token
cross (the blank goes with the word behind it).  New words of common characters
are encoded many at a time, a line each, if the vocabulary gives a line's end an
id of its own; any other new word is cut again between runs of letters and
digits and runs of marks (with the letters that follow them).  The ids of words
and of runs are remembered in two generations: when the young one holds
``MEMO_WORDS`` or ``MEMO_RUNS`` it becomes the old one, and what is met again
moves to the young one, so frequent units are never learned again.  A text with
neighbouring white space around a blank, or with a special token's marks, is
encoded whole, and so is a word with characters beyond the Latin letters and
common marks.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

MEMO_WORDS, MEMO_RUNS = 500_000, 150_000
_RUNS = re.compile(r"\s*(?:[^\W_]+|(?:[^\w\s]|_)+[^\W_]*)|\s+")
_RARE = re.compile(r"[^\n -~\xa1-įı-ɏ–-…]")  # U+0130 lower-cased ends with a mark, which joins what follows
_PLAIN = re.compile(r" ?[!-~\xa1-ɏ–-…]+")  # no white space inside
_NEAR, _WHOLE = re.compile(r" \s"), re.compile(r"\s \s")
#: Words that the library is given as one text.
LINES = 16


class Memory:
    """Ids by unit, in two generations of about ``limit`` units each."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def new(self, units: set[str]) -> list[str]:
        """The units that are not known; the others are in the young generation now."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        new = units.difference(self.young)
        if self.old:
            again = {u: ids for u, ids in zip(new, map(self.old.get, new)) if ids is not None}
            self.young.update(again)
            new.difference_update(again)
        return list(new)


class UnitEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # A word without a blank in front stands for one with it, and the other way round.
        self.words = Memory(MEMO_WORDS)
        self.runs = Memory(MEMO_RUNS)
        self.line = self._line_end()

    def _line_end(self) -> int | None:
        """The id of a line's end, if several lines have the ids that each has."""
        lines = [" ab", "ab", "a1.", ' "c', "c's"]
        end, whole = self.whole("\n"), self.whole("\n".join(lines))
        own = len(end) == 4 and whole == end.join(map(self.whole, lines))
        return int(np.frombuffer(end, "<u4")[0]) if own else None

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_many(self, units: list[str]) -> list[bytes]:
        """The units' ids, by texts of many lines if all are ``_PLAIN``."""
        lines = self.line is not None and all(map(_PLAIN.fullmatch, units))
        texts = ["\n".join(units[i:i + LINES]) for i in range(0, len(units), LINES)] if lines else units
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        end = np.cumsum([len(x) for x in ids], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(ids), "<u4", end[-1] if len(ids) else 0)
        begin = np.concatenate([[0], end[:-1]]) if len(ids) else end
        if lines:
            at = np.flatnonzero(flat == self.line)
            end, begin = np.sort(np.concatenate([end, at])), np.sort(np.concatenate([begin, at + 1]))
        raw = flat.tobytes()
        return [raw[s:e] for s, e in zip((4 * begin).tolist(), (4 * end).tolist())]

    def _learn(self, words: list[str]) -> None:
        if self.line is not None:
            plain = list(filter(_PLAIN.fullmatch, words))
            units = [w[1:] if w[0] == " " else " " + w for w in plain]
            self.words.young.update(zip(plain, self._encode_many(units)))
            if len(plain) == len(words):
                return
            words = [w for w in words if not _PLAIN.fullmatch(w)]
        units = [w[1:] if w[:1] == " " else " " + w for w in words]
        cut = [[u] if _RARE.search(u) else _RUNS.findall(u) for u in units]
        new = self.runs.new(set(chain.from_iterable(cut)))
        runs = self.runs.young
        runs.update(zip(new, self._encode_many(new)))
        self.words.young.update(
            [(w, runs[v[0]] if len(v) == 1 else b"".join([runs[r] for r in v])) for w, v in zip(words, cut)])

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        texts = list(texts)
        cut: list[list[str] | None] = []
        need: set[str] = set()
        for t in texts:
            if not t or "<|" in t or _NEAR.search(t) and _WHOLE.search(t):
                cut.append(None)
            else:
                v = t.split(" ")
                v[0] = " " + v[0]
                need.update(v)
                cut.append(v)
        new = self.words.new(need)
        if new:
            self._learn(new)
        known = self.words.young.__getitem__
        for t, v in zip(texts, cut):
            yield b"".join(map(known, v)) if v else self.whole(t) if t else b""


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]
