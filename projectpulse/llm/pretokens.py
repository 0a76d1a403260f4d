"""Splitting texts into the pieces that byte-level BPE encodes one by one, for many texts at once.

The pattern of public tokenizers (contractions; an optional space before a run of letters, of
numbers or of other signs; white space) is decided by character classes alone, so it is computed
on arrays of code points.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex

from projectpulse.llm.bytesops import Spans, ragged

#: Texts are split in chunks of about this many characters.
CHUNK = 1 << 21
LETTER, NUMBER, SPACE, OTHER = range(4)
_CUT = re.compile(r"(?<=\S)[ \n]")
# The contractions of the public pattern.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


@cache
def classes() -> np.ndarray:
    """The class of every code point, from the Unicode tables."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, points):
            a, b = ord(m[0][0]), ord(m[0][-1])
            if b - a + 1 == len(m[0]):
                out[a:b + 1] = kind
            else:  # the run goes over the gap of the surrogates
                out[[ord(c) for c in m[0]]] = kind
    return out


def text_pieces(text: str, size: int = CHUNK) -> list[str]:
    """The text in pieces of about ``size`` characters, cut where white space follows something
    else: no match goes over such a place.  A longer run stays whole."""
    out, at = [], 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if m is None:
            break
        out.append(text[at:m.start()])
        at = m.start()
    out.append(text[at:])
    return out


def match_starts(points: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where the matches start in the code points of joined texts; ``fresh`` is true where a text starts."""
    n = len(points)
    kind = classes()[points]
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) | fresh[1:]
    runs = np.flatnonzero(change)
    ends = np.append(runs[1:], n)
    start = change.copy()
    space = kind[runs] == SPACE
    closed = np.append(fresh[ends[:-1]], True)  # the text ends with this run
    # The last sign of a longer white-space run goes with what follows, or stands alone.
    start[ends[space & ~closed & (ends - runs > 1)] - 1] = True
    # A plain space before a run belongs to it.
    held = runs[~space & (runs > 0) & ~fresh[runs]]
    start[held[points[held - 1] == 32]] = False
    # Contractions: a lone apostrophe that starts a match, before letters.
    lone = runs[(ends - runs == 1) & (points[runs] == 39)]
    lone = lone[start[lone]]
    lone = lone[lone + 1 < n]
    lone = lone[(kind[lone + 1] == LETTER) & ~fresh[lone + 1]]
    if len(lone):
        padded = np.append(points, np.zeros(2, points.dtype))
        letters = np.append(kind == LETTER, [False, False])
        new = np.append(fresh, [True, True])
        one, two = padded[lone + 1], padded[lone + 2]
        same = letters[lone + 2] & ~new[lone + 2]
        for suffix in SUFFIXES:
            hit = one == ord(suffix[0])
            if len(suffix) == 2:
                hit &= same & (two == ord(suffix[1]))
            at = lone[hit]
            start[at + 1] = False
            after = at + 1 + len(suffix)
            after = after[(after < n)]
            start[after] = True  # the rest of the letters, or what starts a match anyway
    return np.flatnonzero(start)


class Split:
    """The matches of some texts: ``codes`` (number of the distinct match) in order, ``per_text``
    (matches of each text) and ``distinct`` (the bytes of each distinct match)."""

    def __init__(self, texts: list[str]):
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le", "replace"), np.uint32)
        data = whole.encode("utf-8", "replace")
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=starts[1:])
        fresh = np.zeros(len(points) + 1, bool)
        fresh[starts] = True
        begin = match_starts(points, fresh[:-1]) if len(points) else np.zeros(0, np.int64)
        self.per_text = np.diff(np.searchsorted(begin, starts))
        buf = np.frombuffer(data, np.uint8)
        at = np.flatnonzero((buf & 0xC0) != 0x80) if len(buf) != len(points) else None
        begin = begin if at is None else at[begin]
        end = np.append(begin[1:], len(buf)) if len(begin) else begin
        keys = Spans(buf).of(begin, end) if len(begin) else np.zeros(0, np.uint64)
        self.codes, unique = pd.factorize(keys)
        first = np.empty(len(unique), np.int64)
        first[self.codes[::-1]] = np.arange(len(begin))[::-1]
        length = end - begin
        if len(begin):  # equal hashes must be equal bytes
            same = length == length[first][self.codes]
            if not same.all() or not (buf[ragged(begin, length)] == buf[ragged(begin[first][self.codes], length)]).all():
                words = [data[a:b] for a, b in zip(begin, end)]
                self.codes, unique = pd.factorize(np.array(words, dtype=object))
                self.distinct = list(unique)
                return
        self.distinct = [data[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]


class Encoder:
    """Ids of whole texts.  Distinct matches are encoded once and remembered; beyond ``keep`` of them
    the memory starts anew.  ``encode`` takes byte strings and returns their ids joined, and the
    number of ids of each."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], keep: int = 500_000):
        self.encode, self.keep = encode, keep
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.filled = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        ids, sizes = self.encode(words)
        n, m = len(self.known), len(ids)
        while self.filled + m > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(words) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.filled:self.filled + m] = ids
        self.start[n:n + len(words)] = self.filled + np.cumsum(sizes) - sizes
        self.size[n:n + len(words)] = sizes
        self.filled += m
        self.known.update(zip(words, range(n, n + len(words))))

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) of the texts in order, and the number of ids of each text."""
        split = Split(texts)
        if len(self.known) > self.keep:
            self._clear()
        numbers, first = list(map(self.known.get, split.distinct)), len(self.known)
        unseen = [w for w, k in zip(split.distinct, numbers) if k is None]
        if unseen:
            self._learn(unseen)
            fresh = iter(range(first, len(self.known)))  # numbers go on in the order of the words
            numbers = [next(fresh) if k is None else k for k in numbers]
        at = np.array(numbers, np.int64)[split.codes]
        lengths = self.size[at]
        ids = self.flat[ragged(self.start[at], lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum(split.per_text)])
        return ids, np.diff(sums[bounds])

    def stream(self, texts: list[str], size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(number of the text, some of its ids in order, whether these are its last): whole texts,
        a long one in several parts."""
        held: list[tuple[int, str, bool]] = []
        total = 0

        def flush():
            ids, counts = self.ids([p for _, p, _ in held])
            ends = np.cumsum(counts)
            for (i, _, last), a, b in zip(held, ends - counts, ends):
                yield i, ids[a:b], last
        for i, text in enumerate(texts):
            parts = text_pieces(text, size)
            for k, p in enumerate(parts):
                if held and total + len(p) > size:
                    yield from flush()
                    held, total = [], 0
                held.append((i, p, k == len(parts) - 1))
                total += len(p)
        if held:
            yield from flush()
