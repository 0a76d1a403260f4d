"""Vectorised work on the bytes of many texts at once: polynomial hashes of any span in constant time.

The hash of bytes b0..bk-1 is the sum of code[bi] * BASE**i modulo 2**64, where ``code`` holds 256
random odd numbers.  Prefix sums give the hash of every span; ``mix`` spreads its bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
#: Texts are handled in chunks of about this many bytes; a longer text is cut or gets a chunk alone.
CHUNK = 1 << 18

_TABLES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte codes, and powers of the base and of its inverse up to at least ``n``."""
    if seed not in _TABLES or len(_TABLES[seed][1]) <= n:
        size = max(n, CHUNK + (CHUNK >> 1)) + 1
        code = np.random.default_rng(seed).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = (BASE + 4 * seed) | 1
        both = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _TABLES[seed] = (code, *both)
    return _TABLES[seed]


class Spans:
    """Hashes of spans of ``buf`` (uint8)."""

    def __init__(self, buf: np.ndarray, seed: int = 0):
        code, up, self.down = _tables(len(buf), seed)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(code[buf] * up[:len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, size: int) -> np.ndarray:
        """The hash of every span of ``size`` bytes, by its start."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def chunks(texts: Iterable[bytes], size: int = CHUNK) -> Iterator[tuple[list[int], list[bytes]]]:
    """Groups of whole texts with their numbers, of about ``size`` bytes in all."""
    at, held, total = [], [], 0
    for i, t in enumerate(texts):
        if held and total + len(t) > size:
            yield at, held
            at, held, total = [], [], 0
        at.append(i)
        held.append(t)
        total += len(t)
    if held:
        yield at, held


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer, and where each text starts (with the end at last)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer(b"".join(texts), np.uint8), starts


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """Words of bytes, as hashes.  ``gap`` is a class of bytes (for a regular expression) that part
    words; A-Z are lower-cased."""

    def __init__(self, gap: bytes = rb"\x20\x09-\x0D"):
        self.is_gap = np.array([re.fullmatch(rb"[" + gap + rb"]", bytes([b])) is not None for b in range(256)])
        self.end = re.compile(rb"(?<=[^" + gap + rb"])[" + gap + rb"]")

    def pieces(self, text: bytes, size: int = CHUNK) -> list[bytes]:
        """The text in pieces of about ``size`` bytes, cut after a word; a longer word stays whole."""
        out, at = [], 0
        while len(text) - at > size:
            m = self.end.search(text, at + size)
            if m is None:
                break
            out.append(text[at:m.start()])
            at = m.start()
        out.append(text[at:])
        return out

    def _hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        buf, starts = joined(texts)
        if not len(buf):
            return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
        buf = _LOWER[buf]
        inside = ~self.is_gap[buf]
        fresh = np.zeros(len(buf) + 1, bool)  # a text starts here
        fresh[starts] = True
        before = np.concatenate([[False], inside[:-1]])
        after = np.concatenate([inside[1:], [False]])
        begin = np.flatnonzero(inside & (~before | fresh[:-1]))
        end = np.flatnonzero(inside & (~after | fresh[1:])) + 1
        return Spans(buf).of(begin, end), np.diff(np.searchsorted(begin, starts))

    def stream(self, texts: Iterable[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """For groups of whole texts: their numbers, the hashes of all their words in order, and how
        many words each has."""
        for numbers, group in chunks(texts):
            if len(group) == 1 and len(group[0]) > CHUNK:
                parts = [self._hashes([p])[0] for p in self.pieces(group[0])]
                hashes = np.concatenate(parts)
                yield numbers, hashes, np.array([len(hashes)])
            else:
                yield numbers, *self._hashes(group)

    def of(self, words: list[str]) -> np.ndarray:
        """Hashes of single words."""
        return self._hashes([w.encode() for w in words])[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..start+length-1."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
