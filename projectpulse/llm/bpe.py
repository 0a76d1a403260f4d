"""Byte-level BPE encoding and decoding (operator 3).

Texts are split by the public pattern (``pretokens``).  The distinct matches of a chunk are put
into buckets by length and padded into numpy matrices.  In each round every row merges its
leftmost pair of least rank: pair ranks come from an open-addressing hash table, the merged column
is compacted away, and finished rows leave the matrix.

Edge cases: a null text counts as empty and has no ids.  Very long texts are worked off in parts
that are cut where no match can lie across; a single match beyond ``MATRIX_BYTES`` goes through a
heap with the same merge order.  Rows with repeated or null ids each give a row; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from projectpulse.llm.bytesops import ragged
from projectpulse.llm.common import by_pandas, id_text, table
from projectpulse.llm.pretokens import Encoder

NO_RANK = np.int32(2**31 - 1)
MATRIX_BYTES = 2048
#: Cells of one matrix at most, which bounds its memory.
CELLS = 1 << 21


class PairTable:
    """Ranks of token pairs in an open-addressing hash table of arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (4 * len(pairs) - 1).bit_length())
        size = 1 << self.bits
        self.mask = np.int64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NO_RANK, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        ranks = np.array(list(pairs.values()), np.int32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):  # in each round the first key that asks for a free slot gets it
            at = slot[left]
            free = self.keys[at] < 0
            _, first = np.unique(at[free], return_index=True)
            won = left[free][first]
            self.keys[slot[won]] = keys[won]
            self.ranks[slot[won]] = ranks[won]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where there is none; padding (-1) has none."""
        shape = left.shape
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(len(keys), NO_RANK, np.int32)
        todo = np.flatnonzero((right.ravel() >= 0) & (left.ravel() >= 0))
        slot = self._slot(keys[todo])
        while len(todo):
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.ranks[slot[hit]]
            on = ~hit & (there >= 0)
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        return out.reshape(shape)


class Vocabulary:
    """Ranks of byte strings, the pairs that they merge, and the bytes of every id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.pairs, self.table = pairs, PairTable(pairs)
        by_id = {rank: token for token, rank in ranks.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all byte strings, joined, and how many each has."""
        ids = self.encode_each(words)
        return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))

    def encode_each(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each byte string: a token of its own, or what the merges leave."""
        out: list = [None] * len(words)
        buckets: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            rank = self.ranks.get(w)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(w) > MATRIX_BYTES:
                out[i] = self._long(w)
            else:
                width = 4
                while width < len(w):
                    width += max(4, width // 4)
                buckets.setdefault(width, []).append(i)
        for width, rows in buckets.items():
            step = max(1, CELLS // width)
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                for i, ids in zip(part, self._matrix([words[j] for j in part], width)):
                    out[i] = ids
        return out

    def _matrix(self, words: list[bytes], width: int) -> list[np.ndarray]:
        n = len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        cells = np.full((n, width), -1, np.int32)
        flat = np.frombuffer(b"".join(words), np.uint8)
        cells[np.repeat(np.arange(n), lengths), ragged(np.zeros(n, np.int64), lengths)] = self.byte_ids[flat]
        ranks = self.table.lookup(cells[:, :-1], cells[:, 1:])
        rows, out = np.arange(n), [None] * n
        while len(rows):
            each = np.arange(len(rows))
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[each, at] if ranks.shape[1] else np.full(len(rows), NO_RANK)
            done = best == NO_RANK
            if done.any():
                kept = cells[done]
                sizes = (kept >= 0).sum(axis=1).tolist()
                for i, ids, size in zip(rows[done].tolist(), kept, sizes):
                    out[i] = ids[:size]
                rows, cells, ranks, at, best = rows[~done], cells[~done], ranks[~done], at[~done], best[~done]
                if not len(rows):
                    break
                each = np.arange(len(rows))
            cells[each, at] = best
            column = np.arange(cells.shape[1] - 1)
            cells = np.where(column <= at[:, None], cells[:, :-1], cells[:, 1:])
            ranks = np.where(column[:-1] < at[:, None], ranks[:, :-1], ranks[:, 1:])
            for side in (at - 1, at):  # the two pairs that hold the new token
                ok = np.flatnonzero((side >= 0) & (side < ranks.shape[1]))
                ranks[ok, side[ok]] = self.table.lookup(cells[ok, side[ok]], cells[ok, side[ok] + 1])
        return out

    def _long(self, word: bytes) -> np.ndarray:
        """The same merges for one long byte string, by a heap over linked tokens."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (q := pairs.get((r, ids[k]))) is not None:
                    heapq.heappush(heap, (q, i, r, ids[k]))
            h = before[i]
            if h >= 0 and (q := pairs.get((ids[h], r))) is not None:
                heapq.heappush(heap, (q, h, ids[h], r))
        return np.array([x for x in ids if x >= 0], np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids, joined."""
        return self.bytes[ragged(self.offsets[ids], self.sizes[ids])].tobytes()


@cache
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def encoded(texts: Iterable[str | None], vocab: Vocabulary, encoder: Encoder) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Parts of the ids of each text, in order (see ``Encoder.stream``)."""
    yield from encoder.stream([t or "" for t in texts])


def encode_column(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids`` (array of int) of every whole text."""
    def run(batches):
        vocab = vocabulary(ranks_path)
        encoder = Encoder(vocab.encode)
        for pdf in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(len(pdf))]
            for i, ids, _ in encoded(pdf["text"], vocab, encoder):
                parts[i].append(ids)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [np.concatenate(p).astype(np.int32) for p in parts]})
    return by_pandas(id_text(docs, id_col, text_col), run, "ids array<int>")


def decode_column(encoded_docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and ``bytes`` of every row of (doc_id, ids)."""
    def run(batches):
        vocab = vocabulary(ranks_path)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "bytes": [vocab.decode(np.asarray(i, np.int64)) for i in pdf["ids"]]})
    return by_pandas(encoded_docs, run, "bytes binary")


def digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass and return the digests of ids and decoded bytes;
    the parts of a long text go through one after the other."""
    def run(batches):
        vocab = vocabulary(ranks_path)
        encoder = Encoder(vocab.encode)
        for pdf in batches:
            rows, count, of_ids, of_bytes = [], 0, hashlib.sha256(), hashlib.sha256()
            for _, ids, last in encoded(pdf["text"], vocab, encoder):
                count += len(ids)
                of_ids.update(ids.astype("<u4").tobytes())
                of_bytes.update(vocab.decode(ids.astype(np.int64)))
                if last:
                    rows.append((count, of_ids.hexdigest(), of_bytes.hexdigest()))
                    count, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), out], axis=1)
    return by_pandas(id_text(docs, id_col, text_col), run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
