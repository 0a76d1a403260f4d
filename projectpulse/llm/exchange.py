"""Counting keys across all shards of a corpus in blocks of arrays.

A shard sends each reducer one block: the sorted distinct 64-bit keys that fall into the reducer's
range, with counts.  The reducer merges the blocks of all shards and answers each block with values
in the order of its keys.  Keys are hashes, so the ranges are even, and a key that is everywhere is
one entry in each block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd


def pack_counts(values: np.ndarray) -> bytes:
    """Non-negative numbers in one byte each, and those from 255 up in four or eight more at the end."""
    large = values[values >= 255]
    wide = len(large) > 0 and int(large.max()) >= 1 << 32
    head = np.array([len(values) * 2 + wide], "<u8")
    return head.tobytes() + np.minimum(values, 255).astype(np.uint8).tobytes() + large.astype("<u8" if wide else "<u4").tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    n, wide = divmod(int(np.frombuffer(data, "<u8", count=1)[0]), 2)
    out = np.frombuffer(data, np.uint8, count=n, offset=8).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8" if wide else "<u4", offset=8 + n)
    return out


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, in as many bytes as the greatest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps[1:].max()).bit_length() + 7) // 8) if len(keys) > 1 else 1
    rest = steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + steps[:1].astype("<u8").tobytes() + rest.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    rest = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(rest) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(data, np.uint8, count=8, offset=1)
    steps[1:, :width] = rest
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


class Blocks:
    """Requests and replies between shards and ``reducers`` ranges of keys."""

    REQUEST_COLUMNS = ["reducer", "tag", "shard", "keys", "first", "second"]
    REQUEST_SCHEMA = "reducer int, tag int, shard int, keys binary, first binary, second binary"
    REPLY_COLUMNS = ["shard", "tag", "reducer", "first", "second"]
    REPLY_SCHEMA = "shard int, tag int, reducer int, first binary, second binary"

    values = staticmethod(unpack_counts)

    def __init__(self, reducers: int):
        self.reducers = reducers

    def _bounds(self, keys: np.ndarray) -> np.ndarray:
        edges = np.array([(k << 64) // self.reducers for k in range(1, self.reducers)], np.uint64)
        return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)

    def requests(self, shard: int, tag: int, keys: np.ndarray, first: np.ndarray, second: np.ndarray | None = None) -> list[tuple]:
        """Blocks of sorted distinct keys with one or two counts each."""
        at = self._bounds(keys)
        return [(r, tag, shard, pack_keys(keys[a:b]), pack_counts(first[a:b]), pack_counts(second[a:b]) if second is not None else b"")
                for r, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]

    @staticmethod
    def merge(group: pd.DataFrame) -> tuple[list[np.ndarray], Callable[..., list[tuple]]]:
        """The sums of the counts of each distinct key of one reducer and tag, in key order; and a function
        that turns values in that order into the replies to all blocks."""
        keys = [unpack_keys(k) for k in group["keys"]]
        sizes = np.array([len(k) for k in keys])
        unique, code = np.unique(np.concatenate(keys), return_inverse=True)
        count, code = len(unique), code.astype(np.int32)
        del keys, unique
        sums = []
        for c in ("first", "second"):
            if (group[c].str.len() > 0).any():
                total, at = np.zeros(count, np.int64), 0
                for data, size in zip(group[c], sizes):  # the keys of a block are distinct
                    total[code[at:at + size]] += unpack_counts(data)
                    at += size
                sums.append(total)
        ends = np.cumsum(sizes)
        where = list(zip(group["shard"], group["tag"], group["reducer"], ends - sizes, ends))

        def spread(first: np.ndarray, second: np.ndarray | None = None) -> list[tuple]:
            return [(s, t, r, pack_counts(first[code[a:b]]), pack_counts(second[code[a:b]]) if second is not None else b"")
                    for s, t, r, a, b in where]
        return sums, spread

    @staticmethod
    def collect(replies: pd.DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
        """A shard's values in the order of its keys, from its replies of one tag."""
        ordered = replies.sort_values("reducer")
        out = []
        for c in ("first", "second"):
            flat = np.concatenate([np.zeros(0, np.int64), *(unpack_counts(b) for b in ordered[c])])
            if len(flat) not in (0, size):
                raise RuntimeError("replies do not match the keys that were asked for")
            out.append(flat)
        return out[0], out[1]
