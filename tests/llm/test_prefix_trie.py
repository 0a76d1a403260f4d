"""Prefix tries against a plain version that makes every prefix a key of a dictionary."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from projectpulse.llm import prefix_trie as P

NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def told(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), told(role, text), len(NOT_SPACE.findall(text))))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + said[h:]
    return out


def plain_nodes(seqs):
    members, words = defaultdict(list), {(): 0}
    for c, said in seqs.items():
        for d in range(len(said) + 1):
            key = tuple(t for t, _ in said[:d])
            members[key].append(c)
            if d:
                words[key] = said[d - 1][1]
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in kids[key]) or 1
        saved[key] = sum(saved[k] for k in kids[key]) + (len(members[key]) - 1) * words[key]
    out = []
    for key, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(key))
        out.append((min(m), len(key), min(members[key[:-1]]) if key else None, len(m), len(kids[key]), leaves[key], saved[key],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n):
    rnd = random.Random(seed)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a b c", "hi", None, "", "x  y\n", "é ü"]))
            for c in rnd.sample(range(400), n) for t in range(rnd.randint(1, 6))]
    rows += [(c, t, "user", "the same all over") for c in range(1000, 1080) for t in range(4)]  # one hot conversation
    rows += [(500, None, "user", "null turn"), (500, 1, "user", "tie b"), (500, 1, "user", "tie a"), (500, 1, "user", "tie a"), (None, 1, "user", "no id"),
             (501, 3, None, None), (2**40 + 7, 0, "user", "far"), (600, 0, "user", "long " * 3000)] + [(700, t, "user", f"turn {t}") for t in range(300)]
    return rows


def frame(spark, rows):
    extra = "path block n least node_key depth boundary family head h".split()
    schema = "conv_id long, turn long, role string, text string" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], schema)


@pytest.mark.parametrize("shard_turns, block_bits", [(100_000, 14), (40, 3)])
def test_equals_plain_version(spark, monkeypatch, shard_turns, block_bits):
    monkeypatch.setattr(P, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(P, "BLOCK_BITS", block_bits)
    rows = conversations(4, 150)
    want = plain_rebuilt(rows)
    seqs = P.rebuilt(frame(spark, rows).repartition(5))
    got = {r.conv_id: (bytes(r.path).hex(), r.words) for r in seqs.collect()}
    assert got == {c: ("".join(t for t, _ in v), [w for _, w in v]) for c, v in want.items()}
    assert sorted((tuple(r) for r in P.prefix_nodes(seqs).collect()), key=repr) == plain_nodes(want)


def test_plain_sequences(spark):
    rows = conversations(9, 30)
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), told(role or "", text or "")))
    got = {r.conv_id: bytes(r.path).hex() for r in P.sequences(frame(spark, rows)).collect()}
    assert got == {c: "".join(t for _, t in sorted(v)) for c, v in own.items()}


def test_turnless_and_empty(spark):
    # 9 takes nothing from the absent conversation 0 and has fewer turns than it would drop.
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(short, 0, "user", "gone")]
    none = hashlib.sha256(str(short).encode()).hexdigest()
    assert [tuple(r) for r in P.prefix_nodes(P.rebuilt(frame(spark, rows))).collect()] == [(short, 0, None, 1, 0, 1, 0, none)]
    assert P.prefix_nodes(P.rebuilt(frame(spark, []))).collect() == []


def test_medians_cover_all_once():
    assert sorted(P.medians(37)) == list(range(37)) and next(P.medians(37)) == 18
