"""Spelling variants against a plain version that tries every edit."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

from projectpulse.llm import spelling as P
from tests.llm.brute import edge_docs, frame

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(rows, typo=199, least_length=6, least_count=5):
    count = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % typo == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= least_length and n >= least_count}


def plain_variants(words, factor=5):
    holes = defaultdict(set)  # a word with one place cut out
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:], i].add(w)
    shorter = defaultdict(set)
    for (cut, _), ws in holes.items():
        shorter[cut] |= ws
    near = defaultdict(set)
    for ws in holes.values():
        for a, b in combinations(ws, 2):
            near[a].add(b)
            near[b].add(a)
    for w in words:
        near[w] |= shorter[w]
        for longer in shorter[w]:
            near[longer].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= factor * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def documents(seed, n):
    rnd = random.Random(seed)
    roots = ["".join(rnd.choice("abcdéÿ") for _ in range(rnd.randint(5, 9))) for _ in range(40)]
    words = []
    for r in roots:
        words += [r] * 40
        for _ in range(12):
            i, w = rnd.randrange(len(r)), r
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abcdÉ") + w[i:], w[:i] + rnd.choice("abcd") + w[i + 1:]])
            words += [w] * rnd.choice([1, 2, 8])
            words += [w[:-1] + "ab"] * 1
    texts = [" ".join(rnd.choice(words).title() if rnd.random() < .1 else rnd.choice(words) for _ in range(rnd.randint(0, 80))) for _ in range(n)]
    chain = " ".join(["aaaaaaaa"] * 3125 + ["aaaaaaab"] * 625 + ["aaaaaabb"] * 125 + ["aaaaabbb"] * 25 + ["aaaabbbb"] * 5)
    return list(enumerate(texts)) + [(None, chain), (None, chain), (7, texts[7])]


def test_vocabulary(spark):
    rows = edge_docs() + documents(2, 300)
    for typo in (199, 7):
        got = {r.word: r.n for r in P.vocabulary(frame(spark, rows).repartition(4), typo=typo).collect()}
        assert got == plain_words(rows, typo)


def test_variants(spark):
    words = plain_words(documents(3, 900), typo=9)
    want = plain_variants(words)
    assert len(words) > 300 and sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] and r[1] for r in want)
    rows = P.written(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3), "words")
    assert sorted((tuple(r) for r in P.variants(rows).collect()), key=lambda r: r[0]) == want


def test_empty(spark):
    words = P.written(P.vocabulary(frame(spark, [(1, None), (2, "short words only")])), "words")
    assert P.variants(words).collect() == []


def test_pivots_are_the_rarest_pair():
    rnd = random.Random(1)
    for _ in range(500):
        ranks = [rnd.randrange(8) for _ in range(rnd.randint(5, 12))]
        places = P.prefix(ranks)
        order = sorted(ranks)
        assert places == [i for i, r in enumerate(ranks) if r <= order[2]]
        options = [(ranks[a] + ranks[b], (a, b)) for a, b in combinations(places, 2) if b - a >= 2]
        assert tuple(P.pivots(ranks, places)) == min(options)[1]
