"""Plain single-process versions of the operators, and the fixtures they are compared on."""

import collections
import hashlib
import math
import random
import re
import zlib

LOWER = {i: i + 32 for i in range(65, 91)}
SPACE = re.compile(r"[\x20\x09-\x0D]+")
#: Names that the operators use inside; as extra columns they must not disturb them.
EXTRA = ("shard bucket guard next_text name sig print start bytes spans digest file row norm first n score lang_pred train tune "
         "c1 component piece length held_out value dim said at").split()


def prose(rnd, n, alphabet="abcdefgh"):
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 6))) for _ in range(60)] + ["the", "of", "und", "la"] * 6
    return " ".join(rnd.choice(words) for _ in range(n))


def edge_docs():
    """Texts with nulls, empty and very long ones, ties, repeated rows, near copies and shared passages."""
    rnd = random.Random(7)
    base, passage = prose(rnd, 300), prose(rnd, 120)
    texts = [
        None, "", " \t\n", "x", "Two words", "three short words", "...", "12 34 !!", "ß é 中文 𝒳 ́", "\x00\x1c nul",
        base, base, base.replace(" ", "\n", 3), base + " tail", base[:-40] + " other end of it", "start " + base,
        prose(rnd, 90) + " " + passage + " " + prose(rnd, 50), prose(rnd, 40) + " " + passage, passage, passage[:420],
        "a" * 3000, "ab" * 1500, "the " * 700, prose(rnd, 9000), "q" * 30000 + " end", base.upper(),
        "<|endoftext|> in a text", "it's we'll 's 'tis  don't", "Lorem ipsum " * 100,
    ]
    rows = list(enumerate(texts))
    rows += [(5, texts[5]), (10, base), (None, "no id " + passage), (None, None)]
    return rows


def frame(spark, rows, extra=EXTRA):
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in extra)
    data = [(i, t, "en" if t and i is not None and i % 2 else None, "s", len(t) if t else 0, *("x" for _ in extra)) for i, t in rows]
    return spark.createDataFrame(data, schema)


def words(text):
    return [w.translate(LOWER) for w in SPACE.split(text or "") if w]


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def components(texts):
    """For a list of texts: the number of the first text that each one reaches by links."""
    sets = [shingles(t) for t in texts]
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 90 * (len(a) + len(sets[j]) - both):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(sets))]


def repeated(texts, length=400):
    """(bytes, removed, spans, SHA-256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[p:p + length] for t in raw for p in range(len(t) - length + 1))
    out = []
    for t in raw:
        keep = [True] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                keep[p:p + length] = [False] * length
        rest = bytes(b for b, k in zip(t, keep) if k)
        spans = sum(not k and (i == 0 or keep[i - 1]) for i, k in enumerate(keep))
        out.append((len(t), len(t) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


def unigrams(rows, held_out):
    """n_tokens, n_known, N and base score of each (id, text)."""
    toks = [words(t) + [None] for _, t in rows]
    count = collections.Counter()
    for (i, _), t in zip(rows, toks):
        if not held_out(i):
            count.update(t)
    n, v = sum(count.values()), len(count)
    return [(len(t), sum(count[w] > 0 for w in t), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t)) for t in toks]


def crc(i):
    return zlib.crc32(str(i).encode())
