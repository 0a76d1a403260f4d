"""Operators that look for copies: exact dedup, Jaccard join, suffix dedup, SpotSigs."""

import hashlib
import random

import numpy as np
import pytest

from projectpulse.llm import exact_dedup, jaccard_join, spotsigs, suffix_dedup
from projectpulse.llm.common import written
from projectpulse.session import scratch_path
from pyspark.sql import functions as F
from tests.llm import brute


@pytest.fixture(scope="module")
def rows():
    return brute.edge_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return brute.frame(spark, rows)


def test_exact_dedup_edges(spark, docs, rows):
    out = exact_dedup.dedup(spark, docs).collect()
    norm = [brute.SPACE.sub(" ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    least = {t: min((i for i in g if i is not None), default=None) for t, g in groups.items()}
    expected = sorted((str(i), str(least[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm))
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.digest.hex()) for r in out) == expected
    assert sum(r.kept for r in out) == len(groups)  # one row of each group, also where ids repeat
    assert exact_dedup.keep_first(spark, docs).count() == len(groups)
    assert exact_dedup.dedup(spark, docs.limit(0)).count() == 0


def test_exact_dedup_checks_full_bytes(spark, docs, rows):
    """With a digest of one byte nearly every hit is a collision; the bytes decide."""
    weak = exact_dedup.dedup(spark, docs, digest=lambda c: F.substring(exact_dedup.sha256(c), 1, 1))
    norm = {brute.SPACE.sub(" ", t or "") for _, t in rows}
    assert sum(r.kept for r in weak.collect()) == len(norm)


def test_exact_dedup_state_goes_on(spark):
    folder, state = scratch_path(spark, "landed"), scratch_path(spark, "state")
    for part in ([(7, "a  b"), (8, "c")], [(3, "a b"), (9, "a\tb")]):
        exact_dedup.land(exact_dedup.located(brute.frame(spark, part, ())), folder)
        found = exact_dedup.update_state(spark, folder, state).select("first.doc_id", "n").collect()
    assert sorted(map(tuple, found)) == [(3, 3), (8, 1)]


def test_jaccard_join_edges(spark, docs, rows):
    out = jaccard_join.join(spark, docs).collect()
    ids, texts = [i for i, _ in rows], [t for _, t in rows]
    top = brute.components(texts)
    least = {}
    for i, k in zip(ids, top):
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    expected = sorted((str(i), len(brute.shingles(t)), str(least[k] if brute.shingles(t) else i)) for i, t, k in zip(ids, texts, top))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == expected
    assert jaccard_join.join(spark, docs.limit(0)).count() == 0


def test_jaccard_join_chains(spark, monkeypatch):
    """Chains and stars of near copies: components that only pairs apart from the leaders hold together."""
    monkeypatch.setattr(jaccard_join, "GROUP", 4)
    monkeypatch.setattr(jaccard_join, "CHUNK", 5)
    rnd = random.Random(3)
    texts = []
    for _ in range(4):
        words = brute.prose(rnd, 200).split()
        for k in range(14):  # each differs from the one before it by one word, from the first by up to 14
            words[13 * k] = f"w{rnd.randint(0, 99999)}"
            texts.append(" ".join(words))
    for _ in range(3):
        base = brute.prose(rnd, rnd.randint(3, 60)).split()
        for _ in range(8):
            copy = list(base)
            copy[rnd.randrange(len(copy))] = f"z{rnd.randint(0, 9)}"
            texts.append(" ".join(copy))
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = [(i, texts[k]) for i, k in enumerate(order)]
    out = {r.doc_id: r.component_id for r in jaccard_join.join(spark, brute.frame(spark, rows)).collect()}
    assert [out[i] for i, _ in rows] == brute.components([t for _, t in rows])


def test_signatures_meet_for_all_linked_sets():
    """Any two sets at the threshold share a signature, for all sizes."""
    rnd = np.random.default_rng(5)
    classes = jaccard_join.Classes()
    for n in [*range(1, 60), 101, 377, 1200]:
        pool = rnd.integers(0, 2**63, 2 * n + 2, dtype=np.uint64)
        a = np.unique(pool[:n])
        for lost in range(n):
            for added in range(n - lost + 2):
                if not jaccard_join.linked(n - lost, n, n - lost + added):
                    break
                b = np.unique(np.concatenate([a[lost:], pool[n:n + added]]))
                assert np.intersect1d(jaccard_join.signatures(a, classes), jaccard_join.signatures(b, classes)).size, (n, lost, added)
            else:
                continue
            if lost and added == 0:
                break


def plain_components(texts, n, threshold):
    """As brute.components, for any shingle length and threshold."""
    sets = []
    for t in texts:
        w = brute.words(t)
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    top = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= threshold * (len(a) + len(sets[j]) - both):
                x, y = top[i], top[j]
                top = [min(x, y) if k in (x, y) else k for k in top]
    return top


def test_jaccard_join_other_shingles_and_threshold(spark):
    """Five words and 80 percent: chains of single changed words, and pairs between 80 and 90 percent."""
    rnd = random.Random(17)
    texts = [t for _, t in brute.edge_docs()[:-2]]
    for size in (4, 5, 9, 30, 60, 150, 400):
        for _ in range(6):
            base = [f"{rnd.choice('abcdefgh')}{rnd.randint(0, 400)}" for _ in range(size)]
            texts.append(" ".join(base))
            for lost in (size // 100 + 1, size // 50 + 1, size // 40 + 1):
                copy = list(base)
                for at in rnd.sample(range(size), lost):
                    copy[at] = f"z{rnd.randint(0, 999)}"
                texts.append(" ".join(copy))
            texts.append(" ".join(base[:size - size // 8]))
    rows = list(enumerate(texts))
    found = {r.doc_id: r.component_id for r in jaccard_join.join(spark, brute.frame(spark, rows, ()), n=5, threshold=80).collect()}
    expected = plain_components(texts, 5, 80)
    assert [found[i] for i, t in rows if brute.words(t)] == [expected[i] for i, t in rows if brute.words(t)]
    assert expected != plain_components(texts, 3, 90)


@pytest.mark.parametrize("threshold", [80, 85, 90])
def test_linked_sets_share_the_signatures_they_need(threshold):
    rnd = np.random.default_rng(6)
    classes = jaccard_join.Classes(threshold)
    for n in [*range(1, 40), 77, 150, 401]:
        for lost in range(n):
            for added in {0, 1, lost, n // 5}:
                if not jaccard_join.linked(n - lost, n, n - lost + added, threshold):
                    continue
                pool = rnd.integers(0, 2**63, n + added, dtype=np.uint64)
                (a, x), (b, y) = (jaccard_join.signatures_needed(np.unique(s), classes) for s in (pool[:n], pool[lost:]))
                assert np.intersect1d(a, b).size >= max(x, y, 1), (n, lost, added)


def test_suffix_dedup_edges(spark, docs, rows):
    out = suffix_dedup.digests(docs)
    expected = brute.repeated([t for _, t in rows])
    assert sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect() if r.doc_id is not None) == \
        sorted((False, i, *e) for (i, _), e in zip(rows, expected) if i is not None)
    assert out.count() == len(rows)
    assert suffix_dedup.digests(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_at_the_ends_of_repeats(spark, monkeypatch, seed):
    """Passages of about 400 bytes, at every place, cut, joined and periodic; over many shards and segments."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 40_000)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 3_000)
    rnd = random.Random(seed)
    passages = [brute.prose(rnd, 200, "abé") for _ in range(6)] + ["xyz" * 300, "-" * 700]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            p = rnd.choice(passages)
            a = rnd.randrange(0, 250)
            parts += [brute.prose(rnd, rnd.randint(0, 60)), p[a:a + rnd.choice([380, 398, 399, 400, 401, 420, 600])]]
        texts.append("".join(parts))
    texts += [texts[0] + "!", "," + texts[1], texts[2]]
    rows = list(enumerate(texts))
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(brute.frame(spark, rows)).collect()}
    assert [out[i] for i, _ in rows] == brute.repeated(texts)


def test_suffix_dedup_text_keeps_whole_characters(spark):
    rnd = random.Random(4)
    passage = brute.prose(rnd, 150, "éü𝒳")
    rows = [(1, "ä" + passage + " eins"), (2, "ö" + passage + " zwei"), (3, None), (4, "allein")]
    out = {r.doc_id: r.text for r in suffix_dedup.cleaned(brute.frame(spark, rows)).collect()}
    assert out[3] is None and out[4] == "allein"
    assert out[1].endswith("eins") and out[2].endswith("zwei") and len(out[1]) < 12


def test_spotsigs_edges(spark, docs, rows):
    out = spotsigs.compare_edits(spotsigs.with_next(docs, bucket_rows=7)).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    spotter = spotsigs.Spotter()
    expected = []
    for (i, t), (_, f) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        edited = t[:len(t) - k] + f[:k]
        a, b, c = (set(spotter.signatures([x])[0].tolist()) for x in (t, edited, f))
        expected.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(),
                         round(len(a & b) / len(a | b), 9), round(len(a & c) / len(a | c), 9)))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in out) == sorted(expected)
    by_text = {}
    for r, t in ((r, t) for r in out for i, t in rows if i == r.doc_id and i is not None):
        assert by_text.setdefault(t or "", r.fingerprint) == r.fingerprint
    assert all(r.fingerprint and r.edited_fingerprint for r in out)
    empty = docs.limit(0)
    assert spotsigs.compare_edits(spotsigs.with_next(empty)).count() == 0


def test_spotsigs_pairs(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(0, 60, 3):
        t = brute.prose(rnd, rnd.randint(20, 300))
        rows += [(i, t), (i + 1, t + " the end " + brute.prose(rnd, 3)), (i + 2, t if i % 2 else brute.prose(rnd, 50))]
    members, pairs = spotsigs.similar_pairs(brute.frame(spark, rows, ()))
    cls = {r.doc_id: r.class_id for r in members.collect()}
    spotter = spotsigs.Spotter()
    sigs = {i: spotter.signatures([t])[0] for i, t in rows}
    reps = sorted(set(cls.values()))
    assert all(np.array_equal(sigs[i], sigs[c]) for i, c in cls.items())
    expected = {(a, b) for a in reps for b in reps if a < b and spotsigs.jaccard(sigs[a], sigs[b]) >= 0.8}
    assert expected and {(r.left_id, r.right_id) for r in pairs.collect()} == expected


def test_locators_survive_a_written_table(spark, docs):
    table = written(docs, "test-docs")
    assert exact_dedup.dedup(spark, table).select("file", "row").distinct().count() == table.count()


def test_a_common_passage_connects_no_clusters(spark):
    """Pairs of near copies around one long common passage: signatures of the passage lie in all, those of a pair are enough."""
    rnd = random.Random(17)
    words = lambda n: [f"w{rnd.randrange(10**9)}" for _ in range(n)]
    common, rows = words(180), []
    for k in range(40):
        own = words(150)
        rows += [(2 * k, " ".join(common + own)), (2 * k + 1, " ".join(common + own[:-4] + words(4)))]
    docs = brute.frame(spark, rows, ())
    shared = written(jaccard_join.shared_signatures(docs.select("doc_id", "text"), 5, 80), "c0")
    names = shared.groupBy("name").agg(F.min("first").alias("root"))
    clusters = jaccard_join.clusters_of(shared, written(names, "c1")).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in clusters) == [2] * 40
    found = jaccard_join.join(spark, docs, n=5, threshold=80).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i // 2 * 2 for i, _ in rows}
