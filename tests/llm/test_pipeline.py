"""The pipeline's stages against plain versions of them."""

import collections
import random

import corpus_pipeline
import numpy as np
import public_tokenizers as P
from projectpulse.llm import langid
from projectpulse.llm.common import written
from tests.llm import brute
from tokenizers import Tokenizer


def fixture_docs(spark):
    rnd = random.Random(11)
    rows = brute.edge_docs() + [(100 + k, brute.prose(rnd, rnd.randint(5, 120))) for k in range(30)]
    rows = [(i, t) for i, t in rows if i is not None]
    return brute.frame(spark, rows, ()), rows


def test_stages_against_brute_force(spark):
    docs, _ = fixture_docs(spark)
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    take = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    key = lambda r: (r[0], r[1] is not None, r[1] or "")

    docs = written(docs, "t0")
    one = written(stage["language_id"](spark, docs, ""), "t1")
    assert one.columns == columns
    space = langid.Space()
    labelled = [(r.lang, r.text) for r in docs.collect() if r.lang and r.text]
    vectors, prototypes = space.unit([t for _, t in labelled]), {}
    for (lang, _), v in zip(labelled, vectors):
        prototypes[lang] = prototypes.get(lang, 0) + v
    best = np.max([space.unit([r.text or "" for r in docs.collect()]) @ (v / np.linalg.norm(v)) for v in prototypes.values()], axis=0)
    expected = sorted(((r.doc_id, r.text) for r, s in zip(docs.collect(), best) if s >= corpus_pipeline.MIN_SCORE), key=key)
    assert sorted(((r.doc_id, r.text) for r in one.collect()), key=key) == expected
    assert all(r.lang for r in one.collect())

    two = written(stage["exact_dedup"](spark, one, ""), "t2")
    groups = collections.defaultdict(list)
    for i, t in take(one):
        groups[brute.SPACE.sub(" ", t)].append((i, t))
    assert [i for i, _ in take(two)] == sorted(min(g)[0] for g in groups.values()) and two.columns == columns

    three = written(stage["jaccard_join"](spark, two, ""), "t3")
    before = take(two)
    top = brute.components([t for _, t in before])
    assert [i for i, _ in take(three)] == [before[k][0] for k in sorted(set(top))] and three.columns == columns

    four = written(stage["suffix_dedup"](spark, three, ""), "t4")
    before = take(three)
    lost = {i: e for (i, _), e in zip(before, brute.repeated([t for _, t in before]))}
    left = dict(take(four))
    assert four.columns == columns and all(r.n_chars == len(r.text) for r in four.collect())
    for i, t in before:
        n, removed, _, _ = lost[i]
        if removed == 0:
            assert left[i] == t
        elif i in left:
            assert len(left[i].encode()) <= n - removed and left[i].strip()

    packed = stage["packing"](spark, four, "").toPandas()
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lengths = packed.groupby("doc_id")["length"].sum().to_dict()
    assert lengths == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in take(four)}


def test_run_and_empty_table(spark, sf_dir, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "suffix_dedup", "packing"]
    docs, _ = fixture_docs(spark)
    docs.write.parquet(f"{tmp_path}/full/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/full").count() > 20
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_near_copies_by_five_words_and_80_percent(spark):
    """Two texts with a 5-word likeness of 0.83, which three words and 0.9 do not link."""
    words = [f"w{k}" for k in range(114)]
    docs = brute.frame(spark, [(1, " ".join(words)), (2, " ".join(words[:50] + ["x"] + words[51:90] + ["y"] + words[91:]))], ())
    stage = dict(corpus_pipeline.STAGES)["jaccard_join"]
    assert [r.doc_id for r in stage(spark, written(docs, "n0"), "").collect()] == [1]


def test_language_stage_rejects_unseen_scripts_and_gibberish(spark):
    rnd = random.Random(23)
    vocabulary = {
        "en": "the of and house water river with people were under long winter story children walked over green hills".split(),
        "de": "der die und das haus wasser fluss mit leuten waren unter langer winter geschichte kinder gingen berge".split(),
        "fr": "le la et maison eau fleuve avec gens sous longue hiver histoire enfants marchaient collines vertes".split(),
    }
    clean = [(lang, " ".join(rnd.choice(w) for _ in range(rnd.randint(12, 400)))) for lang, w in vocabulary.items() for _ in range(60)]
    clean += [(None, " ".join(rnd.choice(w) for _ in range(60))) for w in vocabulary.values() for _ in range(5)]
    made = lambda letters, n: " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))) for _ in range(n))
    other = [made([chr(c) for c in range(a, b)], rnd.randint(12, 400))
             for a, b in ((0x5D0, 0x5EB), (0x430, 0x450), (0x4E00, 0x9FA0)) for _ in range(30)]
    other += [made("abcdefghijklmnopqrstuvwxyz", n) for n in (20, 60, 300, 3000, 40000) for _ in range(6)]
    rows = [(i, t, lang, "s", len(t)) for i, (lang, t) in enumerate(clean + [(None, t) for t in other])]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "g0")
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(len(clean)))
    assert corpus_pipeline.min_score(1) < corpus_pipeline.min_score(4) < corpus_pipeline.min_score(20)


def test_python_runs_once_in_a_task(spark):
    """A filter on what a Python function returns must not run the function again, in a second worker beside the first."""
    docs = written(fixture_docs(spark)[0], "p0")
    for name in ("language_id", "suffix_dedup"):
        plan = dict(corpus_pipeline.STAGES)[name](spark, docs, "")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, (name, plan)
    labelled = docs.where("lang is not null")
    prototypes = corpus_pipeline.langid.learn(labelled)
    plan = corpus_pipeline.langid.predict(labelled, prototypes).where("lang = lang_pred")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan


def test_forgotten_tokenizers_give_the_same_pieces(spark):
    import public_tokenizers

    docs = written(fixture_docs(spark)[0], "p1")
    path = public_tokenizers.path("byte_bpe_50k.json")
    kept, forgot = (sorted(map(tuple, corpus_pipeline.packing.cut(docs, path, 2048, forget=f).collect()), key=str) for f in (False, True))
    assert kept == forgot and len(kept) >= docs.count()


def test_passages_of_over_fifty_short_words_go(spark):
    """Passages of 51 words need not have the 400 bytes of op5; those of 400 bytes go as before."""
    rnd = random.Random(31)
    words = lambda n, size=3: " ".join("".join(rnd.choice("abcdefgh") for _ in range(size)) for _ in range(n))
    short, few, bytes_, script = words(51), words(40), words(40, 12), words(1, 450)
    assert len(short) < 400 < len(bytes_)
    own = [words(30) for _ in range(10)]
    texts = [f"{own[0]} {short} {own[1]}", f"{own[2]}\n{short}\n{own[3]}", f"{own[4]} {few} {own[5]}", f"{own[6]} {few} {own[7]}",
             f"{own[8]} {bytes_}", f"{bytes_} {own[9]}", f"x {script}", f"y {script}", words(200), None]
    docs = written(brute.frame(spark, list(enumerate(texts)), ()), "q0")
    left = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["suffix_dedup"](spark, docs, "").collect()}
    assert left.keys() == set(range(len(texts)))
    for k in (0, 1):
        assert left[k].split() == own[2 * k].split() + own[2 * k + 1].split()
    assert all(left[k] == texts[k] for k in (2, 3, 8, 9))
    assert left[4].strip() == own[8] and left[5].strip() == own[9] and left[6].strip() == "x" and left[7].strip() == "y"


def test_widened_texts():
    rnd = random.Random(3)
    for text in ["", " ", "a", "  a bb\n\nccc ", "éé " * 5, "x" * 30] + ["".join(rnd.choice("ab \né") for _ in range(rnd.randint(1, 300))) for _ in range(50)]:
        raw = text.encode()
        parts = list(corpus_pipeline.suffix_dedup.widened(raw, 8))
        out = b"".join(o.tobytes() for o, _ in parts)
        assert out.replace(b"\xff", b"") == raw and len(out) >= 8 * len(raw.split())
        assert corpus_pipeline.suffix_dedup.kept(raw, [], 8).all() and not corpus_pipeline.suffix_dedup.kept(raw, [{"start": 0, "end": len(out)}], 8).any()
