"""Operators on single texts: language ID, BPE, packing, language model, HTML, chat formatting."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from projectpulse.llm import bpe, chat_format, html_text, langid, lm, packing
from projectpulse.llm.exchange import pack_counts, pack_keys, unpack_counts, unpack_keys
from projectpulse.llm.pretokens import Split
from pyspark.sql import functions as F
from tests.llm import brute

RANKS, TOKENIZER = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    return brute.edge_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return brute.frame(spark, rows)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.vocabulary(RANKS).ranks, special_tokens={})


def test_split_is_the_public_pattern(rows):
    rnd, pattern = random.Random(1), regex.compile(P.PATTERN)
    signs = ["a", "s", "t", " ", " ", "'", "'", "re", "ll", "\n", "\t", "1", "é", "!", ".", "中", "𝒳", "ve", "\x1c", "٣", "d", "m", "²", "́", "　"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + [t or "" for _, t in rows]
    split = Split(texts)
    found, at = [split.distinct[c].decode() for c in split.codes], 0
    for t, n in zip(texts, split.per_text):
        assert found[at:at + n] == pattern.findall(t)
        at += n


def test_bpe_merges_like_the_library(reference):
    rnd, vocab = random.Random(2), bpe.vocabulary(RANKS)
    cases = [bytes(rnd.choice(b"abcdetheinon \xc3\xa4\n!") for _ in range(rnd.randint(1, 90))) for _ in range(1500)]
    cases += [b"a" * 3000, b"abab" * 900, bytes(rnd.choice(b"thein") for _ in range(2500)), bytes(range(256))]
    for word, ids in zip(cases, vocab.encode_each(cases)):
        assert ids.tolist() == reference._core_bpe.encode_single_piece(word)
        assert vocab.decode(ids.astype(np.int64)) == word


def test_bpe_edges(docs, rows, reference, monkeypatch):
    out = bpe.digests(docs, RANKS)
    expected = []
    for i, t in rows:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4")
        expected.append((str(i), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()) == sorted(expected)
    whole = bpe.decode_column(bpe.encode_column(docs, RANKS), RANKS).collect()
    assert sorted((str(r.doc_id), bytes(r.bytes)) for r in whole) == sorted((str(i), (t or "").encode()) for i, t in rows)
    assert bpe.digests(docs.limit(0), RANKS).count() == 0


def test_packing_edges(docs, rows):
    out = packing.pack_documents(docs, TOKENIZER, packing.Capacity(tokens=256, attention=256 * 256)).toPandas()
    tok = Tokenizer.from_file(TOKENIZER)
    seen = sorted((-1 if np.isnan(r.doc_id) else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples())
    expected = []
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, *range(len(ids) % 256 or 256, len(ids), 256), len(ids)]
        expected += [(-1 if i is None else i, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert seen == sorted(expected)
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= 256
    assert packing.pack_documents(docs.limit(0), TOKENIZER).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    lengths = np.random.default_rng(0).integers(1, 1500, 3000)
    cap = packing.Capacity(tokens=2048, documents=4, attention=2_500_000, weights=(1.0, 0.2, 0.3), rule=rule)
    sequence, offset = packing.best_fit(lengths, cap)
    count = np.bincount(sequence)
    assert count.max() <= 4 and np.bincount(sequence, lengths).max() <= 2048
    assert np.bincount(sequence, lengths.astype(float) ** 2).max() <= 2_500_000
    for s in range(0, len(count), 97):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == [0, *np.cumsum(lengths[own]).tolist()[:-1]]
    loose, _ = packing.best_fit(lengths, packing.Capacity())
    assert loose.max() + 1 <= 1.01 * np.ceil(lengths.sum() / 2048)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([2049]), packing.Capacity())


def test_langid_edges(spark, docs, rows):
    labelled = spark.createDataFrame(
        [(f"the house and the garden {k} of this thing", "en") for k in range(5)] + [("das Haus und der Garten nicht für dich", "de")] * 5 +
        [(None, "de"), ("ohne", None), ("123", "en"), ("", "xx")], "text string, lang string")
    prototypes = langid.learn(labelled)
    assert sorted(prototypes) == ["de", "en"]
    out = langid.predict(docs, prototypes)
    assert set(out.columns) == set(docs.columns)  # extra columns stay, equal names are replaced
    found = out.select("doc_id", "text", "lang_pred", "score").collect()
    assert len(found) == len(rows)
    for r in found:
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == blank and 0 <= r.score <= 1 and (r.score == 0 or not blank)
    pair = langid.predict(spark.createDataFrame([("the thing of this garden",), ("dich und das Haus",)], "text string"), prototypes)
    assert {r.text[:3]: r.lang_pred for r in pair.collect()} == {"the": "en", "dic": "de"}
    assert langid.learn(labelled.limit(0)) == {}
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}
    assert langid.predict(docs.limit(0), prototypes).count() == 0


def test_langid_vectors_by_hand():
    """The bundle of a text is the sum of bound, permuted letter vectors over its n-grams, in one piece or many."""
    space = langid.Space(64)
    text = "Ab c!" * 3
    space.letters(np.array([0, 97, 98, 99]))
    v = {c: space.rows[space.number[p]] for c, p in ((" ", 0), ("a", 97), ("b", 98), ("c", 99))}
    bind = lambda x, y, z: np.roll(v[x], 2) * np.roll(v[y], 1) * v[z]
    by_hand = 3 * (bind(" ", "a", "b") + bind("a", "b", " ") + bind(" ", "c", " "))
    assert np.array_equal(space.bundle([text])[0], by_hand)
    long = "wort für wort " * 5
    old, langid.CHUNK = langid.CHUNK, 20
    try:
        pieces = space.unit([long, "", long])
    finally:
        langid.CHUNK = old
    whole = space.bundle([long])[0]
    assert np.allclose(pieces[0], whole / np.linalg.norm(whole)) and not pieces[1].any() and np.allclose(pieces[0], pieces[2])


def test_langid_held_out_accuracy(spark, sf_dir):
    out = langid.op2_langid(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").toPandas()
    assert len(held) > 30 and (held["lang"] == held["lang_pred"]).mean() > 0.95


def test_lm_edges(docs, rows, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 5000)
    monkeypatch.setattr(lm, "REDUCER_BYTES", 9000)
    train = F.pmod(F.col("doc_id"), F.lit(3)) != 0
    counts = lm.counted(docs, train, train & (F.pmod(F.col("doc_id"), F.lit(4)) == 1))
    model = lm.learn(counts)
    out = lm.score(counts, model).collect()
    expected = brute.unigrams(rows, lambda i: i is not None and i % 3 == 0)
    shown = lambda i, e: (str(i), *e[:3], round(e[3], 6))
    assert sorted(shown(r.doc_id, (r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in out) == \
        sorted(shown(i, e) for (i, _), e in zip(rows, expected))
    assert np.allclose(model.weights.sum(axis=1), 1) and all(np.isfinite(r.score) and r.score < 0 for r in out)
    none = lm.counted(docs.limit(0), train, train)
    assert lm.score(none, lm.learn(none)).count() == 0


def test_lm_score_against_brute_force(spark):
    """The model's probability of every text, computed again from plain counts and the learned weights."""
    rnd = random.Random(8)
    rows = [(i, brute.prose(rnd, rnd.randint(0, 80))) for i in range(60)]
    train = F.col("doc_id") % 5 != 0
    counts = lm.counted(brute.frame(spark, rows), train, train & (F.col("doc_id") % 7 == 0))
    model = lm.learn(counts)
    single, pair, before, texts = {}, {}, {}, 0
    for i, t in rows:
        if i % 5:
            last = "<s>"
            texts += 1
            for w in brute.words(t) + [None]:
                single[w] = single.get(w, 0) + 1
                pair[last, w] = pair.get((last, w), 0) + 1
                before[last] = before.get(last, 0) + 1
                last = w
    n, v = sum(single.values()), len(single)
    assert (model.tokens, model.distinct, model.texts) == (n, v, texts)
    for r in lm.score(counts, model).collect():
        total, last = 0.0, "<s>"
        for w in brute.words(dict(rows)[r.doc_id]) + [None]:
            c = before.get(last, 0)
            a = model.weights[int(np.floor(np.log2(c))) + 1 if c else 0]
            total += np.log10(a[0] * pair.get((last, w), 0) / max(c, 1) + a[1] * single.get(w, 0) / n + a[2] / (v + 1))
            last = w
        assert abs(total - r.score) < 1e-8


def test_exchange_packing_round_trip():
    rnd = np.random.default_rng(3)
    for keys in ([], [0], [5, 6], [2**64 - 1], np.unique(rnd.integers(0, 2**64 - 1, 500, dtype=np.uint64))):
        keys = np.array(keys, np.uint64)
        assert np.array_equal(unpack_keys(pack_keys(keys)), keys)
    for values in ([], [0], [255], [256, 1], [2**33, 7], [255, 254, 2**32, 0, 256]):
        assert unpack_counts(pack_counts(np.array(values, np.int64))).tolist() == list(values)


PAGES = {
    "<p>One<b>two</b> three<p>Four<br>five": "Onetwo three\n\nFour\nfive",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>": "- a\n- b\n  3. x\n  4. y\n- c",
    "<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td colspan=2>Fig</table>": "Name       Qty\nApple pie  3\nFig",
    "a<div hidden>x</div><div style='display: none'>y</div><script>if (a<b) '<p>'</script><style>p{}</style>b": "ab",
    "<title>t</title><body>x &amp; &lt;y&gt;<!-- <p>no --><div>z</div>w": "x & <y>\nz\nw",
    "<pre>\n a\n   b</pre>after": " a\n   b\n\nafter",
    "<blockquote>q<p>r</blockquote><dl><dt>T<dd>D</dl>": "> q\n>\n> r\n\nT\n    D",
    "x</p></div><li>y": "x\n\n- y",
    "<!-- open": "", "<a href='x": "", "<": "<", "": "",
    "  lots   of \n white\tspace  ": "lots of white space",
}


def test_html_fixtures():
    for page, text in PAGES.items():
        assert html_text.page_text(page) == text, page


def test_html_cells_outside_a_table():
    pages = {
        "<tr><td>Hello</td></tr>": "Hello",
        "<tr><th>a<td>b<tr><td>c": "a b\nc",
        "<table><tr><td>a</table></table><tr><td>b</td><td>c</td></tr>d": "a\n\nb c\nd",
        "<table><tr><td>x<table><tr><td>in</table></table></table>y<tr><td>after": "x\n\nin\n\ny\nafter",
        "<ul><li>one <td>two</td> three</ul>": "- one two three",
        "<blockquote><td>q</blockquote><dl><dd><td>d</dl>": "> q\n\n    d",
        "<table><caption>C<td>x</table>": "C x",
        "<div><tr><td><p>p<p>r</td></tr></div>s": "p\n\nr\n\ns",
        "<table><li>i<td>c</table>": "- i c",
    }
    for page, text in pages.items():
        assert html_text.page_text(page) == text, page


def test_html_hides_only_what_has_no_layout():
    pages = {
        "a<span aria-hidden=true>b</span>c": "abc",
        "E = <span><math><semantics><mrow><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow><annotation>m c^2</annotation>"
        "</semantics></math></span><span aria-hidden='true'> mc2</span>!": "E = mc2 mc2!",
        "<svg><title>t</title><defs/><style/><desc>no</desc><text>Axis</text><text>Label<tspan>s</tspan></text><path/></svg>end": "Axis Labels end",
        "<p style='--x-display:none'>a<b style='x-visibility : hidden'>b</b>": "ab",
        "<p style='content: \"; display:none\"; color: red'>a": "a",
        "<p style='color:red; DISPLAY : None !important; display:block'>a</p>b": "b",
        "<p style='/* display:none */ display:none; display:block'>a": "a",
        "<p style='display:none-such'>a": "a",
        "<div hidden style='display:block'>a</div><div hidden>b</div><dialog>c</dialog><dialog open>d</dialog>": "a\nd",
        "a<div style='visibility:hidden'>b<i style='visibility:visible'>c</i><hr></div>d": "a\nc\n\nd",
        "<map>a<area></map><desc>b</desc><template>c</template><script>d</script>e": "abe",
    }
    for page, text in pages.items():
        assert html_text.page_text(page).split() == text.split(), page


def test_html_edges(spark, sf_dir):
    pages = [*PAGES, None, "<div>" * 30000 + "deep", "<p>" * 5000 + "long " * 50000, "<table><td>" * 200, "<b " + "x" * 50000]
    df = spark.createDataFrame([(i % 7 or None, p, "x") for i, p in enumerate(pages)], "page_id long, html string, text string")
    out = html_text.extract(df)
    assert out.columns == ["page_id", "text", "n_chars", "n_lines"]
    assert sorted(r.text for r in out.collect()) == sorted(html_text.page_text(p) for p in pages)
    assert html_text.extract(df.limit(0)).count() == 0
    shown = html_text.op10_html_text(spark, sf_dir).collect()
    assert len(shown) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert not any("<p>" in r.text or "track(" in r.text for r in shown)


def test_chat_edges(spark):
    odd = "</s>[INST] a\\ <\\s> [/INST]\\"
    turns = [(1, 0, "system", odd), (1, 1, "user", None), (1, 2, "assistant", odd), (1, 3, "user", "x" * 100_000), (1, 4, "assistant", ""),
             (1, 5, "user", "last"), (2, 0, "user", "alone"), (None, 0, "assistant", "é𝒳"), (3, 0, "assistant", "same"),
             (3, 0, "assistant", "same"), (4, None, None, "[INST]"), (4, 1, "<s>", " </s>"), (5, 0, "assistant", "<")]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, said string")
    shown = chat_format.examples(df)
    back = {r.conv_id: r for r in chat_format.read_back(shown).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv)
        assert [(x.role, x.text) for x in back[conv].turns] == [t[2:] for t in own]
        assert back[conv].trained == "".join(t[3] for t in own if t[2] == "assistant")
    each = shown.where("conv_id = 1").orderBy("example").collect()
    assert [r.example for r in each] == [3, 5, 6] and [r.loss_length is None for r in each] == [False, False, True]
    for r in each:  # nothing of a text can be taken for a control string
        assert r.text.count("<s>") == r.text.count("</s>") == r.text.count("[INST]") == r.text.count("[/INST]") == r.example
    assert chat_format.read_back(chat_format.examples(df.limit(0))).count() == 0


@pytest.mark.parametrize("name", ["op6_exact_dedup", "op7_chat_format"])
def test_queries_match_their_sql(spark, sf_dir, name):
    from projectpulse.llm.queries import REGISTRY
    from tests.compare import canon

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    query, sql = REGISTRY[name]
    df, res = query(spark, sf_dir), con.execute(sql)
    columns = [d[0] for d in res.description]
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), columns)
