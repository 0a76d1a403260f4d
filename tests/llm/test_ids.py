"""Ids above 2**53 beside null ids come out as they went in."""

import pytest

from projectpulse.llm import bpe, html_text, jaccard_join, lm, packing, secret_scan, spotsigs, suffix_dedup
from pyspark.sql import functions as F

IDS = [2**62 + 1, 2**62 + 3, None, 2**62 + 5, -(2**62) - 7, None]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"word{k} the of und token=abcdefg{k} " * 30 + str(k)) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows + [(IDS[0], rows[0][1])], "doc_id long, text string").coalesce(1)


def _ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=str)


def _tokens(name):
    import public_tokenizers
    return public_tokenizers.path(name)


CASES = {
    "op1": lambda spark, d: packing.pack_documents(d, _tokens("byte_bpe_50k.json")),
    "op3": lambda spark, d: bpe.digests(d, _tokens("byte_bpe_50k.tiktoken")),
    "op3 encode": lambda spark, d: bpe.decode_column(bpe.encode_column(d, _tokens("byte_bpe_50k.tiktoken")), _tokens("byte_bpe_50k.tiktoken")),
    "op4": lambda spark, d: spotsigs.compare_edits(spotsigs.with_next(d, bucket_rows=2)),
    "op4 prints": lambda spark, d: spotsigs.fingerprints(d),
    "op5": lambda spark, d: suffix_dedup.digests(d),
    "op8": lambda spark, d: jaccard_join.join(spark, d),
    "op9": lambda spark, d: (lambda c: lm.score(c, lm.learn(c)))(lm.counted(d, F.lit(True), F.lit(False))),
    "op11": lambda spark, d: secret_scan.scan(d),
}


@pytest.mark.parametrize("name", CASES)
def test_large_ids_beside_null(spark, docs, name):
    assert _ids(CASES[name](spark, docs)) == sorted([*IDS, IDS[0]], key=str)


def test_large_page_ids_beside_null(spark, docs):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("<p>"), "text").alias("html"))
    assert _ids(html_text.extract(pages), "page_id") == sorted([*IDS, IDS[0]], key=str)


def test_links_between_neighbouring_large_ids(spark, docs):
    """Equal texts link under the least id, which doubles could not tell apart."""
    twins = docs.select("doc_id", F.lit("one two three four five six").alias("text"))
    got = {(r.doc_id, r.component_id) for r in jaccard_join.join(spark, twins).collect()}
    assert got == {(i, -(2**62) - 7) for i in IDS}


def test_repeated_rows_are_dealt_evenly(spark):
    """One row many times over: no bucket and no shard takes them all."""
    pieces = packing.written(spark.range(4000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                                      F.lit(1000).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32")).repartition(3), "pieces")
    out = packing.pack(pieces, bucket_pieces=500)
    sizes = [r["count"] for r in out.groupBy((F.col("sequence_id") / 2**32).cast("int")).count().collect()]
    assert out.count() == 4000 and len(sizes) == 8 and max(sizes) < 700
