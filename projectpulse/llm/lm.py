"""Language-model scoring by deleted interpolation (operator 9).

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end token a text.  A
token's probability mixes three estimates: its share among the tokens that followed the token
before it, its share among all tokens, and an equal share for every known token and one unknown.
The weights depend on the bucket of how often the context was seen (powers of two), and are learned
by expectation-maximisation on held-out counts: for the tuning texts (a tenth of the training texts)
the estimates are made without these texts' own counts.

Counts go through Spark in blocks.  Texts are dealt into shards by hash; a shard sends each reducer
the sorted distinct keys (64-bit hashes of tokens and of pairs) of that reducer's range with its
counts; the reducer adds them up over all shards and answers with the totals in the same order.
So every token of the corpus is counted, each distinct key of a shard crosses the network once,
and no task holds more than its range or its shard.  Hot tokens are one key in each block.

The totals come back to the texts as two arrays per text (``c1`` and ``c2`` of each token), which
are written to the shared folder; fitting the weights and scoring read these.

Edge cases: a null text is empty and has the end token only.  A null id counts as a training text.
Repeated rows are texts of their own.  Without training tokens every count is 0; without tuning
texts the weights are equal.  A long text is one shard's; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from projectpulse.llm.bytesops import Words, mix
from projectpulse.llm.common import by_pandas, crc_mod, has_locator, ship_code, table, written
from projectpulse.llm.exchange import Blocks, pack_counts, unpack_counts

END = np.uint64(0x5E0D5E0D5E0D5E0D)
START = np.uint64(0x57A757A757A757A7)
#: Text in a shard, and text whose keys a reducer gets.
SHARD_BYTES = 6 << 20
REDUCER_BYTES = 6 << 20
BUCKETS = 40
#: Held-out events are gathered in cells of equal context bucket and nearly equal estimates
#: (this many cells to a factor of two); the fit sees the mean of each cell.
CELLS = 8


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token keys of all texts in order, keys of (token before, token), and tokens per text."""
    parts, counts = [], []
    for _, hashes, n in Words().stream(texts):
        ends = np.cumsum(n)
        parts.append(np.insert(hashes, ends, END))
        counts.append(n + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = np.concatenate(parts), np.concatenate(counts)
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[np.cumsum(counts) - counts] = START
    return keys, mix(before * np.uint64(0xD6E8FEB86659FD93) + mix(keys)), counts


def _distinct(keys: np.ndarray, train: np.ndarray, tune: np.ndarray):
    """Sorted distinct keys, the number of each token's key, and the counts in both kinds of texts."""
    unique, code = np.unique(keys, return_inverse=True)
    count = lambda rows: np.bincount(code[rows], minlength=len(unique))
    return unique, code, count(train), count(tune)


@dataclass(frozen=True)
class Model:
    tokens: int  # N
    distinct: int  # V
    texts: int  # training texts
    weights: np.ndarray  # bucket x (pair, single, uniform)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + floor(log2(count))."""
    return np.where(context > 0, np.frexp(np.maximum(context, 1).astype(float))[1], 0)


def counted(docs: DataFrame, train: Column, tune: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write and return a row per text: doc_id, train, tune, n, and as packed arrays the training
    counts ``c1`` of its tokens and ``c2`` of its pairs; for tuning texts also the counts ``h1`` and
    ``h2`` in tuning texts alone.  Rows with ``distinct`` hold parts of the number of distinct
    training tokens instead."""
    spark = docs.sparkSession
    ship_code(spark)
    rows = docs.select(docs[id_col].cast("string").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(True)).alias("train"), F.coalesce(tune, F.lit(False)).alias("tune"),
                       *([F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("at")] if has_locator(docs) else []))
    if "at" not in rows.columns:
        rows = written(rows, "lm-input").select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("at"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, math.ceil(size / SHARD_BYTES))
    blocks = Blocks(max(1, math.ceil(size / REDUCER_BYTES)))
    # By the place of a row in its file: repeated rows are dealt like others, and a row that is read again goes the same way.
    rows = rows.withColumn("shard", F.pmod(F.col("at"), F.lit(shards).cast("long")).cast("int")).drop("at")
    kind = docs.schema[id_col].dataType  # ids pass as text: pandas makes doubles of them next to a null

    def squeeze(batches):  # texts cross the network compressed
        for pdf in batches:
            pdf["text"] = [zlib.compress(t.encode("utf-8", "replace"), 1) for t in pdf["text"]]
            yield pdf
    rows = rows.mapInPandas(squeeze, "doc_id string, text binary, train boolean, tune boolean, shard int")

    def prepare(pdf):
        keys, pairs, counts = tokens([zlib.decompress(t) for t in pdf["text"]])
        train, tune = (np.repeat(pdf[c].to_numpy(bool), counts) for c in ("train", "tune"))
        return counts, (_distinct(keys, train, tune), _distinct(pairs, train, tune))

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        out = []
        for tag, (unique, _, in_train, in_tune) in enumerate(prepare(pdf)[1]):
            out += blocks.requests(shard, tag, unique, in_train, in_tune)
        return pd.DataFrame(out, columns=Blocks.REQUEST_COLUMNS)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tag, group in pdf.groupby("tag", sort=True):
            merged, spread = blocks.merge(group)
            in_train, in_tune = merged
            out += spread(in_train, in_tune)
            if tag == 0:
                out.append((-1, 0, int(group["reducer"].iloc[0]), pack_counts(np.array([np.count_nonzero(in_train)])), b""))
        return pd.DataFrame(out, columns=Blocks.REPLY_COLUMNS)

    columns = ["doc_id", "train", "tune", "n", "c1", "c2", "h1", "h2", "distinct"]

    def place(key, pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            found = sum(int(unpack_counts(b)[0]) for b in replies["first"])
            return pd.DataFrame([(None, False, False, 0, None, None, None, None, found)], columns=columns)
        counts, kinds = prepare(pdf)
        ends = np.cumsum(counts)
        per_tag = []
        for tag, (unique, code, _, _) in enumerate(kinds):
            first, second = blocks.collect(replies[replies["tag"] == tag], len(unique))
            per_tag.append((first[code], second[code]))
        (c1, h1), (c2, h2) = per_tag
        out = []
        for doc_id, train, tune, a, b in zip(pdf["doc_id"], pdf["train"], pdf["tune"], ends - counts, ends):
            out.append((doc_id, train, tune, b - a, pack_counts(c1[a:b]), pack_counts(c2[a:b]),
                        pack_counts(h1[a:b]) if tune else None, pack_counts(h2[a:b]) if tune else None, None))
        return pd.DataFrame(out, columns=columns)
    replies = (rows.groupBy("shard").applyInPandas(ask, Blocks.REQUEST_SCHEMA)
               .groupBy("reducer").applyInPandas(answer, Blocks.REPLY_SCHEMA))
    out = rows.groupBy("shard").cogroup(replies.groupBy("shard")).applyInPandas(
        place, "doc_id string, train boolean, tune boolean, n long, c1 binary, c2 binary, h1 binary, h2 binary, distinct long")
    return written(out.withColumn("doc_id", F.col("doc_id").cast(kind)), "lm-counts")


def _joined(arrays) -> np.ndarray:
    parts = [unpack_counts(a) for a in arrays]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def contexts(c1: np.ndarray, n: np.ndarray, texts: int) -> np.ndarray:
    """How often what stands before each token was followed by a token: the count of the token
    before it, or of all training texts at the start."""
    out = np.empty_like(c1)
    out[1:] = c1[:-1]
    out[np.cumsum(n) - n] = texts
    return out


def fit(counts: DataFrame, n_tokens: int, n_distinct: int, n_texts: int, rounds: int = 60) -> np.ndarray:
    """Mixture weights by expectation-maximisation on the tuning texts' events.  Tasks send cells,
    whose number is bounded by buckets and estimates, not by the corpus."""
    tuned = counts.where("tune and distinct is null")
    held_tokens, held_texts = tuned.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    equal = np.full((BUCKETS, 3), 1 / 3)
    if not held_tokens:
        return equal
    left = max(n_tokens - held_tokens, 1)

    def cells(batches):
        for pdf in batches:
            n = pdf["n"].to_numpy()
            c1, c2 = _joined(pdf["c1"]) - _joined(pdf["h1"]), _joined(pdf["c2"]) - _joined(pdf["h2"])
            context = contexts(c1, n, n_texts - held_texts)
            pair = np.log2(np.maximum(c2, 1e-9) / np.maximum(context, 1))
            single = np.log2(np.maximum(c1, 1e-9) / left)
            out = pd.DataFrame({"bucket": bucket_of(context),
                                "pair": np.where(c2 > 0, np.floor(pair * CELLS), 1).astype(int),
                                "single": np.where(c1 > 0, np.floor(single * CELLS), 1).astype(int),
                                "events": 1, "log_pair": pair, "log_single": single})
            yield out.groupby(["bucket", "pair", "single"], as_index=False).sum()
    schema = "bucket int, pair int, single int, events long, log_pair double, log_single double"
    found = (tuned.select("n", "c1", "c2", "h1", "h2").mapInPandas(cells, schema).groupBy("bucket", "pair", "single")
             .agg(*(F.sum(c).alias(c) for c in ("events", "log_pair", "log_single"))).toPandas()
             .sort_values(["bucket", "pair", "single"]))
    pair = np.where(found["pair"] <= 0, 2 ** (found["log_pair"] / found["events"]), 0)
    single = np.where(found["single"] <= 0, 2 ** (found["log_single"] / found["events"]), 0)
    parts = np.stack([pair, single, np.full(len(found), 1 / (n_distinct + 1))], axis=1)
    weights, events = equal.copy(), found["events"].to_numpy(float)
    bucket = found["bucket"].to_numpy()
    for b in np.unique(bucket):
        rows = bucket == b
        w = np.array([1 / 3] * 3)
        for _ in range(rounds):
            share = parts[rows] * w
            share = share / share.sum(axis=1, keepdims=True)
            w = (share * events[rows, None]).sum(axis=0) + 1e-3  # no weight vanishes
            w = w / w.sum()
        weights[b] = w
    return weights


def learn(counts: DataFrame) -> Model:
    n_tokens, n_texts, n_distinct = counts.agg(
        F.coalesce(F.sum(F.when(F.col("train"), F.col("n"))), F.lit(0)), F.count_if("train"),
        F.coalesce(F.sum("distinct"), F.lit(0))).first()
    return Model(n_tokens, n_distinct, n_texts, fit(counts, n_tokens, n_distinct, n_texts))


def score(counts: DataFrame, model: Model) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score of every text."""
    n, v = model.tokens, model.distinct
    weights = model.weights

    def run(batches):
        for pdf in batches:
            size = pdf["n"].to_numpy()
            c1, c2 = _joined(pdf["c1"]), _joined(pdf["c2"])
            context = contexts(c1, size, model.texts)
            w = weights[bucket_of(context)]
            p = w[:, 0] * c2 / np.maximum(context, 1) + w[:, 1] * c1 / max(n, 1) + w[:, 2] / (v + 1)
            base = np.log10((c1 + 1) / (n + 1 * (v + 1)))
            starts = np.cumsum(size) - size
            total = lambda x: np.add.reduceat(x, starts) if len(starts) else x[:0]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "train": pdf["train"], "n_tokens": size,
                                "n_known": total((c1 > 0).astype(np.int64)), "train_tokens": n,
                                "base_score": total(base), "score": total(np.log10(p))})
    return by_pandas(counts.where("distinct is null").select("doc_id", "train", "n", "c1", "c2"), run,
                     "train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    train = crc_mod(F.col("doc_id"), 7) != 2
    counts = counted(docs, train, train & (F.pmod(F.floor(crc / 7), F.lit(10)) == 0))
    scored = score(counts, learn(counts))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
