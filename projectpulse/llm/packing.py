"""Best-fit packing of token pieces into sequences (operator 1).

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece
lengths).  Pieces go in decreasing order; each goes into the open sequence that fits it best under
every constraint, either by the least weighted norm of the residual capacities that it would leave
or by the greatest weighted dot-product of its needs with the residual capacities.

Pieces are dealt evenly into buckets of about ``bucket_pieces`` and each bucket is packed by a
task of its own.  A bucket leaves about one sequence partly filled, so the loss against packing
all pieces at once is some hundredths of a percent, whatever the size of the input.

Edge cases: a null text is empty and still gives the closing id.  Null and repeated ids: every row
is packed as a document of its own.  Long documents give as many pieces as they need; the first is
the one that may be shorter.  Pieces with equal needs are ordered by id (as text) and piece.  An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from projectpulse.llm.common import by_pandas, id_text, table, written
from projectpulse.llm.pretokens import CHUNK, Encoder

END_ID = 0
#: Distinct matches whose ids a worker remembers: some 150 MB.
KNOWN = 1_200_000


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence, and the weight of each (of its share of the limit) in the choice."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4)
    rule: str = "norm"  # or "dot"


@cache
def tokenizer(path: str):
    """Encoder of byte strings by a tokenizer file, and the whole tokenizer.  A task has one core: the library's
    own threads would take those of other tasks and wait for each other."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        gc.disable()  # the collector would walk over hundreds of thousands of small lists again and again
        try:
            ids = [e.ids for e in tok.encode_batch_fast([w.decode("utf-8") for w in words], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))
        finally:
            gc.enable()
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    return Encoder(encode, KNOWN), tok, special


def token_parts(texts: list[str], path: str, chunk: int = CHUNK) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Parts of each text's ids in order.  Texts that hold a special token's string go through the
    tokenizer whole; all others by their distinct matches, which gives the same ids, in chunks of so many characters:
    smaller ones take less memory and more time."""
    encoder, tok, special = tokenizer(path)
    odd = [i for i, t in enumerate(texts) if any(s in t for s in special)]
    for i in odd:
        yield i, np.array(tok.encode(texts[i], add_special_tokens=False).ids, np.uint32), True
    even = [i for i in range(len(texts)) if i not in set(odd)] if odd else range(len(texts))
    for k, ids, last in encoder.stream([texts[i] for i in even], chunk):
        yield even[k], ids, last


def cut(docs: DataFrame, tokenizer_path: str, size: int, id_col: str = "doc_id", text_col: str = "text",
        chunk: int = CHUNK, forget: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document, closing id included.  With ``forget`` a
    worker drops the tokenizer and its matches after each task: less memory held, some matches encoded again."""
    def run(batches):
        for pdf in batches:
            rows, held = [], {}
            for i, ids, last in token_parts([t or "" for t in pdf["text"]], tokenizer_path, chunk):
                held.setdefault(i, []).append(ids)
                if last:
                    ids = np.concatenate([*held.pop(i), [END_ID]]).astype("<u4")
                    first = len(ids) % size or size
                    starts = [0, *range(first, len(ids), size)]
                    for p, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                        rows.append((i, p, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            out = pd.DataFrame(rows, columns=["at", "piece", "start", "length", "ids_crc32"])
            out.insert(0, "doc_id", pdf["doc_id"].reset_index(drop=True).reindex(out["at"]).to_numpy())
            yield out.drop(columns="at")
        if forget:
            tokenizer.cache_clear()
    return by_pandas(id_text(docs, id_col, text_col), run, "piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece.  A piece that alone exceeds a capacity raises."""
    limits = np.array([cap.tokens, cap.documents, cap.attention], float)
    weights = np.array(cap.weights)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    if not len(lengths):
        return sequence, offset
    if lengths.max() > cap.tokens or float(lengths.max()) ** 2 > cap.attention or cap.documents < 1:
        raise ValueError("a piece exceeds the capacity of a sequence")
    order = np.argsort(-lengths, kind="stable")
    least = float(lengths.min())
    # Residual shares of the open sequences and their numbers; closed ones are cleared out.
    left = np.zeros((3, 1024))
    name, used = np.zeros(1024, np.int64), 0
    count = 0
    for k, i in enumerate(order.tolist()):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        fits = np.flatnonzero((left[0, :used] >= need[0]) & (left[1, :used] >= 1) & (left[2, :used] >= need[2])) \
            if need[0] + least <= cap.tokens else ()
        if len(fits):
            if cap.rule == "dot":
                score = ((weights * need / limits ** 2)[:, None] * left[:, fits]).sum(axis=0)
                at = fits[score.argmax()]
            else:
                rest = (left[:, fits] - need[:, None]) / limits[:, None]
                at = fits[(weights[:, None] * rest * rest).sum(axis=0).argmin()]
        else:
            if used == left.shape[1]:
                open_ = (left[0] >= least) & (left[1] >= 1) & (left[2] >= least * least)
                used = int(open_.sum())
                left[:, :used], name[:used] = left[:, open_], name[open_]
                if 2 * used > left.shape[1]:
                    left = np.concatenate([left, np.zeros_like(left)], axis=1)
                    name = np.concatenate([name, np.zeros_like(name)])
            at, used, count = used, used + 1, count + 1
            left[:, at], name[at] = limits, count - 1
        sequence[i], offset[i] = name[at], cap.tokens - left[0, at]
        left[:, at] -= need
    return sequence, offset


def pack(pieces: DataFrame, cap: Capacity = Capacity(), bucket_pieces: int = 20_000) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...).  Reads them twice, so
    they should be a written table."""
    buckets = max(1, round(pieces.count() / bucket_pieces))
    # By the place of a row in the table, so that repeated rows are dealt like others; the id passes as text (``by_pandas``).
    dealt = pieces.withColumns({"bucket": F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets).cast("long")),
                                "doc_id": F.col("doc_id").cast("string")})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable").reset_index(drop=True)
        sequence, offset = best_fit(pdf["length"].to_numpy(), cap)
        pdf["sequence_id"] = (pdf["bucket"].to_numpy() << 32) + sequence
        pdf["offset"] = offset
        return pdf.drop(columns="bucket")
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema} | {"doc_id": "string"}
    schema = ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", sequence_id long, offset long"
    return dealt.groupBy("bucket").applyInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast(pieces.schema["doc_id"].dataType))


def pack_documents(docs: DataFrame, tokenizer_path: str, cap: Capacity = Capacity(), id_col: str = "doc_id",
                   text_col: str = "text", chunk: int = CHUNK, forget: bool = False) -> DataFrame:
    return pack(written(cut(docs, tokenizer_path, cap.tokens, id_col, text_col, chunk, forget), "pack-pieces"), cap)


def op1_pack(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
