"""Document fingerprints by SpotSigs (operator 4).

Words are runs of ASCII letters, digits and all bytes from 0x80 up, with A-Z lower-cased.  Every
common word is an anchor; it and the chain of the next ``CHAIN`` content words (words that are not
common) after it form a signature.  A fingerprint is the set of a text's signatures, written as
sorted 32-bit hashes in hex; the likeness of two texts is the Jaccard coefficient of their sets.

``similar_pairs`` finds all texts that are alike: equal fingerprints are one class; classes are
partitioned by the length of their sets, so that only the same and neighbouring partitions can
hold partners; within these, candidates share a signature of their prefixes, and the Jaccard
coefficient is computed only where the lengths allow the threshold.

Where more than ``DROUGHT`` words follow each other without a common one (lists, junk), each further
word is an anchor itself.

Edge cases: a null text is empty.  A text without any complete chain has its distinct words as
signatures, and one without words its bytes.  So equal texts have equal fingerprints, and no
fingerprint is empty.  Rows with equal ids are ordered by text; null ids come last.  The next
document of a sole document is itself.  An empty table gives an empty result; extra columns are
ignored.  Ids are numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from projectpulse.llm.bytesops import Words, mix
from projectpulse.llm.common import by_pandas, id_text, ship_code, slices, table, text_or_empty

# Common words of English, German, French and Spanish.
COMMON = (
    "a an the of and in to is are was were be been that this these it he she they you we on at as by for from with or "
    "not have has had do can will there is said all which when who "
    "der die das den dem des ein eine einen und in im zu zum zur ist sind war mit von vom auf für an als bei aus nach "
    "nicht sich es er sie wir ich auch wie oder "
    "le la les l un une des du de d et en au aux à est sont était dans par pour sur avec que qui ne pas ce cette il elle "
    "se son sa ses ou plus "
    "el los las una uno del y o al es son era en por para con sin que se su sus no lo como más este esta pero").split()
CHAIN = 2
GAP = rb"\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f"
#: After so many words without a common word, each further word is an anchor itself, until the next common one.
DROUGHT = 8
BUCKET_ROWS, BUCKET_BYTES = 20_000, 32 << 20


class Spotter:
    def __init__(self, common: list[str] = COMMON, chain: int = CHAIN):
        self.words, self.chain = Words(GAP), chain
        self.common = np.unique(self.words.of(list(common)))

    def signatures(self, texts: list[str]) -> list[np.ndarray]:
        """The sorted set of signatures (uint32) of each text."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        out: list = []
        for numbers, hashes, counts in self.words.stream(raw):
            common = np.isin(hashes, self.common)
            ends = np.cumsum(counts)
            text_of = np.repeat(np.arange(len(counts)), counts)
            content = np.flatnonzero(~common)
            sigs, of = self._chains(hashes, text_of, np.flatnonzero(common), content, False)
            at = np.arange(len(hashes))
            last = np.maximum(np.maximum.accumulate(np.where(common, at, -1)), (ends - counts)[text_of] - 1) if len(at) else at
            more, of_more = self._chains(hashes, text_of, np.flatnonzero(at - last > DROUGHT), content, True)
            sigs, of = np.concatenate([sigs, more]), np.concatenate([of, of_more])
            none = np.isin(text_of, np.setdiff1d(np.flatnonzero(counts), of))
            sigs, of = np.concatenate([sigs, mix(hashes[none])]), np.concatenate([of, text_of[none]])
            keys = np.unique(of.astype(np.uint64) << np.uint64(32) | (sigs >> np.uint64(32)))
            of, sigs = (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32)
            bounds = np.searchsorted(of, np.arange(len(counts) + 1))
            for k, i in enumerate(numbers):
                own = sigs[bounds[k]:bounds[k + 1]]
                if not len(own):
                    own = np.frombuffer(hashlib.sha256(raw[i]).digest()[:4], np.uint32)
                out.append(own)
        return out

    def _chains(self, hashes, text_of, anchors, content, own: bool):
        """Signatures of anchors with a whole chain in their text, and the numbers of the texts."""
        first = np.searchsorted(content, anchors, side="right")
        ok = first + self.chain <= len(content)
        anchors, first = anchors[ok], first[ok]
        if len(anchors):
            ok = text_of[content[first + self.chain - 1]] == text_of[anchors]
            anchors, first = anchors[ok], first[ok]
        sig = hashes[anchors] * np.uint64(0x2545F4914F6CDD1D) + np.uint64(own)
        for k in range(self.chain):
            sig = mix(sig) * np.uint64(0x9E3779B97F4A7C15) + hashes[content[first + k]]
        return mix(sig), text_of[anchors]


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard coefficient of two sorted sets; 0 if the lengths alone rule out ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_text(signatures: np.ndarray) -> str:
    return signatures.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``signatures`` (sorted distinct longs) of every whole text."""
    ship_code(docs.sparkSession)

    def run(batches):
        spotter = Spotter()
        for pdf in (part for batch in batches for part in slices(batch, "text")):
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "signatures": [
                s.astype(np.int64) for s in spotter.signatures(pdf["text"].fillna("").tolist())]})
    return by_pandas(id_text(docs, id_col, text_col), run, "signatures array<long>")


def similar_pairs(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(membership: doc_id, class_id; pairs: left_id, right_id, similarity between classes).
    A class is all documents of one fingerprint, named by its least id."""
    members = fingerprints(docs, id_col, text_col).withColumn("print", F.xxhash64("signatures")).withColumn(
        "class_id", F.min("doc_id").over(W.partitionBy("print")))
    classes = members.groupBy("class_id").agg(F.first("signatures").alias("signatures")).withColumn("n", F.size("signatures"))
    # Partition k holds the lengths from threshold**-k to threshold**-(k+1): partners lie in k-1, k or k+1.
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(-float(np.log(threshold))) + 1e-9).cast("int")
    prefix = F.slice("signatures", F.lit(1), (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1).cast("int"))
    heads = classes.select("class_id", "n", part.alias("part"), F.explode(prefix).alias("sig"))
    other = heads.select(F.col("class_id").alias("right_id"), F.col("n").alias("m"), "sig",
                         F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"))
    found = (heads.join(other, ["part", "sig"]).where("class_id < right_id")
             .where((F.least("n", "m") >= F.lit(threshold) * F.greatest("n", "m") - 1e-9))
             .select(F.col("class_id").alias("left_id"), "right_id").distinct())
    sets = classes.select("class_id", "signatures")
    both = F.size(F.array_intersect("a", "b"))
    pairs = (found.join(sets.select(F.col("class_id").alias("left_id"), F.col("signatures").alias("a")), "left_id")
             .join(sets.select(F.col("class_id").alias("right_id"), F.col("signatures").alias("b")), "right_id")
             .select("left_id", "right_id", (both / (F.size("a") + F.size("b") - both)).alias("similarity"))
             .where(F.col("similarity") >= threshold))
    return members.select("doc_id", "class_id"), pairs


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS,
              bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, text and next_text: the text of the following document in descending order of ids,
    after the last the first.  Ids are dealt into ranges of about ``bucket_rows`` and ``bucket_bytes``; each range also
    gets the first row of the range that follows, so no task sees more than its range."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_or_empty(docs[text_col]).alias("text"))
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    ranges = max(1, round(count / bucket_rows), round(size / bucket_bytes))
    cuts = []
    if ranges > 1:
        at = [k / ranges for k in range(1, ranges)]
        cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", at, 20 * ranges)).first()[0] or []))
    edges = np.array(cuts)

    def deal(ids):  # Arrow keeps whole numbers next to nulls as they are
        at = np.searchsorted(edges, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), side="left")
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), -1, at), pa.int32())
    deal.__annotations__ = {"ids": pa.Array, "return": pa.Array}
    rows = rows.withColumn("bucket", F.arrow_udf(deal, "int")("doc_id"))
    heads = sorted(rows.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect(), key=lambda r: -r.bucket)
    if not heads:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    follow = spark.createDataFrame([(heads[(k + 1) % len(heads)].head, h.bucket) for k, h in enumerate(heads)], f"head {kind}, target int")
    guards = (rows.join(F.broadcast(follow), F.col("doc_id").eqNullSafe(F.col("head")))
              .groupBy("target").agg(F.min("text").alias("text"))
              .select(F.lit(None).cast(kind).alias("doc_id"), "text", F.col("target").alias("bucket"), F.lit(True).alias("guard")))
    order = W.partitionBy("bucket").orderBy("guard", F.desc_nulls_last("doc_id"), "text")
    # One task for each range: dealt by hash, several ranges would meet in one.
    return (rows.withColumn("guard", F.lit(False)).unionByName(guards).repartitionByRange(len(heads), "bucket")
            .withColumn("next_text", F.lead("text").over(order)).where("not guard")
            .select("doc_id", "text", "next_text"))


def compare_edits(rows: DataFrame) -> DataFrame:
    """For rows (doc_id, text, next_text): fingerprints of the text and of its edited text (the last
    third replaced by the start of the next text), and their likeness to each other and to the next
    text.  Rows come in the order of ``with_next``, so most next texts are fingerprinted only once."""
    ship_code(rows.sparkSession)

    def run(batches):
        spotter = Spotter()
        for pdf in (part for batch in batches for part in slices(batch, "text", "next_text")):
            texts, following = pdf["text"].tolist(), pdf["next_text"].tolist()
            edited = [t[:len(t) - len(t) // 3] + f[:len(t) // 3] for t, f in zip(texts, following)]
            n = len(texts)
            apart = [i for i in range(n) if i + 1 == n or following[i] != texts[i + 1]]
            sigs = spotter.signatures([*texts, *edited, *(following[i] for i in apart)])
            nexts = sigs[1:n] + [None]
            for i, s in zip(apart, sigs[2 * n:]):
                nexts[i] = s
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "n_chars": [len(t) for t in texts],
                "edited_sha256": [hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited],
                "fingerprint": [as_text(s) for s in sigs[:n]], "edited_fingerprint": [as_text(s) for s in sigs[n:2 * n]],
                "near_edited": [jaccard(a, b) for a, b in zip(sigs[:n], sigs[n:2 * n])],
                "near_next": [jaccard(a, b) for a, b in zip(sigs[:n], nexts)]})
    return by_pandas(rows, run, "n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(with_next(table(spark, sf_dir, "documents")))
