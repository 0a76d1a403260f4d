"""Cleaning and packing of ``documents``: the stages of the training-data pipeline.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from projectpulse.llm import exact_dedup, jaccard_join, langid, packing, suffix_dedup
from projectpulse.llm.common import table, written

#: A vector unrelated to all languages has a cosine above the least score with at most this chance.
CHANCE = 0.01
#: A text must score this share of what all but so many of the labelled texts of its language and length class score.
LOW_SHARE, LOW_QUANTILE = 0.5, 0.01


def min_score(languages: int) -> float:
    """The least score against so many languages: the greatest of their cosines counts, each of which has a
    standard deviation of 1 / sqrt(DIMENSIONS) for an unrelated vector."""
    return NormalDist().inv_cdf(1 - CHANCE / languages) * langid.DIMENSIONS ** -0.5


#: The least score where there is one language.
MIN_SCORE = min_score(1)
#: Characters that the packing stage tokenizes at a time: workers of the stages before it still hold memory.
PACK_CHUNK = 1 << 19
#: Near copies share at least so many percent of their shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: A passage repeats from so many words on, or from as many bytes as op5 takes.
PASSAGE_WORDS = 50


def length_class(text: Column) -> Column:
    """Powers of four of the number of characters: short texts have lower cosines."""
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1))) / 2).cast("int")


def least_scores(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> list[tuple[str, int, float]]:
    """(language, length class, least score), from all labelled rows whose label is found again.  A class without
    such rows takes over from the next shorter one that has some; without any the chance bound alone holds."""
    rows = docs.where("lang is not null and text is not null").select("text", "lang")
    own = langid.predict(rows, prototypes).where("lang = lang_pred").groupBy("lang", length_class(F.col("text")).alias("class"))
    low = {(r["lang"], r["class"]): r["low"] for r in own.agg(F.percentile_approx("score", LOW_QUANTILE).alias("low")).collect()}
    out = []
    for lang in prototypes:
        least = min_score(len(prototypes))
        for k in range(16):  # lengths are 31-bit numbers
            if (lang, k) in low:
                least = max(LOW_SHARE * low[lang, k], min_score(len(prototypes)))
            out.append((lang, k, float(least)))
    return out


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that resemble one of the languages of the labelled documents stay: those that score as
    texts of that language and length do, and above chance.  A null label is filled with the language found.  Without any labelled text nothing can be judged and all stay."""
    prototypes = langid.learn(docs)
    if not prototypes:
        return docs
    least = spark.createDataFrame(least_scores(docs, prototypes), "__lang string, __class int, __least double")
    judged = langid.predict(docs, prototypes)
    near = (F.col("lang_pred") == F.col("__lang")) & (length_class(F.col("text")) == F.col("__class"))
    return judged.join(F.broadcast(least), near).where("score >= __least").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts the one with the least id stays."""
    return exact_dedup.keep_first(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link by their shingles of five words the one with the least id stays."""
    return jaccard_join.keep_one(spark, docs, n=NEAR_WORDS, threshold=NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat are taken out of the texts; documents of which nothing is left go."""
    cleaned = suffix_dedup.cleaned(docs, least=suffix_dedup.LENGTH // PASSAGE_WORDS)
    emptied = (F.trim("text") == "") & (F.coalesce(F.col("n_chars"), F.lit(0)) > 0)
    return (cleaned.where(~F.coalesce(emptied, F.lit(False)))
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of every document that is left, packed into sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), chunk=PACK_CHUNK, forget=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("suffix_dedup", repeated_passages),
    ("packing", pack),
]

#: Language identification, prefix doubling and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return last(spark, docs, sf_dir)
