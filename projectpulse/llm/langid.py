"""Language identification with hyperdimensional profiles (operator 2).

Every letter has a random vector of +1 and -1.  An n-gram's vector binds its letters' vectors, each
permuted (rotated) by its place, by multiplication.  A text bundles (adds) the vectors of all its
n-grams; a language's prototype bundles the unit vectors of its training texts; a text gets the
language whose prototype has the greatest cosine with it.

N-grams lie within words (runs of letters, lower-cased, with a boundary sign on both sides).

Edge cases: a null text or one without letters is ``und`` with score 0, and is not learned from;
a null label is not learned from.  Without any training text all are ``und``.  Equal cosines go to
the first language in alphabetical order.  Every row gives a row, also with null or repeated ids.
Long texts are bundled piece by piece.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from projectpulse.llm.bytesops import ragged
from projectpulse.llm.common import crc_mod, give_back, ship_code, table
from projectpulse.llm.pretokens import LETTER, classes

UNKNOWN = "und"
DIMENSIONS = 1024
NGRAM = 3
SEED = 20
#: Characters that are bundled at once.
CHUNK = 1 << 19
_CUT = re.compile(r"(?<=\S)[ \n]")


class Space:
    """Letter vectors of one seed, made when a letter is first seen."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = NGRAM, seed: int = SEED):
        self.dimensions, self.n, self.seed = dimensions, n, seed
        self.number: dict[int, int] = {}
        self.rows = np.zeros((0, dimensions), np.float32)

    def letters(self, points: np.ndarray) -> np.ndarray:
        """Row numbers of the vectors of these code points (0 is the boundary)."""
        new = [p for p in points.tolist() if p not in self.number]
        if new:
            made = [np.random.default_rng((self.seed, p)).integers(0, 2, self.dimensions) for p in new]
            self.rows = np.concatenate([self.rows, 2 * np.array(made, np.float32) - 1])
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        return np.array([self.number[p] for p in points.tolist()], np.int64)

    def bind(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of n-grams, given as rows of code points."""
        out = None
        for place in range(self.n):
            unique, code = np.unique(grams[:, place], return_inverse=True)
            rows = self.letters(unique)
            v = np.roll(self.rows[rows], self.n - 1 - place, axis=1)[code]
            out = v if out is None else np.multiply(out, v, out=out)
        return out

    def bundle(self, texts: list[str]) -> np.ndarray:
        """One vector for each text: the sum over all its n-grams (zero without letters)."""
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
        lengths = np.array([len(t) for t in lowered], np.int64)
        # A boundary before each text; all signs that are no letters are boundaries.
        flat = np.zeros(len(points) + len(texts) + 1, np.uint32)
        starts = np.cumsum(lengths + 1) - lengths
        letter = np.where(classes()[points] == LETTER, points, 0) if len(points) else points
        flat[ragged(starts, lengths)] = letter
        windows = np.lib.stride_tricks.sliding_window_view(flat, self.n)
        inner = windows[:, 1:-1] if self.n > 2 else windows
        at = np.flatnonzero((inner != 0).all(axis=1))
        out = np.zeros((len(texts), self.dimensions), np.float32)
        if not len(at):
            return out
        text_of = np.searchsorted(starts, at + 1, side="right") - 1
        key = np.zeros(len(at), np.uint64)
        for place in range(self.n):
            key = (key << np.uint64(21)) | flat[at + place].astype(np.uint64)
        codes, unique = pd.factorize(key)
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = at[::-1]
        vectors = self.bind(windows[first])
        step = max(1, (1 << 22) // len(unique))
        for a in range(0, len(texts), step):
            lo, hi = np.searchsorted(text_of, [a, a + step])
            n = min(step, len(texts) - a)
            counts = np.bincount((text_of[lo:hi] - a) * len(unique) + codes[lo:hi], minlength=n * len(unique))
            out[a:a + n] = counts.reshape(n, -1).astype(np.float32) @ vectors
        return out

    def unit(self, texts: list[str]) -> np.ndarray:
        """Unit vectors of whole texts, in order; zero vectors for texts without letters."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        for numbers, pieces in _pieces(texts):
            np.add.at(out, numbers, self.bundle(pieces))
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of about CHUNK characters in all with the numbers of their texts; long texts are cut
    between words."""
    numbers, held, total = [], [], 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t) or at == 0:
            m = _CUT.search(t, at + CHUNK) if len(t) - at > CHUNK else None
            piece = t[at:m.start() if m else len(t)]
            if held and total + len(piece) > CHUNK:
                yield numbers, held
                numbers, held, total = [], [], 0
            numbers.append(i)
            held.append(piece)
            total += len(piece)
            at += max(len(piece), 1)
    if held:
        yield numbers, held


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", space: Space | None = None,
          max_languages: int = 5000) -> dict[str, np.ndarray]:
    """Prototype of every language, from all labelled rows.  Tasks send one vector per language they
    have seen; these are added per (language, dimension).  The result is bounded by the number of
    languages: more than ``max_languages`` is an error."""
    ship_code(docs.sparkSession)
    space = space or Space()
    args = (space.dimensions, space.n, space.seed)

    def run(batches):
        own, sums = Space(*args), {}
        for pdf in batches:
            vectors = own.unit(pdf["text"].tolist())
            for lang, rows in pdf.reset_index(drop=True).groupby("lang").indices.items():
                sums[lang] = sums.get(lang, 0) + vectors[rows].astype(np.float64).sum(axis=0)
        for lang, v in sums.items():
            yield pd.DataFrame({"lang": lang, "dim": np.arange(len(v), dtype=np.int32), "value": v})
        give_back()
    rows = docs.select(docs[text_col].alias("text"), docs[lang_col].alias("lang")).dropna()
    sums = rows.mapInPandas(run, "lang string, dim int, value double").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    languages = (sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
                 .limit(max_languages + 1).collect())
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    out = {}
    for r in languages:
        v = np.zeros(space.dimensions)
        v[[x.dim for x in r.v]] = [x.value for x in r.v]
        if np.linalg.norm(v) > 0:
            out[r.lang] = v / np.linalg.norm(v)
    return dict(sorted(out.items()))


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", space: Space | None = None) -> DataFrame:
    """The rows of ``docs`` with lang_pred and score (cosine, not below 0)."""
    ship_code(docs.sparkSession)
    space = space or Space()
    args = (space.dimensions, space.n, space.seed)
    names = np.array([*prototypes, UNKNOWN], object)
    matrix = np.array([*prototypes.values()], np.float32).reshape(-1, space.dimensions)

    def run(texts):
        own = Space(*args)
        for s in texts:
            vectors = own.unit(s.fillna("").tolist())
            best, score = np.full(len(s), len(matrix)), np.zeros(len(s))
            if len(matrix) and len(s):
                cosines = vectors @ matrix.T
                some = vectors.any(axis=1)
                best = np.where(some, cosines.argmax(axis=1), best)
                score = np.where(some, np.clip(cosines.max(axis=1), 0, 1), 0.0)
            yield pd.DataFrame({"lang_pred": names[best], "score": score.astype(float)})
        give_back()
    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}  # evaluated, for Spark
    # Else a filter on the result runs the function a second time below the filter, with a worker of its own in each task.
    guess = F.pandas_udf(run, "lang_pred string, score double").asNondeterministic()
    hidden = "__guess"
    return docs.withColumn(hidden, guess(docs[text_col])).select(
        *[docs[c] for c in docs.columns if c not in ("lang_pred", "score")], f"{hidden}.lang_pred", f"{hidden}.score")


def held_out(id_col: Column) -> Column:
    return F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = learn(docs.where(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, prototypes).drop("text")
