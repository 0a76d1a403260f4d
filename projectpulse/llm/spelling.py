"""Spelling variants by pivotal grams (operator 13).

1. Words are counted: each task adds up the words of its texts, Spark adds up the rest.
2. Bigrams are ranked by the number of words that hold them, rare ones first; the alphabet bounds their
   number.  The prefix of a word is its three first bigrams in that order, with all further places of the
   last of them: one edit of a neighbour spoils at most two bigrams, so at least one of three survives.
3. Two bigrams of the prefix that do not overlap are the word's pivots, the rarest such pair by dynamic
   programming.  One edit cannot touch both.  If it lies behind the first pivot, the neighbour has the
   same letters from its start to the end of that pivot; if not, the same letters from the second pivot
   to its end.  So the position limits are exact, and a pivot is looked up together with these letters.
   The edit lies in one half of the rest, so the letters of the other half are part of the key as well,
   and so are both lengths: a frequent bigram at the start of a word gives no long list.
4. All prefix bigrams of all words are indexed under the same kinds of keys.  Pivots of a word meet
   prefixes of words whose last prefix bigram is as frequent or more so (the others meet the other way
   round); the edit distance verifies each pair.
5. The most frequent neighbour, if frequent enough, is a word's form; pointer doubling follows forms to
   the last one.  Each step multiplies the count by ``FACTOR`` at least, which bounds the rounds.

Edge cases: a null text has no words; a null id counts as an empty one.  Repeated rows count each.  An empty
table gives an empty result; extra columns are ignored.  A word without neighbours is its own root.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from projectpulse.llm.common import ship_code, table, written

GRAM, EDITS = 2, 1
LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
#: In one of so many (document, word) pairs a code point is left out.
TYPO = 199
RUN = r"[A-Za-zÀ-ÿ]"
#: A task passes its counts on whenever it holds so many words.
HELD = 200_000


def mistyped(word: str, mark: int, typo: int = TYPO) -> str:
    """The word without one code point, if ``typo`` divides the mark."""
    if mark % typo:
        return word
    at = mark % len(word)
    return word[:at] + word[at + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int = TYPO,
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n of every word of enough letters and occurrences."""
    ship_code(docs.sparkSession)
    run_of = re.compile(RUN + "{%d,}" % least_length)  # a run that is too short cannot grow

    def run(batches):
        held: Counter[str] = Counter()

        def passed():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, name in enumerate(batch.column("name").to_pylist()):
                text = texts[i].as_py()
                if not text:
                    continue
                seed = zlib.crc32(f"{name}:".encode())
                for word, n in Counter(run_of.findall(text.lower().decode("utf-8", "replace"))).items():  # bytes: only A-Z change
                    mark = zlib.crc32(word.encode(), seed)
                    if not mark % typo:
                        word = mistyped(word, mark, typo)
                        if len(word) < least_length:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield passed()
        yield passed()
    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("name"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """The place of every bigram, rare ones first.  At most the square of the alphabet's size (90) come to the driver."""
    at = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = F.array_distinct(F.transform(at, lambda i: F.substr("word", i, F.lit(GRAM))))
    counted = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().orderBy("count", "gram").collect()
    return {r["gram"]: k for k, r in enumerate(counted)}


def prefix(ranks: list[int], size: int = GRAM * EDITS + 1) -> list[int]:
    """Places of the first ``size`` grams by rank and place, and of all others of the last one's rank; by place."""
    order = sorted(range(len(ranks)), key=lambda i: (ranks[i], i))
    last = ranks[order[min(size, len(order)) - 1]]
    return [i for i, r in enumerate(ranks) if r <= last]


def pivots(ranks: list[int], places: list[int], count: int = EDITS + 1, gram: int = GRAM) -> list[int]:
    """``count`` of the places (ascending), no two closer than a gram, with the least sum of ranks.  ``best[j]`` holds
    the least sum of j grams among the places so far and these grams; a place extends what ends a gram before it."""
    best: list[list[tuple[int, tuple[int, ...]]]] = []
    for k, p in enumerate(places):
        before = next((best[j] for j in range(k - 1, -1, -1) if places[j] + gram <= p), [(0, ())])
        now = list(best[-1]) if best else [(0, ())]
        for j, (cost, chosen) in enumerate(before[:count]):
            option = (cost + ranks[p], (*chosen, p))
            if j + 1 == len(now):
                now.append(option)
            elif option < now[j + 1]:
                now[j + 1] = option
        best.append(now)
    return list(best[-1][count][1])


def halves(word: str, same: int, own: int, other: int) -> tuple[str, str] | tuple[()]:
    """Keys of a word (read from either end) whose first ``same`` letters a neighbour shares, for the lengths of the
    two: with the first half of the rest, or with the last.  None if the neighbour has no room for a second bigram."""
    rest = min(own, other) - same
    if rest < 1:
        return ()
    half = rest // 2
    return word[:same + half], f"{word[:same]}|{word[len(word) - (rest - half):]}"


def keys(word: str, first: int, second: int, look: bool) -> list[str]:
    """Keys for a bigram at ``first`` with the letters before it, and one at ``second`` with those after it, for all
    lengths of neighbours; marked by the direction and the lengths of the looking and the found word."""
    n, back = len(word), word[::-1]
    out = []
    for m in range(n - EDITS, n + EDITS + 1):
        sizes = f"{n},{m}" if look else f"{m},{n}"
        out += [f"<{sizes}|{k}" for k in halves(word, first + GRAM, n, m)]
        out += [f">{sizes}|{k}" for k in halves(back, n - second, n, m)]
    return out


def keyed(words: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """word, n, last (rank of the last prefix bigram), pivots and grams (keys to look up, and to be found under)."""
    ship_code(words.sparkSession)

    def run(batches):
        for batch in batches:
            last, look, found = [], [], []
            for word in batch.column("word").to_pylist():
                own = [ranks[word[i:i + GRAM]] for i in range(len(word) - GRAM + 1)]
                places = prefix(own)
                first, second = pivots(own, places)
                last.append(max(own[p] for p in places))
                look.append(keys(word, first, second, True))
                found.append([k for p in places for k in keys(word, p, p, False)])
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(last, pa.int32()), pa.array(look, pa.list_(pa.string())),
                                              pa.array(found, pa.list_(pa.string()))], names=["word", "n", "last", "pivots", "grams"])
    return words.mapInArrow(run, "word string, n long, last int, pivots array<string>, grams array<string>")


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, near and near_n: all pairs of words one edit apart, both ways.  ``words`` is a written table (word, n)."""
    rows = written(keyed(words, gram_ranks(words)), "spelling-keys")
    look = rows.select("word", "n", "last", F.explode("pivots").alias("key"))
    found = rows.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("last").alias("near_last"), F.explode("grams").alias("key"))
    met = look.join(found, "key").where(
        (F.col("last") <= F.col("near_last")) & (F.levenshtein("word", "near", EDITS) == EDITS))
    one = F.struct("word", "n", "near", "near_n")
    other = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # A pair may meet under both keys and both ways; dealt by word, the same shuffle serves what follows.
    return met.select(F.inline(F.array(one, other))).repartition("word").distinct()


def roots(links: DataFrame, rounds: int) -> DataFrame:
    """word and root: the last form reached from each word that has one, by pointer doubling."""
    now = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return now


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of a written table (word, n)."""
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))  # the greatest, of equals the first
    judged = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("own"), best.alias("best"))
    strong = -F.col("best.minus") >= F.lit(factor) * F.col("own")
    judged = written(judged.select("word", "n_near", F.when(strong, F.col("best.form")).alias("form"),
                                   F.when(strong, -F.col("best.minus")).alias("form_n")), "spelling-forms")
    least, most = words.agg(F.min("n"), F.max("n")).first()
    longest = int(math.log(most / least, factor) + 1e-9) if most else 0  # steps from the rarest to the most frequent word
    # After r rounds a root is up to 2 ** r steps away.
    ends = roots(judged.where("form is not null"), max(0, longest - 1).bit_length())
    return words.join(judged, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(written(vocabulary(table(spark, sf_dir, "documents")), "spelling-words"))


OP13_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL HAVING length(run) >= 6),
marked AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(range(1, length(hx), 2), lambda i: CAST('0x' || hx[i:i + 1] AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx FROM runs), tab),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM marked)
  GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
holes AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.cut = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM forms f JOIN walk w ON w.word = f.word
JOIN forms e ON e.word = w.root AND e.form IS NULL
"""
