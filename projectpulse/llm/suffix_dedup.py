"""Removal of repeated byte strings by distributed prefix doubling (operator 5).

Every byte that is covered by a string of ``LENGTH`` bytes which also starts anywhere else is
removed.  Sorting all positions of a corpus would move many times its size, so doubling runs on
sampled positions and the positions between them are settled afterwards, exactly:

* Anchors are the positions that hold the least 16-byte hash of some window of 64 positions.  They
  depend on the bytes around them alone, so equal strings have equal anchors inside.
* Length 100: anchors are ranked by their first 100 bytes.  A string can only repeat if all anchors
  well inside it are shared; what remains are the candidate regions, a small part of the corpus.
* Length 200, 400: the positions ``a`` and ``a + 200`` of the regions' anchors are ranked by 200
  bytes; pairs of ranks at offset 200 give the ranks by 400 bytes.  In each round the reducer of a range
  of keys (``exchange``, no Spark sort) ranks those that occur twice, and unique ones leave.
* Past the threshold: pairs of the ranks of neighbouring anchors (with their distance) tell whether
  the string from one anchor to 400 bytes after the next repeats; then every start between them
  repeats.
* The starts that are left unsettled lie around the ends of repeats.  They, and all starts whose
  next anchor has the same rank, are ranked by their whole 400 bytes.

Ranks and counts travel in blocks (``exchange``): a string that is in a third of all documents is
one key in each shard.  Copies of a whole text take part once: its print (SHA-256) stands for all
copies, and a text that occurs twice is removed as a whole if it has 400 bytes.

Callers may let every word count as ``least`` bytes at least (``widened``): with 8, a passage of 50 words
repeats as one of 400 bytes does.  The rounds then run on the widened texts.

Edge cases: a null text is empty; texts under 400 bytes keep all bytes unless null.  Repeated rows
are copies.  A very long text is cut into overlapping segments, each start belonging to one of
them.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from projectpulse.llm.bytesops import Spans, chunks, joined, mix
from projectpulse.llm.common import WHITESPACE, by_pandas, give_back, id_text, ship_code, table, written
from projectpulse.llm.exchange import Blocks

LENGTH = 400
FIRST, HALF = 100, 200
WINDOW, GRAM = 64, 16
SEGMENT = 1 << 20
SHARD_BYTES = 6 << 20
#: Texts with removed bytes go to the last scan as a broadcast up to so many bytes; beyond, by a shuffle join.
BROADCAST_BYTES = 16 << 20
#: A byte that UTF-8 never has.
FILLER = 0xFF
#: The first byte of a word after white space.
FRESH = re.compile(rb"(?<=[\x20\x09-\x0D])[^\x20\x09-\x0D]")
IS_GAP = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
PAIR, GAP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x2545F4914F6CDD1D)


class Strings:
    """Some byte strings in one buffer, with the hashes of their spans."""

    def __init__(self, texts: list[bytes]):
        self.buf, self.starts = joined(texts)
        self.spans = Spans(self.buf)
        self.ends = np.repeat(self.starts[1:].astype(np.int32), np.diff(self.starts))  # of the string of each byte

    def key(self, at: np.ndarray, size: int) -> np.ndarray:
        return self.spans.of(at, at + size)

    def fits(self, at: np.ndarray, size: int) -> np.ndarray:
        return at + size <= self.ends[at]

    def anchors(self) -> np.ndarray:
        """Positions of the least 16-byte hash of every window within a string (the leftmost of equals)."""
        h = self.spans.windows(GRAM)
        if len(h) < WINDOW:
            return np.zeros(0, np.int64)
        least = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step < WINDOW:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        at = np.arange(len(least))
        best = (least[self.fits(at, WINDOW + GRAM - 1)] & np.uint64((1 << 24) - 1)).astype(np.int64)
        return best[np.concatenate([[True], best[1:] != best[:-1]])] if len(best) else best

    def all_starts(self) -> np.ndarray:
        """Which bytes start a string of LENGTH bytes."""
        return np.arange(len(self.buf)) + LENGTH <= self.ends


def marked(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True in each of the ranges start..end-1."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, np.clip(start, 0, n), 1)
    np.add.at(steps, np.clip(np.maximum(end, start), 0, n), -1)
    return np.cumsum(steps[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(mask.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)


def groups(texts: list[bytes]):
    """Chunks of whole strings as ``Strings`` with the numbers of their strings.  A chunk stays under 2**24 bytes."""
    for numbers, held in chunks(texts):
        yield numbers, Strings(held)


def widened(raw: bytes, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For consecutive parts of a text, cut before words: its bytes with filler between a word and the white
    space after it where they have fewer than ``least`` bytes, and the place of each byte of the part among them."""
    at = 0
    while at < len(raw):
        fresh = FRESH.search(raw, at + SEGMENT)
        end = fresh.start() if fresh else len(raw)
        buf = np.frombuffer(raw, np.uint8, count=end - at, offset=at)
        gap = IS_GAP[buf]
        first = ~gap
        first[1:] &= gap[:-1]
        first[0] = True
        sizes = np.diff(np.flatnonzero(first), append=len(buf))
        extra = np.maximum(least - sizes, 0)
        place = np.arange(len(buf)) + np.repeat(np.cumsum(extra) - extra, sizes) + np.where(gap, np.repeat(extra, sizes), 0)
        out = np.full(len(buf) + int(extra.sum()), FILLER, np.uint8)
        out[place] = buf
        yield out, place
        at = end


# Length 100 over the whole corpus --------------------------------------------------------------

def _sampled(texts: list[bytes]) -> list[tuple[list[int], np.ndarray, np.ndarray]]:
    out = []
    for numbers, s in groups(texts):
        a = s.anchors()
        a = a[s.fits(a, FIRST)]
        out.append((numbers, a, s.key(a, FIRST)))
    return out


def _possible(s: Strings, unshared: np.ndarray) -> np.ndarray:
    """Starts whose string holds no unshared anchor well inside (each window that selects such an
    anchor lies within the string, and so do the anchor's 100 bytes)."""
    return s.all_starts() & ~marked(len(s.buf), unshared - (LENGTH - FIRST), unshared - (WINDOW - 1) + 1)


def segments(docs: DataFrame, least: int = 0) -> DataFrame:
    """print, start, bytes: the segments of (widened) texts with LENGTH bytes or more, each distinct text once per task."""
    def run(batches):
        seen: set[bytes] = set()
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                raw = (text or "").encode("utf-8", "replace")
                if max(len(raw), (len(raw) + 1) // 2 * least) < LENGTH:
                    continue
                mark = hashlib.sha256(raw).digest()
                if mark in seen:
                    continue
                if least:
                    raw = b"".join(out.tobytes() for out, _ in widened(raw, least))
                if len(raw) < LENGTH:
                    continue
                seen.add(mark)
                for a in range(0, len(raw) - LENGTH + 1, SEGMENT):
                    rows.append((mark, a, raw[a:a + SEGMENT + LENGTH - 1]))
            yield pd.DataFrame(rows, columns=["print", "start", "bytes"])
        give_back()
    return docs.select("text").mapInPandas(run, "print binary, start long, bytes binary")


def _sorted(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.drop_duplicates(["print", "start"]).sort_values(["print", "start"]).reset_index(drop=True)


def _shards(rows: DataFrame, n: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.xxhash64("print", "start"), F.lit(n).cast("long")).cast("int"))


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _lean(run, arguments: int = 1):
    """``run`` on one, two or three arguments (Spark looks at their number), returning what it freed."""
    def done(*given):
        out = run(*given)
        give_back()
        return out
    return {1: lambda a: done(a), 2: lambda a, b: done(a, b), 3: lambda a, b, c: done(a, b, c)}[arguments]


def regions(spark: SparkSession, docs: DataFrame, total_bytes: int, least: int = 0) -> DataFrame:
    """print, start, bytes of the candidate regions: runs of possible starts with the LENGTH - 1 bytes after them."""
    n = max(1, math.ceil(total_bytes / SHARD_BYTES))
    blocks = Blocks(n)
    rows = _shards(segments(docs, least), n)

    def ask(pdf):
        pdf = _sorted(pdf)
        keys = [k for _, _, k in _sampled(pdf["bytes"].tolist())]
        unique, counts = _counted(np.concatenate([np.zeros(0, np.uint64), *keys]))
        # One bit is all that comes back; the answer needs to know 1 from more.
        return pd.DataFrame(blocks.requests(int(pdf["shard"].iloc[0]), 0, unique, np.minimum(counts, 2)), columns=Blocks.REQUEST_COLUMNS)

    def answer(pdf):
        sums, spread = blocks.merge(pdf)
        return pd.DataFrame(spread((sums[0] >= 2).astype(np.int64)), columns=Blocks.REPLY_COLUMNS)

    def place(pdf, replies):
        pdf = _sorted(pdf)
        texts = pdf["bytes"].tolist()
        sampled = _sampled(texts)
        unique = np.unique(np.concatenate([np.zeros(0, np.uint64), *(k for _, _, k in sampled)]))
        shared, _ = blocks.collect(replies, len(unique))
        out = []
        for (numbers, a, keys), (_, s) in zip(sampled, groups(texts)):
            may = _possible(s, a[shared[np.searchsorted(unique, keys)] == 0])
            for lo, hi in zip(*(x.tolist() for x in runs(may))):
                while lo < hi:  # a run goes over neighbouring strings only if each start fits its own
                    k = int(np.searchsorted(s.starts, lo, side="right")) - 1
                    stop = min(hi, int(s.starts[k + 1]))
                    row = numbers[k]
                    out.append((pdf["print"][row], pdf["start"][row] + lo - int(s.starts[k]), s.buf[lo:stop + LENGTH - 1].tobytes()))
                    lo = stop
        return pd.DataFrame(out, columns=["print", "start", "bytes"])
    replies = (rows.groupBy("shard").applyInPandas(_lean(ask), Blocks.REQUEST_SCHEMA)
               .groupBy("reducer").applyInPandas(_lean(answer), Blocks.REPLY_SCHEMA))
    out = rows.groupBy("shard").cogroup(replies.groupBy("shard")).applyInPandas(_lean(place, 2), "print binary, start long, bytes binary")
    return written(out, "repeat-regions")


# Doubling on the regions -----------------------------------------------------------------------

class Rounds:
    """What a shard of regions knows after the replies of some rounds.  Everything is computed from
    the regions' bytes and the replies, so a lost task can be run again."""

    HALVES, WHOLES, GAPS, WANTED, STARTS = range(5)

    def __init__(self, blocks: Blocks, pdf: pd.DataFrame, replies: pd.DataFrame):
        self.blocks, self.pdf, self.replies = blocks, _sorted(pdf), replies
        self.parts = []
        for numbers, s in groups(self.pdf["bytes"].tolist()):
            a = s.anchors()
            self.parts.append([numbers, s, a[s.fits(a, HALF)]])

    def _ranks(self, tag: int, keys: list[np.ndarray]) -> list[np.ndarray]:
        """The ranks of keys (in parts) from the replies of a round; 0 for those that are unique."""
        unique = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]))
        mine = self.replies[self.replies["tag"] == tag].sort_values("reducer")
        values = []
        for r, data in zip(mine["reducer"], mine["first"]):
            v = self.blocks.values(data).astype(np.uint64)
            values.append(np.where(v > 0, v + (np.uint64(r) << np.uint64(32)), np.uint64(0)))
        flat = np.concatenate([np.zeros(0, np.uint64), *values])
        if len(flat) != len(unique):
            raise RuntimeError("replies do not match the keys that were asked for")
        return [flat[np.searchsorted(unique, k)] if len(k) else flat[:0] for k in keys]

    def halves(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Keys by 200 bytes at the anchors, and 200 bytes after those that have 400 bytes."""
        return [(s.key(a, HALF), s.key(a[s.fits(a, LENGTH)] + HALF, HALF)) for _, s, a in self.parts]

    def wholes(self) -> list[tuple]:
        """Ranks by 200 bytes; anchors where both halves of the 400 bytes are shared; keys of their rank pairs."""
        asked = self.halves()
        flat = self._ranks(self.HALVES, [k for pair in asked for k in pair])
        out = []
        for i, (_, s, a) in enumerate(self.parts):
            first, second = flat[2 * i], flat[2 * i + 1]
            at = np.flatnonzero(s.fits(a, LENGTH))
            both = (first[at] > 0) & (second > 0)
            at = at[both]
            out.append((first, at, mix(first[at] * PAIR + mix(second[both]))))
        return out

    def gaps(self) -> list[tuple]:
        """Anchors shared by 400 bytes, and keys of neighbouring ones with their distance."""
        known = self.wholes()
        ranks = self._ranks(self.WHOLES, [k for _, _, k in known])
        out = []
        for (_, s, a), (first, at, _), rank in zip(self.parts, known, ranks):
            at, rank = at[rank > 0], rank[rank > 0]
            near = np.flatnonzero((at[1:] == at[:-1] + 1) & (s.ends[a[at[1:]]] == s.ends[a[at[:-1]]])) if len(at) else at
            left, right = at[near], at[near + 1] if len(near) else at[near]
            key = mix(mix(rank[near] * PAIR + (a[right] - a[left]).astype(np.uint64)) * GAP + (rank[near + 1] if len(near) else rank[near]))
            out.append((first, at, left, key))
        return out

    def starts(self) -> list[tuple]:
        """Per part: possible starts, settled (repeating) starts, the anchor after each start (its
        number), and the ranks by 200 bytes of the anchors."""
        known = self.gaps()
        ranks = self._ranks(self.GAPS, [k for *_, k in known])
        out = []
        for (_, s, a), (first, at, left, _), rank in zip(self.parts, known, ranks):
            n = len(s.buf)
            settled = np.zeros(n, bool)
            settled[a[at]] = True
            left = left[rank > 0]
            if len(left):
                settled |= marked(n, a[left], a[left + 1] + 1)
            alone = a[first == 0]
            may = s.all_starts() & ~marked(n, alone - (LENGTH - HALF), alone - (WINDOW - 1) + 1)
            after = np.searchsorted(a, np.arange(n) + WINDOW - 1)
            may &= after < len(a)
            out.append((may, settled, np.minimum(after, max(len(a) - 1, 0)).astype(np.int32), first))
        return out

    def wanted(self) -> list[tuple]:
        """Per part: the anchors with possible starts before them (numbers), whether unsettled ones are
        among these, and all of ``starts``."""
        out = []
        for state in self.starts():
            may, settled, after, first = state
            some = np.unique(after[may])
            open_ = np.unique(after[may & ~settled])
            out.append((some, np.isin(some, open_), first[some], state))
        return out

    def asked_starts(self) -> list[tuple]:
        """Per part: the starts to be ranked by their 400 bytes, the keys, and the settled starts."""
        known = self.wanted()
        flat = self._ranks(self.WANTED, [mix(r) for _, _, r, _ in known])
        out = []
        for (_, s, a), (some, _, _, state), want in zip(self.parts, known, flat):
            may, settled, after, _ = state
            ask = np.zeros(len(a) + 1, bool)
            ask[some[want > 0]] = True
            at = np.flatnonzero(may & ask[after])
            out.append((at, s.key(at, LENGTH), settled))
        return out

    def request(self, tag: int, shard: int) -> list[tuple]:
        if tag == self.WANTED:
            known = self.wanted()
            keys = np.concatenate([np.zeros(0, np.uint64), *(mix(r) for _, _, r, _ in known)])
            unsettled = np.concatenate([np.zeros(0, bool), *(u for _, u, _, _ in known)])
            unique, code = np.unique(keys, return_inverse=True)
            return self.blocks.requests(shard, tag, unique, np.bincount(code, unsettled, len(unique)).astype(np.int64))
        if tag == self.HALVES:
            keys = [k for pair in self.halves() for k in pair]
        else:
            keys = [x[-1] for x in (self.wholes() if tag == self.WHOLES else self.gaps())] if tag != self.STARTS else \
                [x[1] for x in self.asked_starts()]
        unique, counts = _counted(np.concatenate([np.zeros(0, np.uint64), *keys]))
        return self.blocks.requests(shard, tag, unique, np.minimum(counts, 2))

    def removed(self) -> list[tuple[bytes, int, int]]:
        """(print, start, end) of the bytes to remove, in the text."""
        known = self.asked_starts()
        flat = self._ranks(self.STARTS, [k for _, k, _ in known])
        out = []
        for (numbers, s, _), (at, _, settled), rank in zip(self.parts, known, flat):
            settled[at[rank > 0]] = True
            hit = np.flatnonzero(settled)
            lo, hi = runs(marked(len(s.buf), hit, hit + LENGTH))
            for a, b in zip(lo.tolist(), hi.tolist()):
                while a < b:
                    k = int(np.searchsorted(s.starts, a, side="right")) - 1
                    stop = min(b, int(s.starts[k + 1]))
                    base = int(self.pdf["start"][numbers[k]]) - int(s.starts[k])
                    out.append((self.pdf["print"][numbers[k]], a + base, stop + base))
                    a = stop
        return out


def _round(blocks: Blocks, tag: int):
    """The two functions of a round: what a shard asks, and what a reducer answers."""
    def ask(key, pdf, known):
        out = Rounds(blocks, pdf, known).request(tag, int(key[0])) if len(pdf) else []
        return pd.DataFrame(out, columns=Blocks.REQUEST_COLUMNS)

    def answer(pdf):
        sums, spread = blocks.merge(pdf)
        shared = sums[0] >= (1 if tag == Rounds.WANTED else 2)
        ranked = tag in (Rounds.HALVES, Rounds.WHOLES)  # ranks count the shared keys of a range in order
        return pd.DataFrame(spread(np.where(shared, np.cumsum(shared), 0) if ranked else shared.astype(np.int64)), columns=Blocks.REPLY_COLUMNS)
    return ask, answer


def repeats(spark: SparkSession, found: DataFrame) -> DataFrame:
    """print, start, end: byte ranges of the regions' texts that are to be removed."""
    size = found.agg(F.sum(F.octet_length("bytes").cast("long"))).first()[0] or 0
    n = max(1, math.ceil(2 * size / SHARD_BYTES))
    blocks = Blocks(n)
    rows = _shards(found, n).groupBy("shard")
    replies = spark.createDataFrame([], Blocks.REPLY_SCHEMA)
    for tag in range(5):
        ask, answer = _round(blocks, tag)
        asked = rows.cogroup(replies.groupBy("shard")).applyInPandas(_lean(ask, 3), Blocks.REQUEST_SCHEMA)
        replies = replies.unionByName(written(asked.groupBy("reducer").applyInPandas(_lean(answer), Blocks.REPLY_SCHEMA), "repeat-ranks"))

    def finish(key, pdf, known):
        return pd.DataFrame(Rounds(blocks, pdf, known).removed() if len(pdf) else [], columns=["print", "start", "end"])
    return rows.cogroup(replies.groupBy("shard")).applyInPandas(_lean(finish, 3), "print binary, start long, end long")


def _wide_enough(text: Column, least: int) -> Column:
    """Whether a (widened) text has LENGTH bytes.  Only short texts are cut into words."""
    size = F.octet_length(text)
    if not least:
        return size >= LENGTH
    words = F.regexp_extract_all(text, F.lit(f"[^\\x20\\x09-\\x0D]*{WHITESPACE}|[^\\x20\\x09-\\x0D]+"), F.lit(0))
    wide = F.aggregate(words, F.lit(0), lambda n, w: n + F.greatest(F.lit(least), F.octet_length(w)))
    return F.when(size >= LENGTH, True).when(size * least < LENGTH, False).otherwise(wide >= LENGTH)


def removals(spark: SparkSession, docs: DataFrame, least: int = 0) -> DataFrame:
    """print and ``spans`` (array of start, end in the widened text) of every text that loses bytes; ``docs`` has a
    column text."""
    ship_code(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long")
    prints = docs.select(F.unhex(F.sha2(text.cast("binary"), 256)).alias("print"), size.alias("size"), _wide_enough(text, least).alias("wide"))
    copies = (prints.where("wide").groupBy("print").agg(F.count("*").alias("n"), F.max("size").alias("size"))
              .where("n > 1").select("print", F.lit(0).cast("long").alias("start"), (F.col("size") * max(least, 1)).alias("end")))
    # For the number of shards only: a word takes about half of what it counts for.
    words = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" ")))
    total = docs.agg(F.sum(size + words * F.lit(max(least // 2 - 1, 0)) if least else size)).first()[0] or 0
    spans = repeats(spark, regions(spark, docs, total, least)).unionByName(copies)
    return written(spans.groupBy("print").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")), "repeat-spans")


def with_removals(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the column spans; null where nothing is removed."""
    print_ = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    size = spans.agg(F.sum(F.size("spans") * 16 + 64)).first()[0] or 0
    side = F.broadcast(spans) if size <= BROADCAST_BYTES else spans
    return docs.withColumn("print", print_).join(side, "print", "left").drop("print")


def keep_mask(size: int, spans) -> np.ndarray:
    keep = np.ones(size, bool)
    for r in spans if spans is not None else ():
        keep[r["start"]:r["end"]] = False
    return keep


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    rows = id_text(docs, id_col, text_col)

    def run(batches):
        for pdf in batches:
            out = []
            for text, spans in zip(pdf["text"], pdf["spans"]):
                raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
                keep = keep_mask(len(raw), spans)
                out.append((len(raw), int((~keep).sum()), len(runs(~keep)[0]), hashlib.sha256(raw[keep].tobytes()).hexdigest()))
            out = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out
    marked_rows = with_removals(rows, removals(docs.sparkSession, rows))
    return by_pandas(marked_rows.select("doc_id", "text", "spans"), run, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def kept(raw: bytes, spans, least: int = 0) -> np.ndarray:
    """Which bytes of a text stay."""
    if not least:
        return keep_mask(len(raw), spans)
    parts, at = [], 0
    for out, place in widened(raw, least):
        inside = [{"start": max(r["start"] - at, 0), "end": r["end"] - at} for r in spans if r["start"] < at + len(out) and r["end"] > at]
        parts.append(keep_mask(len(out), inside)[place])
        at += len(out)
    return np.concatenate([np.zeros(0, bool), *parts])


def cleaned(docs: DataFrame, text_col: str = "text", least: int = 0) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text.  A character that lost a byte goes as a whole.
    Each word counts as ``least`` bytes at least."""
    spark = docs.sparkSession
    ship_code(spark)

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, spans):
            if text is None or own is None:
                out.append(text)
                continue
            data = text.encode("utf-8", "replace")
            raw = np.frombuffer(data, np.uint8)
            out.append(raw[whole_characters(raw, kept(data, own, least))].tobytes().decode("utf-8"))
        return pd.Series(out, dtype=object)
    cut.__annotations__ = {"texts": pd.Series, "spans": pd.Series, "return": pd.Series}
    spans = removals(spark, docs.select(docs[text_col].alias("text")), least)
    print_ = F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")).cast("binary"), 256))
    size = spans.agg(F.sum(F.size("spans") * 16 + 64)).first()[0] or 0
    side = spans.select(F.col("print").alias("__print"), F.col("spans").alias("__spans"))
    joined_rows = docs.join(F.broadcast(side) if size <= BROADCAST_BYTES else side, print_ == F.col("__print"), "left")
    once = F.pandas_udf(cut, "string").asNondeterministic()  # as in ``langid.predict``: filters on the text come after it
    return joined_rows.withColumn(text_col, once(F.col(text_col), F.col("__spans"))).select(*docs.columns)


def whole_characters(raw: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Keep a UTF-8 character only if all its bytes are kept."""
    first = (raw & 0xC0) != 0x80
    number = np.cumsum(first) - 1
    lost = np.zeros(int(first.sum()), bool)
    lost[number[~keep]] = True
    return ~lost[number] if len(raw) else keep


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
