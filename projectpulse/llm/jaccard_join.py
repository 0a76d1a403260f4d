"""N-gram Jaccard join with a token-group matrix (operator 8).

Texts are sets of distinct n-word shingles (64-bit hashes; a set is named by a 128-bit hash).  Two
texts link when ``100 * intersection >= threshold * union``.  ``N`` and ``THRESHOLD`` are those of the
query op8; other callers give their own.

1. Documents with equal sets are one class; only distinct sets are compared.
2. Signatures: two linked sets of n and m shingles differ in at most (n + m) * (1 - t) / (1 + t)
   shingles.  Shingles are dealt by hash into one part more than that, so linked sets have an equal
   part.  Classes of set sizes fix the number of parts; a set near the lower end of its class also
   gives the signatures of the class below.  Below 90 percent there are spare parts, so that linked sets
   have several equal parts.  With e empty parts of p, and at most k that can differ, at least p - k - e
   parts with shingles are equal; where that is above 0, empty parts give no signature.  Sets with fewer
   signatures in common with others than they need link to nothing, and the rarest of a set are enough.
3. Sets that signatures connect form a cluster of similar sets.  In a cluster of more than ``GROUP``
   sets all are compared with its leader, the set that shares most signatures; those that link to
   it are one component, within which nothing more needs to be compared.
4. Token-group matrix: clusters are cut into groups of about ``GROUP`` similar sets (a large component
   has groups of its own), and groups of one cluster meet in pairs.  A group's token union bounds the
   overlap of a query from the other group with each of its sets; only groups where the bound allows
   a link are opened for the query.  Then the parity of the tokens in 2,048 buckets bounds the
   difference of two sets from below, and what is left is compared token by token.  A pair of
   groups gives the links of a spanning forest only.

So no link between components is lost; no task holds a whole cluster or component; and what is shuffled is a
set per chunk or pair of groups.  The names of one signature, 16 bytes each, are sorted in one task (``_met``).

Edge cases: a null text, one without words and an empty one have the empty set and are alone.  A
text with fewer than n words has its whole word sequence as its only shingle.  Null ids: the
class of such a row has the least non-null id of its component, or null.  Repeated rows fall into
one class.  A very long text is one set.  An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from projectpulse.llm.bytesops import Words, mix
from projectpulse.llm.common import by_pandas, id_text, ship_code, slices, table, written

N = 3
THRESHOLD = 90  # percent
GROUP = 512
#: Sets that a leader meets in one task.
CHUNK = 512
#: 64-bit words of the parity bitmap of a set.
WORDS = 32
#: A class of set sizes spans this many steps of 1 / threshold.
STEPS = 3
#: Below 90 percent, parts are small and often empty or common; so many more, as a share, are made.
SPARE = 0.4
#: Ids of compared documents go to the scan as a broadcast up to so many rows; beyond, by a shuffle join.
BROADCAST_ROWS = 500_000


def shingle_sets(texts: list[str], n: int = N) -> list[np.ndarray]:
    """The sorted set of shingles of each text."""
    out: list = []
    for numbers, hashes, counts in Words().stream([t.encode("utf-8", "replace") for t in texts]):
        ends = np.cumsum(counts)
        keys = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
        for k in range(n):
            keys = mix(keys) * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(keys)]
        keys = mix(keys)
        for a, b in zip((ends - counts).tolist(), ends.tolist()):
            if b - a >= n:
                out.append(np.unique(keys[a:b - n + 1]))
            elif b > a:  # the whole sequence; its length keeps it apart from shingles
                whole = hashlib.sha256(bytes([b - a]) + hashes[a:b].tobytes()).digest()
                out.append(np.frombuffer(whole[:8], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.sha256(shingles.tobytes()).digest()[:16]


def linked(both: np.ndarray | int, n, m, threshold: int = THRESHOLD):
    """Whether sets of n and m shingles with ``both`` in common link."""
    return 100 * both >= threshold * (n + m - both)


class Classes:
    """Classes of set sizes: class c holds the sizes from ``bounds[c]`` up to ``bounds[c + 1] - 1``.  A
    set of the next class whose partners may lie in c is compared there too."""

    def __init__(self, threshold: int = THRESHOLD, top: int = 1 << 40):
        self.threshold, bounds = threshold, [1]
        while bounds[-1] < top:
            bounds.append(max(bounds[-1] + 1, math.ceil(bounds[-1] * (100 / threshold) ** STEPS)))
        self.bounds = bounds

    def of(self, n: int) -> list[int]:
        """The classes in which a set of n shingles takes part."""
        c = int(np.searchsorted(self.bounds, n, side="right")) - 1
        # The least partner of n has ceil(n * t) shingles.
        least = -(-n * self.threshold // 100)
        return [c, c - 1] if c > 0 and least < self.bounds[c] else [c]

    def parts(self, c: int) -> int:
        """One more than the shingles in which two linked sets of the class can differ: a set of the
        class and one that is at most 1 / t times as large."""
        n = self.bounds[c + 1] - 1
        m = n * 100 // self.threshold
        least = self.apart(n, m) + 1
        return least if self.threshold >= 90 else least + math.ceil(SPARE * least)

    def apart(self, n: int, m: int) -> int:
        """The most shingles in which linked sets of n and m can differ."""
        # n + m - 2 * both, where 100 * both >= t * (n + m - both)
        return (n + m) * (100 - self.threshold) // (100 + self.threshold)

    def equal(self, c: int, n: int) -> int:
        """The least number of equal parts, empty ones too, of a set of n shingles and one it links to in class c."""
        top = self.bounds[c + 1] - 1
        return self.parts(c) - self.apart(n, top if n > top else n * 100 // self.threshold)


def signatures(shingles: np.ndarray, classes: Classes) -> np.ndarray:
    """A hash for each part of the set in each of its classes; empty parts only where no other part need be equal."""
    return signatures_needed(shingles, classes)[0]


def signatures_needed(shingles: np.ndarray, classes: Classes) -> tuple[np.ndarray, int]:
    """The signatures of a set, and how many of them it shares at least with a set it links to."""
    out, need = [], []
    for c in classes.of(len(shingles)):
        parts = classes.parts(c)
        part = (mix(shingles + np.uint64(77)) >> np.uint64(20)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(shingles ^ np.uint64(0x5851F42D4C957F2D))[order])])
        at = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
        inside = sums[at[1:]] - sums[at[:-1]]
        place = np.arange(parts, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(c + 1)
        sigs = mix(mix(inside) + mix(place))
        full, equal = at[1:] > at[:-1], classes.equal(c, len(shingles))
        empty = parts - int(full.sum())
        out.append(sigs[full] if equal > empty else sigs)
        need.append(equal - empty if equal > empty else equal)
    return np.concatenate(out).view(np.int64), min(need)


# Sets of documents -----------------------------------------------------------------------------

def memberships(docs: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_shingles and name of the set of every row of (doc_id, text)."""
    def run(batches):
        for pdf in (part for batch in batches for part in slices(batch, "text")):
            sets = shingle_sets(pdf["text"].fillna("").tolist(), n)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_shingles": [len(s) for s in sets], "name": [set_name(s) for s in sets]})
    return by_pandas(docs, run, "n_shingles long, name binary")


def signature_rows(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """(sig, name, need) of every distinct set of a task, not of every copy."""
    def run(batches):
        classes, seen = Classes(threshold), set()
        for pdf in (part for batch in batches for part in slices(batch, "text")):
            names, sigs, needs = [], [], []
            for s in shingle_sets(pdf["text"].fillna("").tolist(), n):
                name = set_name(s)
                if len(s) and name not in seen:
                    seen.add(name)
                    found, need = signatures_needed(s, classes)
                    sigs.append(found)
                    names += [name] * len(found)
                    needs += [need] * len(found)
            yield pd.DataFrame({"sig": np.concatenate([np.zeros(0, np.int64), *sigs]), "name": names, "need": np.array(needs, np.int32)})
    return docs.select("text").mapInPandas(run, "sig long, name binary, need int")


def shared_signatures(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """(sig, name, first, size) of the signatures that at least two distinct sets have, of sets that have as many of
    them as they need: ``first`` is the least name of the signature, ``size`` the number of its sets.  Of the k such
    signatures of a set that needs r, the k - r + 1 rarest are enough: of the r or more that linked sets share, the
    rarest has r - 1 others after it in both, so it is among these.  Common signatures would connect far too much."""
    rows = _met(signature_rows(docs, n, threshold)).select("sig", "name", "need", "size").dropDuplicates(["sig", "name"])
    rows = written(rows, "join-shared")
    own = W.partitionBy("name")
    rarest = rows.withColumns({"k": F.count("*").over(own), "place": F.row_number().over(own.orderBy("size", "sig"))}).where("place <= k - need + 1")
    return _met(rarest.select("sig", "name")).select("sig", "name", "first", "size")


def _met(rows: DataFrame) -> DataFrame:
    """The rows (sig, name, ...) of signatures with two names at least, with the least name and the rows of each."""
    every = W.partitionBy("sig")
    return rows.withColumns({"first": F.min("name").over(every), "z": F.max("name").over(every),
                             "size": F.count("*").over(every)}).where("first <> z")


def small(rows: DataFrame) -> DataFrame:
    """Narrow rows as a broadcast if there are at most ``BROADCAST_ROWS``; beyond, they meet the sets by a shuffle join."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def sets_of(docs: DataFrame, members: DataFrame, names: DataFrame, n: int = N) -> DataFrame:
    """(name, shingles) of the named sets, read from the document with the least id of each.  Where that id
    repeats there are more rows, which do no harm."""
    ids = members.join(names, "name", "left_semi").groupBy("name").agg(F.min("doc_id").alias("doc_id"))
    ids = written(ids.select(F.col("doc_id").alias("__id")).distinct(), "join-ids")
    chosen = docs.join(small(ids), docs["doc_id"].eqNullSafe(F.col("__id")), "left_semi")

    def run(batches):
        for pdf in (part for batch in batches for part in slices(batch, "text")):
            sets = shingle_sets(pdf["text"].fillna("").tolist(), n)
            yield pd.DataFrame({"name": [set_name(s) for s in sets], "shingles": [s.tobytes() for s in sets]})
    return chosen.select("text").mapInPandas(run, "name binary, shingles binary")


# Comparing -------------------------------------------------------------------------------------

def _array(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _fresh(*names: str) -> list:
    """Columns under new identities, so that both sides of a cogroup may come from one table."""
    return [F.col(n).alias(n) for n in names]


def overlaps(query: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of a sorted set with each of some sorted sets."""
    flat = np.concatenate(sets)
    at = np.searchsorted(query, flat)
    hit = query[np.minimum(at, len(query) - 1)] == flat
    ends = np.cumsum([len(s) for s in sets])
    sums = np.concatenate([[0], np.cumsum(hit)])
    return sums[ends] - sums[ends - np.array([len(s) for s in sets])]


def links_to_leaders(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Of the pairs (name, leader) those that link, as (a, b).  A leader's queries are dealt into chunks by their
    number, and the leader's set goes to each chunk."""
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = (pairs.join(sizes, "leader")
             .withColumn("chunk", F.pmod(F.xxhash64("name"), F.col("chunks").cast("long")).cast("int")))
    dealt = written(dealt.select("leader", "chunk", "name"), "join-dealt")
    queries = sets.join(small(dealt), "name").select("leader", "chunk", "name", "shingles")
    slots = dealt.select("leader", "chunk").distinct()
    leaders = (sets.withColumnRenamed("name", "leader").join(small(slots), "leader")
               .select(*_fresh("leader", "chunk", "shingles")).dropDuplicates(["leader", "chunk"]))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            query = _array(right["shingles"].iloc[0])
            held = [_array(s) for s in left["shingles"]]
            sizes = np.array([len(s) for s in held])
            ok = linked(overlaps(query, held), sizes, len(query), threshold)
            out = [(n, m) for n, m, yes in zip(left["name"], left["leader"], ok) if yes]
        return pd.DataFrame(out, columns=["a", "b"])
    return queries.groupBy("leader", "chunk").cogroup(leaders.groupBy("leader", "chunk")).applyInPandas(compare, "a binary, b binary")


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, the parity of its tokens in each bucket, as bits.  Two sets differ in at least as many
    tokens as their bitmaps differ in bits."""
    flat = mix(np.concatenate(sets))
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.zeros((len(sets), WORDS), np.uint64)
    np.bitwise_xor.at(out, (row, (flat >> np.uint64(6)) % np.uint64(WORDS)), np.uint64(1) << (flat & np.uint64(63)))
    return out


def forest(names: list[bytes], links: list[tuple[int, int]]) -> list[tuple[bytes, bytes]]:
    """Of links between numbered sets as many as are needed to connect the same sets."""
    up = list(range(len(names)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    out = []
    for i, j in links:
        a, b = top(i), top(j)
        if a != b:
            up[a] = b
            out.append((names[i], names[j]))
    return out


def group_links(left: list[np.ndarray], right: list[np.ndarray], threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Linked pairs (number in ``left``, number in ``right``) of two groups of sorted sets."""
    union = np.unique(np.concatenate(right))
    n, m = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    flat = np.concatenate(left)
    at = np.minimum(np.searchsorted(union, flat), len(union) - 1)
    bound = np.add.reduceat((union[at] == flat).astype(np.int64), np.cumsum(n) - n)
    # An intersection of at most ``bound`` links at best with a set of that many tokens.
    opened = np.flatnonzero(linked(bound, n, np.maximum(bound, 1), threshold))
    if not len(opened):
        return []
    a, b = parities([left[i] for i in opened]), parities(right)
    out = []
    for k, i in enumerate(opened):
        apart = np.bitwise_count(a[k] ^ b).sum(axis=1)
        least = (n[i] + m) - np.maximum(apart, np.abs(n[i] - m))  # twice the greatest intersection that is left
        near = np.flatnonzero(linked(least // 2, n[i], m, threshold))
        if len(near):
            ok = linked(overlaps(left[i], [right[j] for j in near]), n[i], m[near], threshold)
            out += [(int(i), int(j)) for j in near[ok]]
    return out


def links_between_groups(groups: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links of the sets in ``groups`` (cluster, component, group, name), where ``component`` is null for groups of
    several components.  Every two groups of a cluster meet, except two of one component."""
    slots = groups.select("cluster", "component", "group").distinct()
    other = slots.select("cluster", F.col("component").alias("its"), F.col("group").alias("next"))
    pairs = (slots.join(other, "cluster").where("group <= next")
             .where(~F.coalesce(F.col("component") == F.col("its"), F.lit(False)))
             .select("cluster", "group", "next", F.xxhash64("cluster", "group", "next").alias("pair")))
    # The narrow rows are joined first; then each set goes to its pairs of groups in one shuffle.
    one = groups.join(pairs, ["cluster", "group"]).select("name", "pair", "group", "next", F.lit(True).alias("asks"))
    # A group that meets itself is sent once.
    two = (groups.withColumnRenamed("group", "next").join(pairs.where("group < next"), ["cluster", "next"])
           .select("name", "pair", "group", "next", F.lit(False).alias("asks")))
    met = written(one.unionByName(two), "join-met")
    rows = sets.join(small(met), "name").select("pair", "group", "next", "asks", "name", "shingles")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (first, second), both in pdf.groupby(["group", "next"]):
            own = both[both["asks"]]
            met = own if first == second else both[~both["asks"]]
            if len(own) and len(met):
                held, others = ([_array(s) for s in x["shingles"]] for x in (own, met))
                names = own["name"].tolist() + ([] if first == second else met["name"].tolist())
                shift = 0 if first == second else len(own)
                out += forest(names, [(i, j + shift) for i, j in group_links(held, others, threshold) if i != j + shift])
        return pd.DataFrame(out, columns=["a", "b"])
    return rows.groupBy("pair").applyInPandas(compare, "a binary, b binary")


def _moved(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges (a, b) between the roots of their ends, without loops and repeats."""
    at = lambda end: roots.select(F.col("name").alias(end), F.col("root").alias(f"root_{end}"))
    one = edges.join(at("a"), "a").select(F.col("root_a").alias("a"), "b").distinct()
    two = one.join(at("b"), "b").select("a", F.col("root_b").alias("b")).where("a <> b")
    return two.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(name, component) of every name in ``links`` (a, b); a component is named by one of its names.  In each
    round every name hooks to its least neighbour, and the graph of the roots goes on: it shrinks quickly."""
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "join-links")
    labels = written(edges.select(F.col("a").alias("name")).union(edges.select("b")).distinct().withColumn("component", F.col("name")), "join-labels")
    for _ in range(max_rounds):
        if edges.isEmpty():
            return labels
        near = edges.select(F.col("a").alias("name"), F.col("b").alias("root")).union(edges.select("b", "a"))
        hooks = near.groupBy("name").agg(F.min("root").alias("root")).select("name", F.least("name", "root").alias("root"))
        hooks = written(hooks, "join-hooks")
        above = hooks.select(F.col("name").alias("root"), F.col("root").alias("over"))
        roots = written(hooks.join(above, "root").select("name", F.col("over").alias("root")), "join-roots")
        moved = roots.select(F.col("name").alias("component"), "root")
        labels = written(labels.join(moved, "component", "left").select("name", F.coalesce("root", "component").alias("component")), "join-labels")
        edges = written(_moved(edges, roots), "join-links")
    raise RuntimeError("components did not settle")


def clusters_of(shared: DataFrame, names: DataFrame) -> DataFrame:
    """(name, cluster): the sets that signatures connect.  Every name first hooks to the least name of its
    signatures (``names``: name, root), so that only edges between these roots are left."""
    roots = names.select("name", "root")
    found = components(_moved(shared.select(F.col("name").alias("a"), F.col("first").alias("b")), roots))
    return roots.join(found.select(F.col("name").alias("root"), "component"), "root", "left").select(
        "name", F.coalesce("component", "root").alias("cluster"))


def join(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, by shingles of ``n`` words and a Jaccard likeness of
    at least ``threshold`` percent."""
    ship_code(spark)
    rows = id_text(docs, id_col, text_col)
    members = written(memberships(rows, n), "join-members")
    shared = written(shared_signatures(rows, n, threshold), "join-signatures")
    names = written(shared.groupBy("name").agg(F.sum("size").alias("weight"), F.min("first").alias("root")), "join-names")
    sets = written(sets_of(rows, members, names.select("name"), n), "join-sets")
    clusters = written(clusters_of(shared, names), "join-clusters")
    sizes = (clusters.join(names, "name").groupBy("cluster")
             .agg(F.count("*").alias("size"), F.max_by("name", F.struct("weight", "name")).alias("leader")))
    clusters = written(clusters.join(sizes, "cluster"), "join-sizes")
    to_leaders = clusters.where((F.col("size") > GROUP) & (F.col("name") != F.col("leader"))).select("name", "leader")
    near = written(links_to_leaders(to_leaders, sets, threshold), "join-near")

    # Large components have groups of their own; all others of a cluster share groups.
    label = (clusters.join(near.select(F.col("a").alias("name"), F.col("b").alias("component")), "name", "left")
             .withColumn("component", F.coalesce("component", F.when(F.col("name") == F.col("leader"), F.col("leader")))))
    large = label.groupBy("cluster", "component").agg(F.count("*").alias("part")).where(F.col("component").isNotNull() & (F.col("part") >= GROUP))
    label = label.join(large, ["cluster", "component"], "left").withColumn("component", F.when(F.col("part").isNotNull(), F.col("component")))
    rest = label.groupBy("cluster").agg(F.count_if(F.col("part").isNull()).alias("rest"))
    cut = F.ceil(F.coalesce(F.col("part"), F.col("rest")) / GROUP)
    groups = label.join(rest, "cluster").select(
        "cluster", "component", "name",
        F.xxhash64("component", F.pmod(F.xxhash64("name"), cut.cast("long"))).alias("group"))
    links = near.unionByName(written(links_between_groups(written(groups, "join-groups"), sets, threshold), "join-found"))
    final = components(links)

    named = members.join(final, "name", "left").withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "name")))
    named = written(named, "join-named")
    least = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return named.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each group stays: the one with the least id.  Rows that repeat an id are one
    document here: they stay if any of them is the least of its group."""
    groups = join(spark, docs, id_col, text_col, n, threshold)
    gone = (groups.groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("least"))
            .where("not least").select(F.col("doc_id").alias("__gone")))
    few = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if few else gone, docs[id_col].eqNullSafe(F.col("__gone")), "left_anti")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(spark, table(spark, sf_dir, "documents"), n=N, threshold=THRESHOLD)


OP8_SQL = None
