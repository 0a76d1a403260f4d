"""Prefix tries over conversations (operator 12): which turns conversations share from their start.

1. A turn becomes a digest of its role and text and the number of its words; a conversation becomes the
   path of its turns' digests.  Texts do not leave their scan.
2. Conversations with equal paths are one row with their number and least id, so a conversation that is
   in a third of all rows is one path.  The hash of all ids that end there is taken over blocks of ids in
   order, of which each holds the ids of one range; a task only ever holds one block.
3. Paths are dealt into range shards, so that shared prefixes lie next to each other.  A shard encodes its
   turns by a dictionary of its own (ids in the order of the digests) and puts its paths into a ternary
   search tree, the median first, then the medians of the halves, which keeps the tree balanced.  One
   walk over the nodes, children before parents, adds up members, leaves and savings.
4. A node can only be in several shards if it lies on the first or the last path of a shard.  These
   boundary nodes, at most two paths of a shard, are merged by the digest of their prefix, and sums over
   their subtrees come from pointer doubling along their parents: as many rounds as the depth has bits.

Edge cases: rows without a conv_id belong to no conversation and are left out.  A null turn comes first; turns with
equal numbers, also repeated rows, are turns of their own, in the order of the digest of role and text.  A null
role or text is empty.  A conversation may have no turns left after rebuilding; it ends at the root.
An empty table gives an empty result; extra columns are ignored.  A conversation's path, 16 bytes and a word
count for each turn, is one row.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from projectpulse.llm.common import ship_code, table, text_or_empty, written
from projectpulse.operators.joins import checked_broadcast

#: Bytes of a turn's digest.
TURN = 16
#: The ids of one block lie in a range of 2 ** BLOCK_BITS.
BLOCK_BITS = 14
SHARD_TURNS = 100_000
#: A conversation takes its first turns from the one before it whose id is divisible by FAMILY, at most HEAD - 1 of them.
FAMILY, HEAD = 20, 4
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns(convs: DataFrame) -> DataFrame:
    """conv_id, turn, digest (hex) and words of every turn."""
    role, text = text_or_empty(convs["role"]), text_or_empty(convs["text"])
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return convs.where(convs["conv_id"].isNotNull()).select(
        convs["conv_id"].cast("long").alias("conv_id"), convs["turn"].alias("turn"),
        F.substring(F.sha2(told.cast("binary"), 256), 1, 2 * TURN).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def as_path(said: Column) -> Column:
    return F.unhex(F.array_join(F.transform(said, lambda x: x["digest"]), ""))


def sequences(convs: DataFrame) -> DataFrame:
    """conv_id, path and words of every conversation as it is."""
    said = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    return turns(convs).groupBy("conv_id").agg(said.alias("said")).select(
        "conv_id", as_path(F.col("said")).alias("path"), F.transform("said", lambda x: x["words"]).alias("words"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """conv_id, path and words of every conversation, its first turns replaced by those of its family's head.
    A family is at most ``FAMILY`` conversations; one shuffle by family serves the turns and the heads."""
    family = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")
    said = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    own = turns(convs).select("*", family).repartition("family").groupBy("family", "conv_id").agg(said.alias("said"))
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("said", 1, HEAD - 1))).over(W.partitionBy("family"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEAD).cast("long")).cast("int")
    taken = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("said", 1, 0))
    rest = F.slice("said", F.col("h") + 1, F.greatest(F.size("said") - F.col("h"), F.lit(0)))
    both = F.concat(taken, rest)
    return own.select("conv_id", "said", head.alias("head"), h.alias("h")).select("conv_id", both.alias("both")).select(
        "conv_id", as_path(F.col("both")).alias("path"), F.transform("both", lambda x: x["words"]).alias("words"))


def paths(rows: DataFrame) -> DataFrame:
    """path, words, n, least and ends_sha256 of every distinct path."""
    blocks = rows.groupBy("path", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = ends = None
        done: list[tuple] = []

        def close():
            done.append((path, words, n, least, ends.hexdigest()))
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path or ends is None:
                    if ends is not None:
                        close()
                    path, words, n, least, ends = row["path"], row["words"], row["n"], row["least"], hashlib.sha256(row["ids"].encode())
                else:
                    n, least = n + row["n"], min(least, row["least"])
                    ends.update(b"," + row["ids"].encode())
            yield _batch(done, PATHS)
            done.clear()
        if ends is not None:
            close()
            yield _batch(done, PATHS)
    ordered = blocks.repartition("path").sortWithinPartitions("path", "block")
    return ordered.select("path", "words", "n", "least", "ids").mapInArrow(
        run, "path binary, words array<long>, n long, least long, ends_sha256 string")


PATHS = pa.schema([("path", pa.binary()), ("words", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64()), ("ends_sha256", pa.string())])
NODES = pa.schema([("boundary", pa.bool_()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                   ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("parent_conv_id", pa.int64()),
                   ("node_key", pa.binary()), ("parent_key", pa.binary()), ("words", pa.int64())])
NODE_SCHEMA = ("boundary boolean, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
               "parent_conv_id long, node_key binary, parent_key binary, words long")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class TernaryTrie:
    """A ternary search tree of sequences of numbers.  Node 0 is the root; the children of a node are the
    search tree below its ``equal`` link, ordered by ``low`` and ``high``; ``up`` is the parent."""

    def __init__(self):
        self.key, self.low, self.high, self.equal, self.up, self.depth = [-1], [0], [0], [0], [-1], [0]
        self.members, self.least, self.words, self.ends = [0], [None], [0], [None]

    def _new(self, key: int, up: int, words: int) -> int:
        for column, value in ((self.key, key), (self.low, 0), (self.high, 0), (self.equal, 0), (self.up, up), (self.depth, self.depth[up] + 1),
                              (self.members, 0), (self.least, None), (self.words, words), (self.ends, None)):
            column.append(value)
        return len(self.key) - 1

    def _child(self, at: int, key: int, words: int) -> int:
        k = self.equal[at]
        if not k:
            self.equal[at] = k = self._new(key, at, words)
        while self.key[k] != key:
            side = self.low if key < self.key[k] else self.high
            if not side[k]:
                new = self._new(key, at, words)
                side[k] = new
            k = side[k]
        return k

    def insert(self, keys: list[int], words: list[int], members: int, least: int, ends: str) -> list[int]:
        """Add members of a sequence; returns its nodes from the root on."""
        nodes = [0]
        for key, w in zip(keys, words):
            nodes.append(self._child(nodes[-1], key, w))
        for k in nodes:
            self.members[k] += members
            if self.least[k] is None or least < self.least[k]:
                self.least[k] = least
        self.ends[nodes[-1]] = ends
        return nodes


def medians(n: int) -> Iterator[int]:
    """0 to n - 1: the middle, then the middles of both halves, and so on."""
    parts = [(0, n)]
    for a, b in parts:  # grows while it is walked over
        if a < b:
            mid = (a + b) // 2
            yield mid
            parts += [(a, mid), (mid + 1, b)]


def shard_nodes(rows: list[tuple]) -> Iterator[tuple]:
    """The nodes of a shard's paths (path, words, n, least, ends_sha256) as rows of ``NODES``.  Those of boundary
    nodes hold what this shard has of them, without their boundary children."""
    rows = sorted(rows, key=lambda r: r[0])
    cut = [[p[i:i + TURN] for i in range(0, len(p), TURN)] for p, *_ in rows]
    dictionary = sorted({t for c in cut for t in c})
    trie, edge = TernaryTrie(), {}
    for i in medians(len(rows)):
        nodes = trie.insert([bisect_left(dictionary, t) for t in cut[i]], *rows[i][1:])
        if i in (0, len(rows) - 1):
            prefix = hashlib.sha256()
            edge[0] = prefix.digest()
            for k, t in zip(nodes[1:], cut[i]):
                prefix.update(t)
                edge[k] = prefix.copy().digest()
    size = len(trie.key)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for k in range(size - 1, -1, -1):  # nodes are numbered after their parents
        if k in edge:
            continue
        leaves[k] = leaves[k] or 1
        saved[k] += (trie.members[k] - 1) * trie.words[k]
        up = trie.up[k]
        children[up] += 1
        leaves[up] += leaves[k]
        saved[up] += saved[k]
    for k in range(size):
        up = trie.up[k]
        inside = up >= 0 and up not in edge
        yield (k in edge, trie.depth[k], trie.least[k], trie.members[k], children[k], leaves[k], saved[k], trie.ends[k],
               trie.least[up] if inside else None, edge.get(k), edge.get(up), trie.words[k])


def shard_tries(distinct: DataFrame) -> DataFrame:
    """Rows of ``NODES`` from distinct paths (a written table), one trie for each range shard."""
    ship_code(distinct.sparkSession)
    total = distinct.agg(F.sum(F.octet_length("path").cast("long") / TURN + 1)).first()[0] or 0

    def run(batches):
        rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
        if rows:
            held = []
            for node in shard_nodes(rows):
                held.append(node)
                if len(held) == 10_000:
                    yield _batch(held, NODES)
                    held = []
            yield _batch(held, NODES)
    shards = max(1, math.ceil(total / SHARD_TURNS))
    return distinct.repartitionByRange(shards, "path").select("path", "words", "n", "least", "ends_sha256").mapInArrow(run, NODE_SCHEMA)


def merged_boundary(nodes: DataFrame) -> DataFrame:
    """One row for each boundary node of all shards (a written table), with the sums over its subtree."""
    parts = nodes.where("boundary").groupBy("node_key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.max("ends_sha256").alias("ends_sha256"), F.max("words").alias("words"))
    parts = written(parts, "trie-parts")
    below = parts.groupBy(F.col("parent_key").alias("node_key")).agg(F.count("*").alias("outer"))
    n_children = F.col("inner") + F.coalesce("outer", F.lit(0))
    own = written(parts.join(below, "node_key", "left").withColumn("n_children", n_children).select(
        "node_key", "parent_key", "depth", "conv_id", "n_convs", "n_children", "ends_sha256",
        (F.col("leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-own")
    sums = own.select("node_key", F.col("parent_key").alias("up"), "leaves", "saved")
    deepest = own.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):
        # Sums so far reach fewer than 2^k levels down; ``up`` is 2^k levels up.
        above = sums.where("up is not null").groupBy(F.col("up").alias("node_key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        hop = checked_broadcast(sums.select(F.col("node_key").alias("up"), F.col("up").alias("next")))
        sums = written(sums.join(above, "node_key", "left").join(hop, "up", "left").select(
            "node_key", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "trie-sums")
    return written(own.drop("leaves", "saved").join(sums.select("node_key", "leaves", "saved"), "node_key").select(
        "depth", "conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
        "node_key", "parent_key"), "trie-boundary")


def prefix_nodes(rows: DataFrame) -> DataFrame:
    """Every node of the trie of conversations (conv_id, path, words): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    nodes = written(shard_tries(written(paths(rows), "trie-paths")), "trie-nodes")
    boundary = merged_boundary(nodes)
    columns = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = nodes.where("not boundary")
    open_ = inner.where("parent_key is not null").select(*columns, "parent_key").unionByName(boundary.select(*columns, "parent_key"))
    parents = checked_broadcast(boundary.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")))
    out = open_.join(parents, "parent_key", "left").select(*columns, "parent_conv_id").unionByName(
        inner.where("parent_key is null").select(*columns, "parent_conv_id"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(rebuilt(table(spark, sf_dir, "conversations")))


OP12_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
ids AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 4 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL), tab),
own AS (
  SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS p
  FROM (SELECT conv_id, turn, left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS digest,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL)),
parts AS (
  SELECT i.conv_id, 0 AS part, p, digest, words FROM ids i JOIN own o ON o.conv_id = i.conv_id - i.conv_id % 20 AND p <= h
  UNION ALL SELECT i.conv_id, 1, p, digest, words FROM ids i JOIN own o ON o.conv_id = i.conv_id AND p > h),
seq AS (
  SELECT i.conv_id, coalesce(list(digest ORDER BY part, p) FILTER (digest IS NOT NULL), []) AS path,
         coalesce(list(words ORDER BY part, p) FILTER (digest IS NOT NULL), []) AS words
  FROM ids i LEFT JOIN parts USING (conv_id) GROUP BY i.conv_id),
steps AS (SELECT conv_id, path, words, unnest(range(len(path) + 1)) AS depth FROM seq),
nodes AS (
  SELECT path[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(words[depth]), 0) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM steps GROUP BY 1, 2),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.prefix = k.prefix),
sums AS (
  SELECT prefix[1:a] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS a FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON n.prefix = s.prefix
LEFT JOIN full_nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""
