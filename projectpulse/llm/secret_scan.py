"""Secret scans by one combined automaton (operator 11).

All rules are compiled into one deterministic automaton (``automaton``), which reads every byte of every
whole text once.  ``RULES`` holds the three base kinds and some further ones for keys of well-known form.

Edge cases: a null text is empty and has no spans.  Rows with null or repeated ids are scanned each for
itself; ids are passed on as they are, whatever their type.  Matches of different kinds may overlap.  An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from projectpulse.llm.automaton import Automaton, Rule
from projectpulse.llm.common import id_text, ship_code, table

# The base kinds.  A run of hex digits has 24 of them exactly if [0-9a-f]{24,} matches it.
BASE = (
    Rule("assign", rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6, tail=True),
    Rule("access", rb"AKIA[A-Z0-9]+", 20),
    Rule("hex", rb"[0-9a-f]{24,}", 24),
)
# Public forms of keys.
MORE = (
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", rb"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", rb"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 30),
    Rule("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
#: Texts are scanned in chunks of about this many bytes; a longer text is a chunk of its own.
CHUNK = 4 << 20


@cache
def automaton(rules: tuple[Rule, ...]) -> Automaton:
    return Automaton(rules)


def find(texts: pa.Array, machine: Automaton) -> list[tuple[int, str, int, int]]:
    """(number of the text, kind, start, end) of every span, sorted by text, start and rule; in code points."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out, a = [], 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK, side="right")) - 1)
        buf = data[offsets[a]:offsets[b]]
        starts = offsets[a:b] - offsets[a]
        # Of texts that begin at one place all but the last are empty, and the search finds the last.
        found = sorted((t, s, r, e) for t, r, s, e in machine.matches(buf, starts))
        of, points = -1, None
        for t, s, r, e in found:
            if t != of:
                end = int(starts[t + 1]) if t + 1 < len(starts) else len(buf)
                points = np.concatenate([[0], np.cumsum((buf[starts[t]:end] & 0xC0) != 0x80)])
                of = t
            out.append((a + t, machine.rules[r].kind, int(points[s]), int(points[e])))
        a = b
    return out


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``found``, an array of (kind, start, end) sorted by start and then in the order of the rules, of
    every row."""
    ship_code(docs.sparkSession)
    machine = automaton(tuple(rules))  # compiled once; Spark hands it to the tasks

    def run(batches):
        for batch in batches:
            spans = find(batch.column("text"), machine)
            per_row = np.bincount([t for t, *_ in spans], minlength=batch.num_rows).astype(np.int64)
            parts = pa.StructArray.from_arrays(
                [pa.array([k for _, k, _, _ in spans], pa.string()), pa.array([s for *_, s, _ in spans], pa.int64()),
                 pa.array([e for *_, e in spans], pa.int64())], names=["kind", "start", "end"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32()), parts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "found"])
    kind = docs.schema[id_col].dataType.simpleString()
    return id_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, found array<struct<kind:string,start:long,end:long>>")


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.kind for r in BASE]

    def of(*kinds: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*kinds))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(as_text(of(*base)).cast("binary"), 256).alias("base_sha256"), as_text(F.col("found")).alias("spans"))


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _sql() -> str:
    """The same spans from regular expressions: pieces between matches and matches in turn give the places."""
    words = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
    patterns = {r.kind: r.regex.decode() for r in RULES} | {
        "hex": "[0-9a-f]+", "assign": f"""({words})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""}
    parts = []
    for k, r in enumerate(RULES):
        p = patterns[r.kind].replace("'", "''")
        size = f"regexp_extract_all(t, '{p}', {2 if r.tail else 0})"
        parts.append(f"SELECT nr, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, unnest(regexp_extract_all(t, '{p}')) AS w, "
                     f"unnest({size}) AS part, unnest(string_split_regex(t, '{p}')) AS gap, "
                     f"generate_subscripts(string_split_regex(t, '{p}'), 1) AS i FROM d")
    return f"""
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT nr, k, kind, least, w, part, sum(length(gap) + length(w)) OVER (PARTITION BY nr, k ORDER BY i) AS stop
           FROM m WHERE w IS NOT NULL),
s AS (SELECT nr, k, stop - length(w) AS start, kind || ':' || CAST(stop - length(w) AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span
      FROM placed WHERE length(part) >= least),
g AS (SELECT nr, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             string_agg(span, ',' ORDER BY start, k) FILTER (k < 3) AS own, string_agg(span, ',' ORDER BY start, k) AS spans FROM s GROUP BY nr)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.nr = g.nr
"""


OP11_SQL = _sql()
