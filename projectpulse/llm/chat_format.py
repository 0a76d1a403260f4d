"""Chat formatting by prefix-target expansion (operator 7, DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it are the context, and its
reply alone lies under the loss mask.  Turns after the last reply go into one more example without
a mask, so that no turn is lost.

A turn is written ``open role mid text close``.  Control strings inside roles and texts are
escaped: a backslash goes after their first character, and backslashes are doubled.  To undo this,
each backslash is dropped and the character after it stays.

Edge cases: a null text or role is empty.  Turns sort by (turn, role, text), nulls first; repeated
rows are turns of their own.  A null conv_id is a conversation too.  A conversation without an
assistant turn gives one example without a mask.  An empty table gives an empty result, and extra
columns are ignored.  A conversation is one row while it is formatted, because each example holds
its whole prefix; conversations are spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from projectpulse.llm.common import table, text_or_empty


@dataclass(frozen=True)
class Template:
    """Markers around a turn, and the control strings that its role and text must not contain."""

    open: str = "<s>[INST] "
    mid: str = " [/INST] "
    close: str = " </s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")


DEFAULT = Template()


def _quoted(s: str) -> str:
    return r"\Q" + s + r"\E"


def escape(text: Column, t: Template = DEFAULT) -> Column:
    inside = "|".join(f"(?<={_quoted(c[0])})(?={_quoted(c[1:])})" for c in t.controls)
    return F.regexp_replace(text, rf"\\|{inside}", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def conversations(turns: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """conv_id and ``said``: its turns in order as (turn, role, text), already escaped."""
    row = F.struct("turn", text_or_empty(F.col("role")).alias("role"), text_or_empty(F.col("text")).alias("text"))
    return (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("said"))
            .select("conv_id", F.transform("said", lambda x: F.struct(
                x["turn"].alias("turn"), x["role"].alias("plain"), escape(x["role"], t).alias("role"),
                escape(x["text"], t).alias("text"))).alias("said")))


def examples(turns: DataFrame, t: Template = DEFAULT, target_role: str = "assistant") -> DataFrame:
    """One row per example: conv_id, example (number of turns in it), text, loss_start and loss_length
    (code points; a length of null means that nothing is trained)."""
    def shown(x: Column) -> Column:
        return F.concat(F.lit(t.open), x["role"], F.lit(t.mid), x["text"], F.lit(t.close))

    at = F.filter(F.sequence(F.lit(1), F.size("said")), lambda i: F.element_at("said", i)["plain"] == target_role)
    ends = F.when(F.array_contains("at", F.size("said")), F.col("at")).otherwise(F.concat("at", F.array(F.size("said"))))
    rows = (conversations(turns, t).withColumn("at", at)
            .select("conv_id", "said", F.transform("said", shown).alias("parts"), F.explode(ends).alias("example")))
    last = F.element_at("said", F.col("example"))
    before = F.concat(F.array_join(F.slice("parts", F.lit(1), F.col("example") - 1), ""),
                      F.lit(t.open), last["role"], F.lit(t.mid))
    trained = last["plain"] == target_role
    return rows.select("conv_id", "example", before.alias("before"), last["text"].alias("reply"), trained.alias("trained")).select(
        "conv_id", "example", F.concat("before", "reply", F.lit(t.close)).alias("text"),
        F.when(F.col("trained"), F.length("before")).alias("loss_start"),
        F.when(F.col("trained"), F.length("reply")).alias("loss_length"))


def read_turns(text: Column, t: Template = DEFAULT) -> Column:
    """The turns of a formatted text as an array of (role, text), unescaped."""
    parts = F.filter(F.split(text, _quoted(t.close)), lambda p: p.startswith(t.open))

    def one(p: Column) -> Column:
        head = F.substring_index(p, t.mid, 1)
        return F.struct(unescape(F.substr(head, F.lit(len(t.open) + 1))).alias("role"),
                        unescape(F.substr(p, F.length(head) + F.lit(len(t.mid) + 1))).alias("text"))
    return F.transform(parts, one)


def masked(text: Column, start: Column, length: Column) -> Column:
    """What the loss mask covers, unescaped; empty without a mask."""
    return F.coalesce(unescape(F.substr(text, start + 1, length)), F.lit(""))


def read_back(formatted: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """Per conversation, from its formatted examples alone: the turns and all trained text."""
    whole = F.max_by("text", "example")
    replies = F.sort_array(F.collect_list(F.struct("example", masked(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("reply"))))
    return (formatted.groupBy("conv_id")
            .agg(whole.alias("whole"), replies.alias("replies"), F.sum(F.length("text").cast("long")).alias("formatted_chars"))
            .select("conv_id", read_turns(F.col("whole"), t).alias("turns"),
                    F.array_join(F.transform("replies", lambda r: r["reply"]), "").alias("trained"), "formatted_chars"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L conv_id, 0L turn, 'user' role, '{said}' text UNION ALL SELECT -7L, 1L, 'assistant', '{said}'")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    line = lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))
    return read_back(examples(turns)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nr,
         count(*) OVER (PARTITION BY conv_id) AS n,
         24 + length(role) + length(text)
            + (length(role || text) - length(replace(role || text, '\', '')))
            + (SELECT sum((length(x) - length(replace(x, c, ''))) / length(c))
               FROM (VALUES ('<s>'), ('</s>'), ('[INST]'), ('[/INST]')) AS v(c), (SELECT role || chr(0) || text AS x)) AS chars
  FROM turns),
added AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY nr) AS prefix FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nr) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (role = 'assistant' OR nr = n) AS BIGINT) AS formatted_chars
FROM added GROUP BY conv_id
"""
