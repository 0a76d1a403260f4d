"""Exact deduplication with stateful streaming (operator 6, DataFrame functions only).

1. ``land``: one narrow row per document (digest of the normalised text, id, locator) is written
   to the shared folder.  The locator is the file and the row in it, which is unique even when
   ids repeat.
2. A structured stream reads the landed rows and keeps, per digest and without expiry, the least
   (id, locator) and a count in the disk-backed RocksDB state store.  Its checkpoint may be kept:
   landing more rows and running again updates the same state.
3. The state is read as a table.  Every digest with a hit is checked on the full bytes: the least
   and the greatest normalised text of its documents must be the same.  Both are plain aggregates,
   so a group that holds a third of all rows shrinks to one row per map task before the shuffle.
4. Digests that fail the check (collisions) are grouped again by the text itself.

Edge cases: a null text counts as empty; all empty texts are one group.  Ids may be null (they
sort after all others) or repeat: of rows with the same id and text, the first by file and row
stays.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from projectpulse.session import scratch_path
from projectpulse.llm.common import WHITESPACE, has_locator, id_text, session_conf, text_or_empty, written

#: Without preallocated log files, so that many small stores take only the disk that they fill.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Digests with hits go to the text scan as a broadcast up to this many (32 bytes each); beyond it, by a shuffle join.
BROADCAST_DIGESTS = 200_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), WHITESPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def located(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and the locator (file, row).  Rows that do not come straight from files are
    written to the shared folder first, so that their locators are stable."""
    if not has_locator(docs):
        docs, id_col, text_col = written(id_text(docs, id_col, text_col), "dedup-input"), "doc_id", "text"
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _first() -> Column:
    """Least (id, locator) of a group; ``absent`` puts null ids last."""
    return F.min(F.struct("absent", "doc_id", "file", "row"))


def land(rows: DataFrame, folder: str, digest: Callable[[Column], Column] = sha256) -> None:
    """Append one row per document to the landing folder."""
    rows.select(digest(normalised(F.col("text"))).alias("digest"), F.col("doc_id").isNull().alias("absent"),
                "doc_id", "file", "row").write.mode("append").parquet(folder)


def update_state(spark: SparkSession, folder: str, state: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stream what has been landed since the last call into the keyed state; return the state:
    digest, first (struct absent, doc_id, file, row), n."""
    landed = spark.read.parquet(folder)
    with session_conf(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB,
                      spark__sql__streaming__stateStore__rocksdb__allowFAllocate="false"):
        query = (spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
                 .groupBy("digest").agg(_first().alias("first"), F.count("*").alias("n"))
                 .writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        store = spark.read.format("statestore").load(state)
        first, n = store.schema["value"].dataType.names
        return store.select(F.col("key.digest").alias("digest"), F.col("value")[first].alias("first"),
                            F.col("value")[n].alias("n"))


def _with_digests(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """Rows whose digest is in the table ``digests``."""
    few = digests.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    return rows.join(F.broadcast(digests) if few else digests, "digest", "left_semi")


def dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, file, row, digest, keep_id, group_size, kept."""
    rows = located(docs, id_col, text_col)
    folder, state = scratch_path(spark, "dedup-landed"), scratch_path(spark, "dedup-state")
    land(rows, folder, digest)
    landed = spark.read.parquet(folder)
    groups = written(update_state(spark, folder, state), "dedup-groups")

    texts = rows.select(digest(normalised(F.col("text"))).alias("digest"), F.col("doc_id").isNull().alias("absent"),
                        "doc_id", "file", "row", normalised(F.col("text")).alias("norm"))
    hits = _with_digests(texts, groups.where("n > 1").select("digest"))
    collided = written(hits.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("z"))
                       .where("a <> z").select("digest"), "dedup-collided")
    sure, again = groups, None
    if not collided.isEmpty():
        sure = groups.join(collided, "digest", "left_anti")
        apart = _with_digests(texts, collided)
        by_text = apart.groupBy("digest", "norm").agg(_first().alias("first"), F.count("*").alias("n"))
        again = apart.join(by_text, ["digest", "norm"]).drop("norm")
        landed = landed.join(collided, "digest", "left_anti")
    out = landed.join(sure, "digest")
    if again is not None:
        out = out.unionByName(again)
    return out.select("doc_id", "file", "row", "digest", F.col("first.doc_id").alias("keep_id"),
                      F.col("n").alias("group_size"),
                      (F.col("file").eqNullSafe(F.col("first.file")) & F.col("row").eqNullSafe(F.col("first.row"))).alias("kept"))


def keep_first(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    if not has_locator(docs):
        docs = written(docs, "dedup-docs")
    dropped = dedup(spark, docs, id_col, text_col).where("not kept").select(
        F.col("file").alias("__file"), F.col("row").alias("__row"))
    rows = docs.withColumns({"__at": F.col("_metadata.file_path"), "__nr": F.col("_metadata.row_index")})
    return (rows.join(dropped, (F.col("__at") == F.col("__file")) & (F.col("__nr") == F.col("__row")), "left_anti")
            .drop("__at", "__nr"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
