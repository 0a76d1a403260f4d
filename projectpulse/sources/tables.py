"""Tables that are replaced atomically.

A table is a folder of versions, each a Parquet folder of its own, and a pointer file that
names the committed ones, the current one first.  ``write_table`` writes a new version
beside the old ones and then replaces the pointer by one rename: a reader sees the whole
old table or the whole new one, a failed write leaves the old table as it was, and a table
can be replaced by a plan that reads it.  Of the committed versions the last ``keep`` stay,
for readers that resolved the pointer before; older ones are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    """The file system of a path and the path, from Hadoop: any store that Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed versions, the current one first; none if there is no table."""
    fs, p = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return []
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, versions: list[str]) -> None:
    jvm = spark._jvm
    fs, new = _fs(spark, f"{path}/{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray("\n".join(versions).encode()))
    out.close()
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    qualified = lambda name: fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
    context.rename(qualified(new.getName()), qualified(POINTER), how)


def _remove(spark: SparkSession, folder: str) -> None:
    fs, p = _fs(spark, folder)
    fs.delete(p, True)


def write_table(df: DataFrame, path: str, partition_by=None, keep: int = 2) -> str:
    """``CREATE OR REPLACE TABLE``: returns the folder of the new version, which ``current`` also finds.
    Two writers at once both succeed; the pointer names the one that commits last."""
    spark, path = df.sparkSession, path.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.parquet(folder)
    except Exception:
        _remove(spark, folder)
        raise
    versions = [version, *_versions(spark, path)]
    _commit(spark, path, versions[:keep])
    for old in versions[keep:]:
        _remove(spark, f"{path}/{old}")
    return folder


def current(spark: SparkSession, path: str) -> str:
    """The folder of the committed version of a table."""
    versions = _versions(spark, path.rstrip("/"))
    if not versions:
        raise FileNotFoundError(f"no table at {path}")
    return f"{path.rstrip('/')}/{versions[0]}"


def read_current(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current(spark, path))
