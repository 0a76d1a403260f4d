"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

import projectpulse
from projectpulse.session import scratch_path

def _return_memory() -> None:
    """Python workers live on between tasks and stages.  By default the C library keeps ever larger freed arrays for
    later use; with fixed limits those from 4 MB up go back at once, and the free end of the heap beyond 16 MB."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 16 << 20)  # M_TRIM_THRESHOLD
        libc.mallopt(-8, 1)  # M_ARENA_MAX: Arrow's threads would each keep freed memory of their own
    except (OSError, AttributeError, TypeError):  # another C library
        pass


_return_memory()


def give_back() -> None:
    """Return what a finished task has freed inside the heap, too: Spark hands tasks to idle workers in turn, so all
    of them would keep the most that any task took."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError, TypeError):  # another C library
        pass



WHITESPACE = r"[\x20\x09-\x0D]+"  # ASCII white space, as byte and as character class


#: Arrow batches between Spark and Python hold at most about this many bytes: texts differ in length.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it again: lineage ends there, and a
    lost executor costs a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names: other columns cannot clash."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def by_pandas(rows: DataFrame, run: Callable, schema: str, id_col: str = "doc_id") -> DataFrame:
    """``rows.mapInPandas`` for rows with an id, which comes first in the result, before the columns of ``schema``.
    The id passes as text: pandas makes doubles of whole numbers next to a null, which changes them above 2**53."""
    kind = rows.schema[id_col].dataType

    def task(batches):
        yield from run(batches)
        give_back()
    out = rows.withColumn(id_col, F.col(id_col).cast("string")).mapInPandas(task, f"{id_col} string, {schema}")
    return out.withColumn(id_col, F.col(id_col).cast(kind))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(n).cast("long")).cast("int")


def has_locator(docs: DataFrame) -> bool:
    """True when the rows come straight from files, so that (file, row) names each of them."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Set session options (dots written as ``__``) for a block and put the old values back."""
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def slices(pdf: pd.DataFrame, *columns: str, size: int = 2 << 20) -> Iterator[pd.DataFrame]:
    """Consecutive rows of a batch, together of about ``size`` characters in the text columns named, so that
    what is made of them stays small.  A longer text is a slice of its own."""
    lengths = sum(pdf[c].str.len().fillna(0) for c in columns)
    number = (lengths.cumsum() // size).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1), len(pdf)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield pdf.iloc[a:b].reset_index(drop=True)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers of every executor this package, once per application, as
    ``--py-files`` would: a small zip that Spark hands out."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(projectpulse.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="pp-code-")) / "projectpulse.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)
