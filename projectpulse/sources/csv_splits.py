"""Headed CSV with line breaks inside quoted fields, read in splits.

Spark's ``multiLine`` reader takes a file as one task, because whether a line break ends a
record depends on all quotes before it.  That is one bit per byte range:

1. the lines of every split are read as text, and the quotes of each split are counted;
2. a running total over the splits of a file, in their order, tells for each split whether
   it starts inside a quoted field (a doubled quote counts twice and changes nothing);
3. with that bit a split cuts its lines into records by itself.  What is left over at its
   ends, the head of a record that began earlier and the tail of one that goes on, are at
   most two fragments a split; fragments are put together by file and order.

So one file is as many tasks as it has splits, the text itself is never shuffled, and
records are parsed by Spark's CSV parser.  The text is scanned three times: for quotes, for
fragments and for records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from projectpulse.operators.evaluate import running_totals

WHOLE, HEAD, TAIL, THROUGH = range(4)
#: One row per split (128 MB by default) is broadcast; more rows than this are an error.
MAX_SPLITS = 5_000_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block and value of every line, in the order of a split's lines within its task."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, inside, value) to records and fragments (file, block, part, first, record)."""
    block, parity, held, from_start, number = None, 0, [], False, 0

    def row(part):
        return (*block, part, number == 0 and block[1] == 0 and part in (WHOLE, TAIL, THROUGH), "\n".join(held))

    def close():
        if block is not None and held:
            yield row(THROUGH if from_start else TAIL)

    for batch in batches:
        out: list[tuple] = []
        blocks = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()))
        inside = batch.column("inside").to_pylist()
        values = batch.column("value")
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        change = [i for i in range(len(blocks)) if i == 0 or blocks[i] != blocks[i - 1]]
        for a, b in zip(change, [*change[1:], len(blocks)]):
            if blocks[a] != block:
                out += close()
                block, parity, held, number = blocks[a], inside[a], [], 0
                from_start = bool(parity)
            after = (parity + np.cumsum(quotes[a:b])) & 1
            before = np.concatenate([[parity], after[:-1]])
            lines = values.slice(a, b - a)
            for i, single in enumerate(((before == 0) & (after == 0)).tolist()):
                text = lines[i].as_py()
                if single:
                    out.append((*block, WHOLE, number == 0 and block[1] == 0, text))
                    number += 1
                    continue
                held.append(text)
                if after[i] == 0:  # a record ends here
                    out.append(row(HEAD if from_start else WHOLE))
                    held, from_start = [], False
                    number += 1
            parity = int(after[-1])
        yield _rows(out)
    yield _rows(list(close()))


_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the text of every record but the headers.  A file that ends inside a quoted field raises an error."""
    lines = _lines(spark, path)
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("bigint")
    splits = running_totals(lines.groupBy("file", "block").agg(F.sum(quotes).alias("n")), F.col("block"), ["n"], ["file"], inclusive=False)
    splits = splits.select("file", "block", (F.col("cum_n") % 2).cast("int").alias("inside"))
    if splits.limit(MAX_SPLITS + 1).count() > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits; read fewer files at once or larger splits")
    cut = lines.join(F.broadcast(splits), ["file", "block"]).select("file", "block", "inside", "value").mapInArrow(
        _cut, "file string, block long, part int, first boolean, record string")
    whole = cut.where((F.col("part") == WHOLE) & ~F.col("first")).select("record")
    upto = Window.partitionBy("file").orderBy("block", F.col("part") == TAIL).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = cut.where(F.col("part") != WHOLE).withColumn("opened", F.sum((F.col("part") == TAIL).cast("int")).over(upto))
    joined = pieces.groupBy("file", "opened").agg(
        F.sort_array(F.collect_list(F.struct("block", "part", "record"))).alias("pieces"), F.max("first").alias("first"),
        F.count_if(F.col("part") == HEAD).alias("closed"))
    text = F.array_join(F.transform("pieces", lambda p: p["record"]), "\n")
    ended = F.when(F.col("closed") == 1, text).otherwise(F.raise_error(F.concat(F.lit("an open quote at the end of "), F.col("file"))))
    return whole.unionByName(joined.where(~F.col("first") | (F.col("closed") != 1)).select(ended.cast("string").alias("record")))


def read_csv_splits(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of headed CSV files whose quoted fields may hold line breaks; quotes are doubled inside fields.
    Empty lines are skipped, as Spark's reader does."""
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    ready = F.regexp_replace("record", r"\r$", "")
    rows = records(spark, path).select(ready.alias("record")).where("record <> ''")
    return rows.select(F.from_csv("record", _ddl(schema), options).alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
