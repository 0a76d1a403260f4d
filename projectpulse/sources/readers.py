"""Readers and sinks.

* Parquet tables are read by name; Catalyst pushes filters and column pruning
  into the scan.
* CSV extracts are read with an explicit schema (never inferred in production),
  multi-line quoted fields and a BOM-tolerant UTF-8 decoder, then missing-value
  tokens are normalised.
* Table sinks replace atomically (``tables``); a table may be replaced by a plan that
  reads it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from projectpulse.functions.scalar import null_tokens_to_null
from projectpulse.sources.tables import read_current, write_table


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a DataFrame queryable by name from Spark SQL."""
    df.createOrReplaceTempView(name)
    return df


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, null_tokens=None, multi_line: bool = False) -> DataFrame:
    """Read a headed CSV export with quoted commas.

    ``multi_line`` keeps a quoted field with a line break in one record, for sources whose text
    holds line breaks; files are read in splits all the same (``csv_splits``), at the price of three
    scans, so it is off by default.  The UTF-8 decoder drops a leading BOM.  String columns
    then have the reader's missing-value tokens mapped to NULL.
    """
    if multi_line:
        from projectpulse.sources.csv_splits import read_csv_splits
        df = read_csv_splits(spark, path, schema)
    else:
        df = (spark.read.schema(schema).option("header", True)
              .option("quote", '"').option("escape", '"')
              .option("encoding", "UTF-8").option("mode", "FAILFAST")
              .csv(path))
    return df.select([
        null_tokens_to_null(F.col(f.name), null_tokens).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str, max_rows: int = 100_000) -> str:
    """Small result tables (metrics) as one headed CSV file in ``path``.  More than ``max_rows``
    rows are an error: they would all go through one task."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows for a one-file CSV; use write_table")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def materialize(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write a reused intermediate into the shared checkpoint folder and read it back.

    This cuts lineage (a lost executor re-reads the files instead of recomputing the
    plan) and gives later stages exact size statistics.
    """
    from projectpulse.session import scratch_path

    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def land_inputs(inputs: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Land each input as a table of its own under ``root``, replacing what is there; returns name -> table.
    Names may hold any characters (sheet names): tables are numbered in the order of the names."""
    tables = {name: f"{root.rstrip('/')}/input-{i:02d}" for i, name in enumerate(sorted(inputs))}
    for name, path in tables.items():
        write_table(inputs[name], path)
    return tables


def read_input(spark: SparkSession, folders: dict[str, str], name: str) -> DataFrame:
    """The landed input of that name."""
    if name not in folders:
        raise KeyError(f"no input {name!r}; there are {sorted(folders)}")
    return read_current(spark, folders[name])


def table_counts(tables: dict) -> DataFrame:
    """Row count per named table: one aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
