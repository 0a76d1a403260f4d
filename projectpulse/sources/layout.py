"""How rows are dealt over tasks.

Co-located tables: bucketed and sorted by a key, so that joins on it need no shuffle.

Tables with the same number of buckets hold equal keys in buckets of the same number, one
sorted file each; Spark joins them bucket by bucket, without an Exchange.  (It still plans a
Sort of each bucket, which finds it sorted.)  The one shuffle by the key is paid when a table
is written, for all joins that follow.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame

from projectpulse.session import scratch_path


#: Rows of a task where narrow rows are made wide: AQE cuts tasks by the compressed bytes that it read, which are few there.
TASK_ROWS = 250_000


def tasks_for(rows: int) -> int:
    """Tasks for so many rows: their number grows with the rows, what one holds does not."""
    return max(1, math.ceil(rows / TASK_ROWS))


def bucket_count(df: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions: the same for all tables of a session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def co_located(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder in buckets by ``key``, and read back.

    For inner joins: rows whose key is NULL cannot match and are left out, as all of them would
    be one bucket."""
    spark = df.sparkSession
    n = buckets or bucket_count(df)
    table = f"pp_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (df.where(df[key].isNotNull()).repartition(n, key).write.bucketBy(n, key).sortBy(key)
     .option("path", scratch_path(spark, name)).saveAsTable(table, format="parquet"))
    return spark.table(table)
