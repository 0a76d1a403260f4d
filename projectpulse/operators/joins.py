"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only when it has at most this many rows (checked).
BROADCAST_MAX_ROWS = 200_000


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(small)`` if it has at most ``max_rows`` rows, else ``small`` unchanged.

    The check is one bounded action (``limit(max_rows + 1).count()``); beyond the bound
    the join stays a shuffle join that AQE may still convert from runtime sizes.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def lookup_flag(df: DataFrame, col: str, values: DataFrame, flag: str, max_rows: int = BROADCAST_MAX_ROWS,
                check: bool = True) -> DataFrame:
    """Add ``flag`` = whether ``df[col]`` is among ``values`` (one column ``v``), NULL → false.

    The uncorrelated ``x IN (subquery)`` inside a projection, as a left join on the
    distinct value set.
    """
    vals = values.select(F.col(values.columns[0]).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    vals = vals.withColumn(flag, F.lit(True))
    if check:
        vals = checked_broadcast(vals, max_rows)
    out = df.join(vals, df[col] == vals["__v"], "left").drop("__v")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which a NULL key equals a NULL key; the keys come out once."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
