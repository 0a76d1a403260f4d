"""Contract-grain variance and keep-first de-duplication.

``dedup_first`` replaces ``row_number() OVER (PARTITION BY k ORDER BY o) = 1`` plus
``count(*) OVER (PARTITION BY k)`` by one aggregate: ``min_by`` of the row struct
ordered by ``(o IS NULL, o)`` (NULLs last, as the SQL ordering puts them) and a
count.  (Spark runs it sort-based because the buffer is a struct.)  Partial
aggregation runs map-side, so a contract that bundles a third of all rows is
combined before the shuffle instead of being sorted in one window task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectpulse.functions.scalar import calendar_day_diff, safe_ratio


def schedule_variance(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """Days from ``start`` to ``end`` (positive = late), BIGINT, NULL if either is NULL."""
    return df.withColumn(name, calendar_day_diff(start, end))


def cost_variance(df: DataFrame, award: str, current: str, final: str,
                  dollars: str = "cost_variance_dollars", pct: str = "cost_variance_pct") -> DataFrame:
    """(final, else current) − award, in dollars and as a share of a non-zero award."""
    spent = F.coalesce(F.col(final), F.col(current))
    return df.withColumns({dollars: spent - F.col(award),
                           pct: safe_ratio(spent - F.col(award), F.col(award))})


def contract_variance(staged: DataFrame) -> DataFrame:
    """Staged contracts + the four variance columns of the contract table."""
    out = schedule_variance(staged, "original_completion_date", "actual_completion_date",
                            "schedule_variance_days_actual")
    out = schedule_variance(out, "original_completion_date", "current_completion_date",
                            "schedule_variance_days_current")
    return cost_variance(out, "award_amount", "current_amount", "final_cost")


def dedup_first(df: DataFrame, key: str, order: str, count_col: str = "project_count",
                drop=()) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` (NULLs last), plus a row count.

    Output columns: the input columns minus ``drop`` (``order`` may be dropped),
    followed by ``count_col``.
    """
    keep = [c for c in df.columns if c != key and c not in drop]
    carried = [c for c in df.columns if c != key]
    ordering = F.struct(F.col(order).isNull().alias("o_null"), F.col(order).alias("o"))
    agg = (df.groupBy(key)
           .agg(F.min_by(F.struct(*[F.col(c) for c in carried]), ordering).alias("__first"),
                F.count(F.lit(1)).alias(count_col)))
    return agg.select(key, *[F.col(f"__first.{c}").alias(c) for c in keep], count_col)


def bundling_stats(distinct_contracts: DataFrame, count_col: str = "project_count") -> DataFrame:
    """How many contracts bundle two or more projects, out of all contracts."""
    return distinct_contracts.agg(
        F.count(F.lit(1)).alias("n_contracts"),
        F.count_if(F.col(count_col) > 1).alias("n_bundled"),
    )
