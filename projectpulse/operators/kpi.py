"""Multi-cut KPI tables.

A *cut* is a named one-dimensional breakdown.  The KPI tables are rolled up from finest
cells: one aggregate gives counts, sums and value histograms per combination of the
dimensions (``quantiles.rollup_stats``), and ``explode_cuts`` then turns each *cell*
into one row per cut with ``inline(array(struct(cut_type, cut_value), ...))``, so no
input row is repeated for a cut.  A NULL dimension value stays its own group and the cut
is named, so NULL never mixes with "not in this cut" (the grouping-sets trap).
``multi_cut_agg`` is the form for aggregates that cannot be added up from cells.

Skew: the ``overall`` cut holds every row.  All states aggregate partially map-side, and
medians never hold a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectpulse.operators.quantiles import Stat, grouped_stats, rollup_stats

DEFAULT_DIMS = ("district", "project_type", "road_system")
OVERALL = ("overall", "ALL")
RATED = ("both", "dashboard_only")
ACTIVE = ("both", "syip_only")
STATUS_LEVELS = ("G", "Y", "R")
CUT_KEYS = ("cut_type", "cut_value")


def explode_cuts(df: DataFrame, dims, measures, overall: bool = True) -> DataFrame:
    """(cut_type, cut_value, *measures): one row per input row and cut.

    ``dims`` is a list of column names or ``(cut_name, column)`` pairs.
    """
    pairs = [(d, d) if isinstance(d, str) else tuple(d) for d in dims]
    structs = []
    if overall:
        structs.append(F.struct(F.lit(OVERALL[0]).alias("cut_type"), F.lit(OVERALL[1]).alias("cut_value")))
    for name, col in pairs:
        structs.append(F.struct(F.lit(name).alias("cut_type"), F.col(col).cast("string").alias("cut_value")))
    return df.select(*measures, F.inline(F.array(*structs))).select(*CUT_KEYS, *measures)


def multi_cut_agg(df: DataFrame, dims, aggs, measures, overall: bool = True,
                  medians: dict | None = None) -> DataFrame:
    cuts = explode_cuts(df, dims, measures, overall)
    return grouped_stats(cuts, list(CUT_KEYS), aggs, medians)


def cut_rollup(df: DataFrame, dims, stats, overall: bool = True, medians: dict | None = None) -> DataFrame:
    """(cut_type, cut_value, statistics and medians) of every cut, added up from the cells of the dimensions."""
    cells = list(dict.fromkeys(d if isinstance(d, str) else d[1] for d in dims))
    return rollup_stats(df, cells, list(CUT_KEYS), lambda rows, columns: explode_cuts(rows, dims, columns, overall), stats, medians)


def status_rates(projects: DataFrame, dims=DEFAULT_DIMS, rated=RATED,
                 statuses=("on_time_status", "on_budget_status"), levels=STATUS_LEVELS,
                 provenance: str = "data_source") -> DataFrame:
    """Rated rows only: count and G/Y/R shares of each status per cut (NULL status not counted)."""
    base = projects.where(F.col(provenance).isin(list(rated)))
    stats = [Stat("n_rated", "count")]
    for s in statuses:
        prefix = s.replace("_status", "")
        for lv in levels:
            stats.append(Stat(f"{prefix}_{lv.lower()}_rate", "mean", (F.col(s) == lv).cast("int")))
    return cut_rollup(base, dims, stats)


def cost_variance_kpi(projects: DataFrame, dims=DEFAULT_DIMS, estimate: str = "current_estimate",
                      budget: str = "allocated_budget") -> DataFrame:
    """Rows with both figures: n, median and mean variance in dollars and as a share of budget."""
    base = (projects.where(F.col(estimate).isNotNull() & F.col(budget).isNotNull())
            .withColumn("variance_dollars", F.col(estimate) - F.col(budget))
            .withColumn("variance_pct", (F.col(estimate) - F.col(budget))
                        / F.when(F.col(budget) != 0, F.col(budget))))
    dim_cols = [d if isinstance(d, str) else d[1] for d in dims]
    out = cut_rollup(
        base.select(*dict.fromkeys(dim_cols), "variance_dollars", "variance_pct"), dims,
        [Stat("n", "count"), Stat("avg_variance_dollars", "mean", F.col("variance_dollars")),
         Stat("avg_variance_pct", "mean", F.col("variance_pct"))],
        medians={"median_variance_dollars": "variance_dollars", "median_variance_pct": "variance_pct"})
    return out.select(*CUT_KEYS, "n", "median_variance_dollars", "avg_variance_dollars",
                      "median_variance_pct", "avg_variance_pct")


def schedule_overall(distinct_contracts: DataFrame) -> DataFrame:
    """Contract grain: completed count, median and mean days late (actual and current)."""
    out = grouped_stats(
        distinct_contracts, [],
        [F.count_if(F.col("schedule_variance_days_actual").isNotNull()).alias("n_completed"),
         F.avg("schedule_variance_days_actual").alias("avg_days_late_actual"),
         F.count_if(F.col("schedule_variance_days_current").isNotNull()).alias("n_with_current_date"),
         F.avg("schedule_variance_days_current").alias("avg_days_late_current")],
        medians={"median_days_late_actual": "schedule_variance_days_actual",
                 "median_days_late_current": "schedule_variance_days_current"})
    return out.select("n_completed", "median_days_late_actual", "avg_days_late_actual",
                      "n_with_current_date", "median_days_late_current", "avg_days_late_current")


def schedule_by_cut(contracts: DataFrame, projects: DataFrame, dims=DEFAULT_DIMS,
                    value: str = "schedule_variance_days_actual") -> DataFrame:
    """Project grain: each (contract, project) pair with an actual date, cut by the project's
    own attributes (the contract's district is not used); no overall row.

    Inner join on the project key; a hot key on the contract side is split by AQE's
    skew-join handling, and only the value and the three dimensions cross the shuffle.
    """
    c = contracts.where(F.col(value).isNotNull()).select("upc", value)
    p = projects.select("upc", *[F.col(d).alias(f"proj_{d}") for d in dims])
    base = c.join(p, "upc").select(*[f"proj_{d}" for d in dims], value)
    out = cut_rollup(base, [(d, f"proj_{d}") for d in dims], [Stat("n", "count"), Stat("avg_days_late", "mean", F.col(value))],
                     overall=False, medians={"median_days_late": value})
    return out.select(*CUT_KEYS, "n", "median_days_late", "avg_days_late")


def kpi_order(df: DataFrame, n_col: str) -> DataFrame:
    """Presentation order: cut_type, n descending, cut_value (NULLs last everywhere)."""
    return df.orderBy(F.col("cut_type").asc_nulls_last(), F.col(n_col).desc_nulls_last(),
                      F.col("cut_value").asc_nulls_last())
