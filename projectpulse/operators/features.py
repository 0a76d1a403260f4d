"""Model feature table: labels, activity flag, rare-category buckets, log size.

Bucketing keeps a category when it has at least ``min_rated`` rated rows in the KPI
rates table (counted over rated rows, applied to all rows); NULL and unseen values
fall into ``OTHER``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectpulse.functions.scalar import log_positive
from projectpulse.operators.joins import checked_broadcast, lookup_flag
from projectpulse.operators.kpi import ACTIVE, DEFAULT_DIMS, RATED

# Fixed values of the feature table.
OTHER = "Other/Small Category"
MIN_RATED = 30
BAD_LEVELS = ("Y", "R")
CATEGORICAL = ["project_type_bucketed", "road_system_bucketed", "district_bucketed"]
NUMERIC = ["log_allocated_budget"]
FEATURES = CATEGORICAL + NUMERIC


def bucket_rare(df: DataFrame, col: str, qualifying: DataFrame, out: str, other: str = OTHER,
                checked: bool = True) -> DataFrame:
    """``CASE WHEN col IN (qualifying) THEN col ELSE other END`` as a left join on the
    qualifying set (broadcast after a size check unless ``checked=False``, when the
    caller has already decided)."""
    flagged = lookup_flag(df, col, qualifying, "__keep", check=checked)
    return flagged.withColumn(out, F.when(F.col("__keep"), F.col(col)).otherwise(F.lit(other))).drop("__keep")


def at_risk_label(provenance: F.Column, on_time: F.Column, on_budget: F.Column, rated=RATED) -> F.Column:
    """1 if either status is Y or R, 0 if neither, NULL when unrated or undecidable (3-valued OR)."""
    bad = on_time.isin(list(BAD_LEVELS)) | on_budget.isin(list(BAD_LEVELS))
    return F.when(provenance.isin(list(rated)), bad.cast("int"))


def model_features(projects: DataFrame, rates: DataFrame, dims=DEFAULT_DIMS,
                   min_rated: int = MIN_RATED) -> DataFrame:
    src = F.col("data_source")
    out = projects.select("upc", "data_source", "project_type", "road_system", "district",
                          "allocated_budget", "on_time_status", "on_budget_status")
    # One size check for the three lookups: the qualifying rows of all cuts together.
    qual = checked_broadcast(rates.where(F.col("cut_type").isin(list(dims)) & (F.col("n_rated") >= min_rated))
                             .select("cut_type", "cut_value"))
    for d in dims:
        out = bucket_rare(out, d, qual.where(F.col("cut_type") == d).select("cut_value"), f"{d}_bucketed",
                          checked=False)
    return out.select(
        "upc", "data_source",
        src.isin(list(RATED)).alias("has_label"),
        src.isin(list(ACTIVE)).alias("is_currently_active"),
        "project_type_bucketed", "road_system_bucketed", "district_bucketed",
        "allocated_budget",
        log_positive("allocated_budget").alias("log_allocated_budget"),
        at_risk_label(src, F.col("on_time_status"), F.col("on_budget_status")).alias("at_risk"),
    )


def training_rows(features: DataFrame) -> DataFrame:
    """Labelled rows with a decided label (rows with a NULL label cannot train)."""
    return features.where(F.col("has_label") & F.col("at_risk").isNotNull())


def active_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("is_currently_active"))
