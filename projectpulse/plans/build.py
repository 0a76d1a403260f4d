"""The build DAG: extracts → staged → merged projects → contracts → KPIs → features.

Every function is lazy and returns a DataFrame; ``build_all`` materialises the tables
that later steps reuse (projects, contracts, model features) into the shared
checkpoint folder, which cuts lineage and lets AQE plan joins from real sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from projectpulse.operators import kpi, variance
from projectpulse.operators.cleaning import CONTRACT_SPEC, OUTCOME_SPEC, PROGRAM_SPEC, stage
from projectpulse.operators.merge import merge_with_provenance
from projectpulse.sources import fixtures


def program(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(fixtures.raw_program(spark, sf_dir), PROGRAM_SPEC)


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(fixtures.raw_outcome(spark, sf_dir), OUTCOME_SPEC)


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_with_provenance(program(spark, sf_dir), outcome(spark, sf_dir), "upc")


def measured(df: DataFrame, name: str, rules) -> tuple[DataFrame, DataFrame]:
    """``df`` written to the shared checkpoint folder and read back, and the results of the rules, measured on the write."""
    from projectpulse.operators.quality import measured_write
    from projectpulse.sources.readers import materialize
    return measured_write(df, rules, lambda d: materialize(d, df.sparkSession, name))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variance.contract_variance(stage(fixtures.raw_contracts(spark, sf_dir), CONTRACT_SPEC))


def contracts_distinct(contracts_df: DataFrame) -> DataFrame:
    return variance.dedup_first(contracts_df, "contract_id", "upc", drop=("upc",))


def kpi_rates(projects_df: DataFrame) -> DataFrame:
    return kpi.status_rates(projects_df)


def model_features(projects_df: DataFrame, rates_df: DataFrame | None = None) -> DataFrame:
    from projectpulse.operators.features import model_features as mf
    return mf(projects_df, rates_df if rates_df is not None else kpi_rates(projects_df))


def build_all(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """Build every table in dependency order and replace each one under ``out_dir``; returns the folders
    of the new versions (``sources.tables.current`` finds them by name, too).

    Tables that later steps read (projects, contracts, KPI rates, features) are read
    back from their written files, so each upstream plan runs once; rows are counted on the writes.
    """
    from projectpulse.operators.quality import measured_write, row_count
    from projectpulse.sources.readers import write_table

    paths: dict[str, str] = {}
    counts: list[DataFrame] = []

    def put(name: str, df: DataFrame) -> DataFrame:
        paths[name], rows = measured_write(df, [row_count(name=name)], lambda d: write_table(d, f"{out_dir.rstrip('/')}/{name}"))
        counts.append(rows)
        return spark.read.parquet(paths[name])

    p = put("projects", merge_with_provenance(put("stg_syip", program(spark, sf_dir)), put("stg_dashboard", outcome(spark, sf_dir)), "upc"))
    c = put("stg_contracts", contracts(spark, sf_dir))
    cd = put("stg_contracts_distinct", contracts_distinct(c))
    rates = put("kpi_rates", kpi_rates(p))
    put("kpi_cost_variance", kpi.cost_variance_kpi(p))
    put("kpi_schedule_variance_overall", kpi.schedule_overall(cd))
    put("kpi_schedule_variance_by_cut", kpi.schedule_by_cut(c, p))
    put("model_features", model_features(p, rates))
    put("table_counts", reduce(DataFrame.unionByName, counts).select(F.col("rule").alias("table_name"), F.col("observed").cast("bigint").alias("n_rows")))
    return paths


def train_and_score(spark: SparkSession, features_path: str, out_dir: str) -> dict[str, str]:
    """Fit the final model on the labelled rows, save it, score the active rows (risk_scores)."""
    from projectpulse.operators import explain, features as ft, model
    from projectpulse.sources.readers import write_table

    mf = spark.read.parquet(features_path)
    m = model.train_logistic(ft.training_rows(mf))
    base = out_dir.rstrip("/")
    return {
        "model": model.save_model(m, f"{base}/risk_model"),
        "feature_table": write_table(explain.global_feature_table(explain.coefficient_table(spark, m)),
                                     f"{base}/global_feature_table"),
        "risk_scores": write_table(explain.score_and_explain(ft.active_rows(mf), m), f"{base}/risk_scores"),
    }
