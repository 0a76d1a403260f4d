"""Registered queries: one per operator group of the inventory.

Each entry is ``name -> (fn(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
Doubles are rounded to 6 places on both sides (summation order differs between
engines).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from projectpulse.operators import kpi, variance
from projectpulse.operators.quantiles import grouped_stats
from projectpulse.plans import build
from projectpulse.plans.oracle import with_ctes
from projectpulse.sources import fixtures
from projectpulse.sources.layout import co_located

REGISTRY: dict[str, tuple] = {}
PLACES = 6


def bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` returns HUGEINT; Spark's returns BIGINT.  Wrap every call in a
    BIGINT cast so both result schemas agree."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append(f"CAST(count_if({bigint_counts(sql[j + len(token):k - 1])}) AS BIGINT)")
        i = k


def query(name: str, oracle: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, bigint_counts(oracle) if oracle else None)
        return fn
    return deco


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    return df.select([
        F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields])


def r6(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, {PLACES}) AS {alias or expr}"


# ---------------------------------------------------------------- staging (PRJ1-3, FN1-3)

@query("stage_program", with_ctes("SELECT * FROM stg_syip", "stg_syip"))
def q_stage_program(spark: SparkSession, d: str) -> DataFrame:
    return build.program(spark, d)


@query("stage_outcome", with_ctes("SELECT * FROM stg_dashboard", "stg_dashboard"))
def q_stage_outcome(spark: SparkSession, d: str) -> DataFrame:
    return build.outcome(spark, d)


@query("stage_contracts", with_ctes(
    "SELECT contract_id, upc, district, road_system, original_completion_date, current_completion_date, "
    "actual_completion_date, award_amount, current_amount, final_cost, on_time_status, on_budget_status, "
    "schedule_variance_days_actual, schedule_variance_days_current, "
    f"{r6('cost_variance_dollars')}, {r6('cost_variance_pct')} FROM stg_contracts", "stg_contracts"))
def q_stage_contracts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(build.contracts(spark, d))


@query("parse_dates", with_ctes(
    "SELECT upc, pe_start_date, rw_start_date, cn_start_date, cn_end_date, "
    "date_diff('day', pe_start_date, cn_start_date) AS pe_to_cn_days FROM stg_syip", "stg_syip"))
def q_parse_dates(spark: SparkSession, d: str) -> DataFrame:
    from projectpulse.functions.scalar import calendar_day_diff
    p = build.program(spark, d)
    return p.select("upc", "pe_start_date", "rw_start_date", "cn_start_date", "cn_end_date",
                    calendar_day_diff("pe_start_date", "cn_start_date").alias("pe_to_cn_days"))


# ---------------------------------------------------------------- merge (JOIN1-2, FN5, PRJ4)

@query("merge_projects", with_ctes("SELECT * FROM projects", "projects"))
def q_merge_projects(spark: SparkSession, d: str) -> DataFrame:
    return build.projects(spark, d)


@query("merge_provenance", with_ctes(
    "SELECT data_source, count(*) AS n FROM projects GROUP BY data_source", "projects"))
def q_merge_provenance(spark: SparkSession, d: str) -> DataFrame:
    from projectpulse.operators.merge import provenance_counts
    return provenance_counts(build.projects(spark, d))


@query("rated_filter", with_ctes(
    "SELECT upc, data_source, on_time_status, on_budget_status FROM rated", "rated"))
def q_rated_filter(spark: SparkSession, d: str) -> DataFrame:
    p = build.projects(spark, d)
    return p.where(F.col("data_source").isin(list(kpi.RATED))).select(
        "upc", "data_source", "on_time_status", "on_budget_status")


@query("placeholder_keys", with_ctes(
    "SELECT count_if(upc < 0) AS n_placeholder, "
    "count_if(upc < 0 AND data_source <> 'syip_only') AS n_placeholder_matched, "
    "count_if(upc > 0) AS n_permanent FROM projects", "projects"))
def q_placeholder_keys(spark: SparkSession, d: str) -> DataFrame:
    p = build.projects(spark, d)
    return p.agg(F.count_if(F.col("upc") < 0).alias("n_placeholder"),
                 F.count_if((F.col("upc") < 0) & (F.col("data_source") != "syip_only")).alias("n_placeholder_matched"),
                 F.count_if(F.col("upc") > 0).alias("n_permanent"))


# ---------------------------------------------------------------- contracts (WIN1-2, FN4, FN6-7)

@query("contracts_distinct", with_ctes(
    "SELECT contract_id, district, road_system, original_completion_date, current_completion_date, "
    "actual_completion_date, award_amount, current_amount, final_cost, on_time_status, on_budget_status, "
    "schedule_variance_days_actual, schedule_variance_days_current, "
    f"{r6('cost_variance_dollars')}, {r6('cost_variance_pct')}, project_count FROM contracts_distinct",
    "contracts_distinct"))
def q_contracts_distinct(spark: SparkSession, d: str) -> DataFrame:
    return rounded(build.contracts_distinct(build.contracts(spark, d)))


@query("schedule_variance", with_ctes(
    "SELECT contract_id, upc, schedule_variance_days_actual, schedule_variance_days_current "
    "FROM stg_contracts", "stg_contracts"))
def q_schedule_variance(spark: SparkSession, d: str) -> DataFrame:
    return build.contracts(spark, d).select("contract_id", "upc", "schedule_variance_days_actual",
                                            "schedule_variance_days_current")


@query("cost_variance", with_ctes(
    f"SELECT contract_id, upc, {r6('cost_variance_dollars')}, {r6('cost_variance_pct')} FROM stg_contracts",
    "stg_contracts"))
def q_cost_variance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(build.contracts(spark, d).select("contract_id", "upc", "cost_variance_dollars",
                                                    "cost_variance_pct"))


@query("contract_bundling", with_ctes(
    "SELECT count(*) AS n_contracts, count_if(project_count > 1) AS n_bundled FROM contracts_distinct",
    "contracts_distinct"))
def q_contract_bundling(spark: SparkSession, d: str) -> DataFrame:
    return variance.bundling_stats(build.contracts_distinct(build.contracts(spark, d)))


# ---------------------------------------------------------------- KPI tables (AGG1-11, SORT1)

@query("kpi_rates", with_ctes(
    "SELECT cut_type, cut_value, n_rated, " + ", ".join(
        r6(c) for c in ["on_time_g_rate", "on_time_y_rate", "on_time_r_rate",
                        "on_budget_g_rate", "on_budget_y_rate", "on_budget_r_rate"])
    + " FROM kpi_rates", "kpi_rates"))
def q_kpi_rates(spark: SparkSession, d: str) -> DataFrame:
    return rounded(kpi.kpi_order(build.kpi_rates(build.projects(spark, d)), "n_rated"))


def _cuts_sql(base: str, cols: str, dims=("district", "project_type", "road_system"), overall=True,
              prefix: str = "") -> str:
    parts = []
    if overall:
        parts.append(f"SELECT 'overall' AS cut_type, 'ALL' AS cut_value, {cols} FROM {base}")
    for dname in dims:
        parts.append(f"SELECT '{dname}' AS cut_type, CAST({prefix}{dname} AS VARCHAR) AS cut_value, {cols} FROM {base}")
    return "\nUNION ALL ".join(parts)


@query("kpi_cost_variance", with_ctes(
    "SELECT cut_type, cut_value, count(*) AS n, "
    f"{r6('median(vd)', 'median_variance_dollars')}, {r6('avg(vd)', 'avg_variance_dollars')}, "
    f"{r6('median(vp)', 'median_variance_pct')}, {r6('avg(vp)', 'avg_variance_pct')} "
    f"FROM ({_cuts_sql('cost_base', 'vd, vp')}) c GROUP BY cut_type, cut_value", "cost_base"))
def q_kpi_cost_variance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(kpi.kpi_order(kpi.cost_variance_kpi(build.projects(spark, d)), "n"))


@query("kpi_schedule_overall", with_ctes(
    "SELECT count(schedule_variance_days_actual) AS n_completed, "
    f"{r6('median(schedule_variance_days_actual)', 'median_days_late_actual')}, "
    f"{r6('avg(schedule_variance_days_actual)', 'avg_days_late_actual')}, "
    "count(*) FILTER (WHERE schedule_variance_days_current IS NOT NULL) AS n_with_current_date, "
    f"{r6('median(schedule_variance_days_current)', 'median_days_late_current')}, "
    f"{r6('avg(schedule_variance_days_current)', 'avg_days_late_current')} FROM contracts_distinct",
    "contracts_distinct"))
def q_kpi_schedule_overall(spark: SparkSession, d: str) -> DataFrame:
    return rounded(kpi.schedule_overall(build.contracts_distinct(build.contracts(spark, d))))


@query("kpi_schedule_by_cut", with_ctes(
    "SELECT cut_type, cut_value, count(*) AS n, "
    f"{r6('median(sv)', 'median_days_late')}, {r6('avg(sv)', 'avg_days_late')} FROM ("
    + _cuts_sql("(SELECT c.schedule_variance_days_actual AS sv, p.district AS proj_district, "
                "p.project_type AS proj_project_type, p.road_system AS proj_road_system "
                "FROM stg_contracts c JOIN projects p ON c.upc = p.upc "
                "WHERE c.schedule_variance_days_actual IS NOT NULL) b", "sv", overall=False, prefix="proj_")
    + ") c GROUP BY cut_type, cut_value", "stg_contracts", "projects"))
def q_kpi_schedule_by_cut(spark: SparkSession, d: str) -> DataFrame:
    days = "schedule_variance_days_actual"
    contracts = co_located(build.contracts(spark, d).where(F.col(days).isNotNull()).select("upc", days), "upc", "contracts")
    projects = co_located(build.projects(spark, d).select("upc", *kpi.DEFAULT_DIMS), "upc", "projects")
    return rounded(kpi.kpi_order(kpi.schedule_by_cut(contracts, projects), "n"))


# ---------------------------------------------------------------- feature table (ML1-2, PRJ8, PRJ11-13, FN8)

def _projects_table(spark: SparkSession, d: str) -> DataFrame:
    """projects written once when a query reads it along two paths (``CREATE TABLE projects``)."""
    from projectpulse.sources.readers import materialize
    return materialize(build.projects(spark, d), spark, "projects")


def _staged_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The staged extracts written once, for queries that read them beside projects."""
    from projectpulse.sources.readers import materialize
    return materialize(build.program(spark, d), spark, "program"), materialize(build.outcome(spark, d), spark, "outcome")


def _rates_table(spark: SparkSession, projects: DataFrame) -> DataFrame:
    """kpi_rates written once: the three bucket lookups read the few rows, not three aggregates."""
    from projectpulse.sources.readers import materialize
    return materialize(build.kpi_rates(projects), spark, "kpi-rates")


def _features(spark: SparkSession, d: str) -> DataFrame:
    # the feature table reads projects twice (KPI rates for the buckets, and the rows)
    p = _projects_table(spark, d)
    return build.model_features(p, _rates_table(spark, p))


@query("model_features", with_ctes(
    "SELECT upc, data_source, has_label, is_currently_active, project_type_bucketed, road_system_bucketed, "
    f"district_bucketed, allocated_budget, {r6('log_allocated_budget')}, at_risk FROM model_features",
    "model_features"))
def q_model_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_features(spark, d))


@query("qualifying_categories", with_ctes(
    "SELECT cut_type, cut_value, n_rated FROM kpi_rates WHERE cut_type <> 'overall' AND n_rated >= 30",
    "kpi_rates"))
def q_qualifying_categories(spark: SparkSession, d: str) -> DataFrame:
    rates = build.kpi_rates(build.projects(spark, d))
    return rates.where((F.col("cut_type") != "overall") & (F.col("n_rated") >= 30)).select(
        "cut_type", "cut_value", "n_rated")


@query("bucket_rare", with_ctes(
    "SELECT 'project_type' AS column_name, project_type_bucketed AS level, count(*) AS n FROM model_features GROUP BY 2 "
    "UNION ALL SELECT 'road_system', road_system_bucketed, count(*) FROM model_features GROUP BY 2 "
    "UNION ALL SELECT 'district', district_bucketed, count(*) FROM model_features GROUP BY 2", "model_features"))
def q_bucket_rare(spark: SparkSession, d: str) -> DataFrame:
    mf = _features(spark, d)
    return kpi.explode_cuts(mf, [("project_type", "project_type_bucketed"), ("road_system", "road_system_bucketed"),
                                 ("district", "district_bucketed")], [], overall=False).groupBy(
        F.col("cut_type").alias("column_name"), F.col("cut_value").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query("at_risk_label", with_ctes(
    "SELECT data_source, on_time_status, on_budget_status, at_risk, count(*) AS n FROM "
    "(SELECT p.data_source, p.on_time_status, p.on_budget_status, m.at_risk FROM projects p "
    "JOIN model_features m ON p.upc = m.upc) t GROUP BY ALL", "projects", "model_features"))
def q_at_risk_label(spark: SparkSession, d: str) -> DataFrame:
    from projectpulse.operators.features import at_risk_label
    p = build.projects(spark, d)
    lab = at_risk_label(F.col("data_source"), F.col("on_time_status"), F.col("on_budget_status"))
    return p.groupBy("data_source", "on_time_status", "on_budget_status", lab.alias("at_risk")).agg(
        F.count(F.lit(1)).alias("n"))


@query("log_budget", with_ctes(
    "SELECT count(*) AS n_rows, count(log_allocated_budget) AS n_log, "
    "count_if(allocated_budget = 0) AS n_zero, count_if(allocated_budget IS NULL) AS n_null, "
    f"{r6('sum(log_allocated_budget)', 'sum_log')} FROM model_features", "model_features"))
def q_log_budget(spark: SparkSession, d: str) -> DataFrame:
    mf = _features(spark, d)
    return rounded(mf.agg(F.count(F.lit(1)).alias("n_rows"), F.count("log_allocated_budget").alias("n_log"),
                          F.count_if(F.col("allocated_budget") == 0).alias("n_zero"),
                          F.count_if(F.col("allocated_budget").isNull()).alias("n_null"),
                          F.sum("log_allocated_budget").alias("sum_log")))


@query("active_rows", with_ctes(
    "SELECT upc, project_type_bucketed, road_system_bucketed, district_bucketed, allocated_budget, "
    f"{r6('log_allocated_budget')} FROM model_features WHERE is_currently_active", "model_features"))
def q_active_rows(spark: SparkSession, d: str) -> DataFrame:
    from projectpulse.operators.features import FEATURES, active_rows
    return rounded(active_rows(_features(spark, d)).select("upc", *FEATURES[:3], "allocated_budget", FEATURES[3]))


@query("training_rows", with_ctes(
    "SELECT upc, project_type_bucketed, road_system_bucketed, district_bucketed, "
    f"{r6('log_allocated_budget')}, at_risk FROM training", "training"))
def q_training_rows(spark: SparkSession, d: str) -> DataFrame:
    from projectpulse.operators.features import FEATURES, training_rows
    return rounded(training_rows(_features(spark, d)).select("upc", *FEATURES, "at_risk"))


@query("label_base_rate", with_ctes(
    "SELECT count(*) FILTER (WHERE has_label) AS n_labelled, count(at_risk) AS n_decided, "
    "count_if(has_label AND at_risk IS NULL) AS n_undecided, "
    f"{r6('avg(at_risk)', 'base_rate')} FROM model_features", "model_features"))
def q_label_base_rate(spark: SparkSession, d: str) -> DataFrame:
    mf = _features(spark, d)
    return rounded(mf.agg(F.count_if("has_label").alias("n_labelled"), F.count("at_risk").alias("n_decided"),
                          F.count_if(F.col("has_label") & F.col("at_risk").isNull()).alias("n_undecided"),
                          F.avg("at_risk").alias("base_rate")))


# ---------------------------------------------------------------- data quality (DQ1-20, SET2-4, AGG12-17, AGG20, AGG24)

from projectpulse.operators import quality as Q  # noqa: E402
from projectpulse.operators.cleaning import PROGRAM_SPEC, stage  # noqa: E402
from projectpulse.operators.quality import fmt_bound  # noqa: E402


def dq_sql(name: str, observed: str, bound: str, passed: str, frm: str) -> str:
    return (f"SELECT '{name}' AS rule, round(CAST({observed} AS DOUBLE), {PLACES}) AS observed, "
            f"'{bound}' AS bound, {passed} AS passed FROM {frm}")


def between_sql(x: str, lo, hi) -> str:
    conds = []
    if lo is not None:
        conds.append(f"{x} >= {lo!r}")
    if hi is not None:
        conds.append(f"{x} <= {hi!r}")
    return "(" + " AND ".join(conds) + ")" if conds else "true"


def agg_rule_sql(name: str, observed: str, lo, hi, frm: str, bound: str | None = None) -> str:
    return dq_sql(name, observed, bound or fmt_bound(lo, hi), between_sql(observed, lo, hi), frm)


def union_sql(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


ROW_BOUNDS = (1000, 1000000)


@query("dq_row_count", with_ctes(union_sql(
    agg_rule_sql("not_empty", "count(*)", 1, None, "projects"),
    agg_rule_sql("row_count", "count(*)", *ROW_BOUNDS, "projects")), "projects"))
def q_dq_row_count(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.expect(build.projects(spark, d), [Q.row_count(1, None, "not_empty"), Q.row_count(*ROW_BOUNDS)]))


# The columns and inputs that must be there.
REQUIRED_PROGRAM = ["UPC", "DISTRICT_CODE_DESC", "STATE_HIGHWAY_DESC", "SCOPE_OF_WORK_DESC", "POOL_PRJ_STATUS_DSC",
                    "HAS_PE", "HAS_RW", "HAS_CN", "PE_START_DATE", "CN_START_DATE", "CN_END_DATE",
                    "TOTAL_ALLOCATIONS_CURRENT", "Y1_Y6_ALLOCATIONS", "CURRENT_PE_ESTIMATE", "CURRENT_RW_ESTIMATE",
                    "CURRENT_CN_ESTIMATE", "TOTAL_EST_CURRENT"]
REQUIRED_OUTCOME = ["UPC", "DISTRICT", "PROJECT_STATUS", "BUDGET", "ESTIMATE", "ON_TIME_STATUS", "ON_BUDGET_STATUS"]
PROGRAM_INPUT, OUTCOME_INPUT = "program", "Project_Development (UPC)"
PAIR_INPUT, CONTRACT_INPUT = "Project_Delivery (Contract,UPC)", "Project_Delivery (Contract)"


def _required_sql(name: str, table: str, columns) -> str:
    return union_sql(*[f"SELECT '{name}' AS input_name, '{c}' AS column_name, true AS present, count({c}) AS n_non_null, "
                       f"true AS passed FROM {table}" for c in columns])


@query("dq_required_columns", with_ctes(union_sql(
    _required_sql(PROGRAM_INPUT, "raw_syip", REQUIRED_PROGRAM), _required_sql(OUTCOME_INPUT, "raw_dashboard", REQUIRED_OUTCOME)),
    "raw_syip", "raw_dashboard"))
def q_dq_required_columns(spark: SparkSession, d: str) -> DataFrame:
    return Q.required_columns(fixtures.raw_program(spark, d), REQUIRED_PROGRAM, PROGRAM_INPUT).unionByName(
        Q.required_columns(fixtures.raw_outcome(spark, d), REQUIRED_OUTCOME, OUTCOME_INPUT))


@query("src_named_inputs", with_ctes(union_sql(*[
    f"SELECT '{name}' AS input_name, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, true AS passed FROM {table}"
    for name, table, key in ((PROGRAM_INPUT, "raw_syip", "UPC"), (OUTCOME_INPUT, "raw_dashboard", "UPC"),
                             (PAIR_INPUT, "raw_contracts", "CONTRACT_ID"), (CONTRACT_INPUT, "contracts_distinct", "contract_id"))]),
    "raw_syip", "raw_dashboard", "raw_contracts", "contracts_distinct"))
def q_src_named_inputs(spark: SparkSession, d: str) -> DataFrame:
    """The four inputs landed under their names, read by name, registered, and queried with SQL: each is
    there, with rows."""
    from projectpulse.session import scratch_path
    pairs = fixtures.raw_contracts(spark, d)
    folders = R.land_inputs({PROGRAM_INPUT: fixtures.raw_program(spark, d), OUTCOME_INPUT: fixtures.raw_outcome(spark, d),
                             PAIR_INPUT: pairs, CONTRACT_INPUT: variance.dedup_first(pairs, "CONTRACT_ID", "UPC", drop=("UPC",))},
                            scratch_path(spark, "inputs"))
    parts = []
    for i, (name, key) in enumerate(((PROGRAM_INPUT, "UPC"), (OUTCOME_INPUT, "UPC"), (PAIR_INPUT, "CONTRACT_ID"), (CONTRACT_INPUT, "CONTRACT_ID"))):
        R.register(R.read_input(spark, folders, name), f"pp_input_{i}")
        parts.append(spark.sql(f"SELECT '{name}' AS input_name, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, "
                               f"count(*) > 0 AS passed FROM pp_input_{i}"))
    return reduce(DataFrame.unionByName, parts)


@query("dq_unique_key", with_ctes(union_sql(*[
    dq_sql(f"unique_key:{t}", "count(*) - count(DISTINCT upc)", "[0, 0]", "count(*) = count(DISTINCT upc)", t)
    for t in ("projects", "stg_syip", "stg_dashboard")]), "projects"))
def q_dq_unique_key(spark: SparkSession, d: str) -> DataFrame:
    program, outcome = _staged_tables(spark, d)
    projects = build.merge_with_provenance(program, outcome, "upc")
    return rounded(Q.union_results([Q.unique_key(projects, "upc", "unique_key:projects"),
                                    Q.unique_key(program, "upc", "unique_key:stg_syip"),
                                    Q.unique_key(outcome, "upc", "unique_key:stg_dashboard")]))


CASTS = [("TOTAL_ALLOCATIONS_CURRENT", "double"), ("TOTAL_EST_CURRENT", "double"), ("CURRENT_YEAR", "int"),
         ("HAS_PE", "boolean")]
SQL_TYPES = {"double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}


@query("dq_castable", with_ctes(union_sql(
    *[agg_rule_sql(f"castable_share:{c}:{t}",
                   f"avg(CASE WHEN {c} IS NOT NULL THEN CAST(TRY_CAST({c} AS {SQL_TYPES[t]}) IS NOT NULL AS INTEGER) END)",
                   1.0, None, "raw_syip") for c, t in CASTS],
    *[agg_rule_sql(f"non_null_share:{c}", f"avg(CAST({c} IS NOT NULL AS INTEGER))", 0.9, None, "raw_syip")
      for c in ("TOTAL_ALLOCATIONS_CURRENT", "TOTAL_EST_CURRENT")]), "raw_syip"))
def q_dq_castable(spark: SparkSession, d: str) -> DataFrame:
    rules = [Q.castable_share(c, t) for c, t in CASTS]
    rules += [Q.non_null_share(c, 0.9) for c in ("TOTAL_ALLOCATIONS_CURRENT", "TOTAL_EST_CURRENT")]
    return rounded(Q.expect(fixtures.raw_program(spark, d), rules))


@query("dq_null_rate", with_ctes(union_sql(
    agg_rule_sql("null_count:district", "count_if(district IS NULL)", 0, 0, "projects"),
    agg_rule_sql("null_count:road_system", "count_if(road_system IS NULL)", 0, 0, "projects"),
    agg_rule_sql("non_null_share:project_type", "avg(CAST(project_type IS NOT NULL AS INTEGER))", 0.99, None, "projects"),
    agg_rule_sql("non_null_share:allocated_budget", "avg(CAST(allocated_budget IS NOT NULL AS INTEGER))", 0.9, None,
                 "projects"),
    agg_rule_sql("non_null_share:current_estimate", "avg(CAST(current_estimate IS NOT NULL AS INTEGER))", 0.9, None,
                 "projects")), "projects"))
def q_dq_null_rate(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.expect(build.projects(spark, d), [
        Q.null_count("district"), Q.null_count("road_system"), Q.non_null_share("project_type", 0.99),
        Q.non_null_share("allocated_budget", 0.9), Q.non_null_share("current_estimate", 0.9)]))


RAW_PROGRAM_COLS = [c.src for c in PROGRAM_SPEC]
CONTRACT_ROW_COLS = ["contract_id", "district", "road_system", "original_completion_date", "current_completion_date",
                     "actual_completion_date", "award_amount", "current_amount", "final_cost", "on_time_status",
                     "on_budget_status"]


@query("dq_dup_rows", with_ctes(union_sql(
    dq_sql("duplicate_rows:program", "coalesce(sum(n - 1) / sum(n), 0.0)", fmt_bound(None, 0.01),
           "coalesce(sum(n - 1) / sum(n), 0.0) <= 0.01",
           f"(SELECT count(*) AS n FROM raw_syip GROUP BY {', '.join(RAW_PROGRAM_COLS)}) g"),
    dq_sql("duplicate_rows:contract_rows", "coalesce(sum(n - 1) / sum(n), 0.0)", fmt_bound(None, 1.0),
           "coalesce(sum(n - 1) / sum(n), 0.0) <= 1.0",
           f"(SELECT count(*) AS n FROM stg_contracts GROUP BY {', '.join(CONTRACT_ROW_COLS)}) g")),
    "raw_syip", "stg_contracts"))
def q_dq_dup_rows(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.union_results([
        Q.duplicate_row_share(fixtures.raw_program(spark, d), 0.01, "duplicate_rows:program"),
        Q.duplicate_row_share(build.contracts(spark, d).select(*CONTRACT_ROW_COLS), 1.0,
                              "duplicate_rows:contract_rows")]))


GYR = ["G", "Y", "R"]
SOURCES = ["both", "syip_only", "dashboard_only"]


def _domain_sql(table: str, col: str, allowed, exact: bool) -> str:
    lst = ", ".join(f"'{a}'" for a in allowed)
    extra = f"(SELECT count(*) FROM (SELECT DISTINCT {col} AS v FROM {table} WHERE {col} IS NOT NULL) s WHERE v NOT IN ({lst}))"
    obs = extra
    if exact:
        vals = ", ".join(f"('{a}')" for a in allowed)
        obs = (f"({extra} + (SELECT count(*) FROM (VALUES {vals}) a(v) "
               f"WHERE v NOT IN (SELECT {col} FROM {table} WHERE {col} IS NOT NULL)))")
    name = f"{'domain_equals' if exact else 'domain_subset'}:{col}"
    bound = "0 values outside {" + ",".join(allowed) + "}"
    return f"SELECT '{name}' AS rule, CAST({obs} AS DOUBLE) AS observed, '{bound}' AS bound, {obs} = 0 AS passed"


@query("dq_domain", with_ctes(union_sql(
    _domain_sql("stg_dashboard", "on_time_status", GYR, False),
    _domain_sql("stg_dashboard", "on_budget_status", GYR, False),
    _domain_sql("projects", "data_source", SOURCES, True)), "projects"))
def q_dq_domain(spark: SparkSession, d: str) -> DataFrame:
    o = build.outcome(spark, d)
    return rounded(Q.union_results([Q.domain(o, "on_time_status", GYR), Q.domain(o, "on_budget_status", GYR),
                                    Q.domain(build.projects(spark, d), "data_source", SOURCES, exact=True)]))


@query("dq_key_overlap", with_ctes(dq_sql(
    "key_overlap:upc", "count(*)", fmt_bound(100, None), "count(*) >= 100",
    "(SELECT upc FROM stg_syip INTERSECT SELECT upc FROM stg_dashboard) i"), "stg_syip", "stg_dashboard"))
def q_dq_key_overlap(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.key_overlap(build.program(spark, d), build.outcome(spark, d), "upc", 100))


@query("dq_partition_total", with_ctes(dq_sql(
    "partition_total:data_source", "abs(s - t)", "[0, 0]", "s = t",
    "(SELECT sum(n) AS s FROM (SELECT count(*) AS n FROM projects GROUP BY data_source) g) a, "
    "(SELECT count(*) AS t FROM projects) b"), "projects"))
def q_dq_partition_total(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.partition_total(build.projects(spark, d), "data_source"))


@query("dq_conditional_null", with_ctes(union_sql(
    agg_rule_sql("status_on_program_only",
                 "count_if(data_source = 'syip_only' AND (on_time_status IS NOT NULL OR on_budget_status IS NOT NULL))",
                 0, 0, "projects"),
    agg_rule_sql("reason_without_status",
                 "count_if(on_time_status IS NULL AND on_time_status_reason IS NOT NULL)", 0, 0, "projects")),
    "projects"))
def q_dq_conditional_null(spark: SparkSession, d: str) -> DataFrame:
    ds, ot, ob = F.col("data_source"), F.col("on_time_status"), F.col("on_budget_status")
    return rounded(Q.expect(build.projects(spark, d), [
        Q.conditional_count("status_on_program_only", (ds == "syip_only") & (ot.isNotNull() | ob.isNotNull())),
        Q.conditional_count("reason_without_status", ot.isNull() & F.col("on_time_status_reason").isNotNull())]))


RECONCILE = [("allocated_budget", "total_allocated"), ("district", "district"),
             ("current_estimate", "total_current_estimate")]


@query("dq_reconcile", with_ctes(union_sql(*[
    agg_rule_sql(f"reconcile:{m}", f"count_if(s.{sc} IS NOT NULL AND p.{m} <> s.{sc})", 0, 0,
                 "projects p JOIN stg_syip s ON p.upc = s.upc") for m, sc in RECONCILE]), "projects"))
def q_dq_reconcile(spark: SparkSession, d: str) -> DataFrame:
    # The program is staged once; both sides are written in buckets of the key and joined without a shuffle.
    program = co_located(build.program(spark, d), "upc", "program")
    merged = build.merge_with_provenance(program, build.outcome(spark, d), "upc").select("upc", *[m for m, _ in RECONCILE])
    return rounded(Q.reconcile(co_located(merged, "upc", "projects"), program, "upc", RECONCILE))


TOTAL_BOUNDS = (1e6, 1e13)


@query("dq_total_range", with_ctes(agg_rule_sql(
    "active_allocated_total",
    "coalesce(sum(CASE WHEN data_source IN ('both', 'syip_only') THEN allocated_budget END), 0.0)",
    *TOTAL_BOUNDS, "projects"), "projects"))
def q_dq_total_range(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.expect(build.projects(spark, d), [Q.filtered_total(
        "active_allocated_total", "allocated_budget", F.col("data_source").isin(list(kpi.ACTIVE)), *TOTAL_BOUNDS)]))


RATE_COLS = ["on_time_g_rate", "on_time_y_rate", "on_time_r_rate", "on_budget_g_rate", "on_budget_y_rate",
             "on_budget_r_rate"]


@query("dq_range", with_ctes(union_sql(
    *[dq_sql(f"out_of_range:{c}", f"count_if({c} IS NOT NULL AND NOT ({c} >= 0 AND {c} <= 1))",
             f"0 outside {fmt_bound(0, 1)}",
             f"count_if({c} IS NOT NULL AND NOT ({c} >= 0 AND {c} <= 1)) = 0", "kpi_rates") for c in RATE_COLS],
    agg_rule_sql("min:on_time_g_rate", "min(on_time_g_rate)", 0, 1, "kpi_rates"),
    agg_rule_sql("max:on_time_g_rate", "max(on_time_g_rate)", 0, 1, "kpi_rates")), "kpi_rates"))
def q_dq_range(spark: SparkSession, d: str) -> DataFrame:
    rates = build.kpi_rates(build.projects(spark, d))
    return rounded(Q.expect(rates, [Q.out_of_range(c, 0, 1) for c in RATE_COLS] + Q.min_max("on_time_g_rate", 0, 1)))


@query("dq_shares_sum", with_ctes(union_sql(*[
    dq_sql(f"shares_sum:{p}", f"count_if(abs({p}_g_rate + {p}_y_rate + {p}_r_rate - 1) > 1e-09)",
           "0 rows off by more than 1e-09", f"count_if(abs({p}_g_rate + {p}_y_rate + {p}_r_rate - 1) > 1e-09) = 0",
           "kpi_rates") for p in ("on_time", "on_budget")]), "kpi_rates"))
def q_dq_shares_sum(spark: SparkSession, d: str) -> DataFrame:
    rates = build.kpi_rates(build.projects(spark, d))
    return rounded(Q.expect(rates, [
        Q.shares_sum_to_one([f"{p}_{lv}_rate" for lv in "gyr"], 1e-9, f"shares_sum:{p}") for p in ("on_time", "on_budget")]))


@query("dq_kpi_n_matches", with_ctes(union_sql(
    dq_sql("kpi_rates_overall_n", "abs(a - b)", "[0, 0]", "a = b",
           "(SELECT n_rated AS a FROM kpi_rates WHERE cut_type = 'overall') x, (SELECT count(*) AS b FROM rated) y"),
    dq_sql("schedule_n_completed", "abs(a - b)", "[0, 0]", "a = b",
           "(SELECT count(schedule_variance_days_actual) AS a FROM contracts_distinct) x, "
           "(SELECT count(*) AS b FROM contracts_distinct WHERE schedule_variance_days_actual IS NOT NULL) y")),
    "kpi_rates", "contracts_distinct"))
def q_dq_kpi_n_matches(spark: SparkSession, d: str) -> DataFrame:
    p = _projects_table(spark, d)
    rates = build.kpi_rates(p)
    days = ["schedule_variance_days_actual", "schedule_variance_days_current"]
    cd = R.materialize(build.contracts_distinct(build.contracts(spark, d)).select(*days), spark, "contracts-distinct")
    return rounded(Q.union_results([
        Q.counts_match("kpi_rates_overall_n", rates.where(F.col("cut_type") == "overall"), "n_rated",
                       p.where(F.col("data_source").isin(list(kpi.RATED)))),
        Q.counts_match("schedule_n_completed", kpi.schedule_overall(cd), "n_completed",
                       cd.where(F.col("schedule_variance_days_actual").isNotNull()))]))


@query("dq_skew_guard", with_ctes(agg_rule_sql(
    "mean_minus_median:variance_pct", "max(avg(vp) - median(vp))", 0.5, None, "cost_base")
    .replace("max(avg(vp) - median(vp))", "(avg(vp) - median(vp))"), "cost_base"))
def q_dq_skew_guard(spark: SparkSession, d: str) -> DataFrame:
    share = F.try_divide(F.col("current_estimate") - F.col("allocated_budget"), F.col("allocated_budget"))
    base = build.projects(spark, d).where("current_estimate is not null and allocated_budget is not null").select(share.alias("vp"))
    stats = grouped_stats(base, [], [F.avg("vp").alias("mean")], {"median": "vp"})
    return rounded(Q.expect(stats, [Q.AggRule("mean_minus_median:variance_pct", F.max(F.col("mean") - F.col("median")), 0.5, None)]))


@query("small_groups", with_ctes(
    "SELECT cut_type, count_if(n_rated < 30) AS n_small, count_if(n_rated >= 30) AS n_large, "
    "count_if(n_rated < 30) > count_if(n_rated >= 30) AS mostly_small FROM kpi_rates WHERE cut_type <> 'overall' GROUP BY cut_type", "kpi_rates"))
def q_small_groups(spark: SparkSession, d: str) -> DataFrame:
    return Q.small_groups(build.kpi_rates(build.projects(spark, d)))


@query("named_small_groups", with_ctes(
    "SELECT cut_type, cut_value, n_rated, n_rated < 30 AS passed FROM kpi_rates "
    "WHERE cut_type = 'project_type' AND cut_value IN ('RARE', 'BUILDING')", "kpi_rates"))
def q_named_small_groups(spark: SparkSession, d: str) -> DataFrame:
    return Q.named_small_groups(build.kpi_rates(build.projects(spark, d)), [("project_type", "RARE"), ("project_type", "BUILDING")])


CONSISTENT_COLS = ["district", "road_system", "original_completion_date", "current_completion_date",
                   "actual_completion_date", "award_amount", "current_amount", "final_cost", "on_time_status",
                   "on_budget_status"]


@query("dq_consistent_within_key", with_ctes(dq_sql(
    "inconsistent_within:contract_id", "count_if(v > 1)", "[0, 0]", "count_if(v > 1) = 0",
    f"(SELECT contract_id, count(*) AS v FROM (SELECT DISTINCT contract_id, {', '.join(CONSISTENT_COLS)} "
    "FROM stg_contracts) t GROUP BY contract_id) g"), "stg_contracts"))
def q_dq_consistent_within_key(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.consistent_within_key(build.contracts(spark, d), "contract_id", CONSISTENT_COLS, fixtures.contract_tasks(spark, d)))


# ---------------------------------------------------------------- evaluation (WIN3-4, ML15-17, AGG22, DQ25)

from projectpulse.operators import evaluate as E  # noqa: E402


@query("stratified_folds", with_ctes("SELECT id, label, fold FROM folds", "folds"))
def q_stratified_folds(spark: SparkSession, d: str) -> DataFrame:
    return E.stratified_folds(fixtures.scored_orders(spark, d), "id", "label").select("id", "label", "fold")


@query("folds_with_nulls", with_ctes(
    "SELECT label, fold, count(*) AS n FROM (SELECT label, CAST((row_number() OVER (PARTITION BY label "
    "ORDER BY md5(CAST(id AS VARCHAR) || '-42') NULLS FIRST, id) - 1) % 5 AS INTEGER) AS fold FROM ("
    "SELECT CASE WHEN id % 7 <> 0 THEN id END AS id, CASE WHEN id % 11 <> 0 THEN label END AS label FROM scored) s) f "
    "GROUP BY label, fold", "scored"))
def q_folds_with_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Fold sizes where keys and labels are NULL in places: every row gets a fold."""
    s = fixtures.scored_orders(spark, d)
    s = s.select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"), F.when(F.col("id") % 11 != 0, F.col("label")).alias("label"))
    return E.stratified_folds(s, "id", "label").groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("roc_points", with_ctes(
    "SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
    f"{r6('tp / P', 'tpr')}, {r6('fp / N', 'fpr')} FROM ("
    "SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, "
    "sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM score_counts) t", "score_counts"))
def q_roc_points(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.roc_points(fixtures.scored_orders(spark, d)))


@query("roc_auc", with_ctes(
    f"SELECT {r6('sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg))', 'roc_auc')} FROM ("
    "SELECT score, pos, neg, coalesce(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0) AS above FROM score_counts) t", "score_counts"))
def q_roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.roc_auc(fixtures.scored_orders(spark, d)))


CM_SQL = ("SELECT tp, fp, fn, {p}, {r}, {f} FROM (SELECT *, "
          "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr, "
          "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc FROM ("
          "SELECT count_if(score > 0.5 AND label = 1) AS tp, count_if(score > 0.5 AND label = 0) AS fp, "
          "count_if(score <= 0.5 AND label = 1) AS fn FROM scored) c) m").format(
    p=r6("pr", "precision"), r=r6("rc", "recall"),
    f=r6("CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END", "f1"))


@query("classification_metrics", with_ctes(CM_SQL, "scored"))
def q_classification_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.classification_metrics(fixtures.scored_orders(spark, d)))


CV_SQL = """
SELECT {cols}, avg(roc_auc) > 0.65 AS beats_floor FROM (
  SELECT a.fold, a.roc_auc, m.pr AS precision, m.rc AS recall,
         CASE WHEN m.pr + m.rc > 0 THEN 2 * m.pr * m.rc / (m.pr + m.rc) ELSE 0.0 END AS f1
  FROM (SELECT fold, sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg)) AS roc_auc FROM (
          SELECT fold, score, pos, neg, coalesce(sum(pos) OVER (PARTITION BY fold ORDER BY score DESC
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
          FROM (SELECT fold, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg
                FROM folds GROUP BY fold, score) g) t GROUP BY fold) a
  JOIN (SELECT fold, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
               CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc
        FROM (SELECT fold, count_if(score > 0.5 AND label = 1) AS tp, count_if(score > 0.5 AND label = 0) AS fp,
                     count_if(score <= 0.5 AND label = 1) AS fn FROM folds GROUP BY fold) c) m ON a.fold = m.fold
) f""".format(cols=", ".join(r6(f"{fn}({m})", f"{m}_{sfx}") for m in ("roc_auc", "precision", "recall", "f1")
                             for fn, sfx in (("avg", "mean"), ("stddev_pop", "std"))))


@query("cv_summary", with_ctes(CV_SQL, "folds"))
def q_cv_summary(spark: SparkSession, d: str) -> DataFrame:
    folded = E.stratified_folds(fixtures.scored_orders(spark, d), "id", "label")
    s = E.cv_summary(E.fold_metrics(folded))
    return rounded(s.withColumn("beats_floor", F.col("roc_auc_mean") > 0.65))


# ---------------------------------------------------------------- preparation, scoring, explanation
# (ML3-7, ML19-28, SORT2-5, FN10-14, AGG18-19, AGG21, AGG23, AGG26, DQ21-24)

from projectpulse.operators import explain as X  # noqa: E402
from projectpulse.operators import features as FT  # noqa: E402
from projectpulse.operators import model as M  # noqa: E402


def _training(spark: SparkSession, d: str) -> DataFrame:
    return FT.training_rows(_features(spark, d))


def _features_table(spark: SparkSession, d: str, mf: DataFrame | None = None) -> DataFrame:
    """The feature table written once (``CREATE TABLE model_features``): fitting reads it
    several times, so the upstream joins run once and a lost executor re-reads files."""
    from projectpulse.sources.readers import materialize
    if mf is None:
        mf = _features(spark, d)
    return materialize(mf, spark, "model-features")


def _fixture_model(spark: SparkSession, d: str, mf: DataFrame | None = None):
    mf = _features_table(spark, d, mf)
    return X.univariate_model(FT.training_rows(mf)), mf


def _fixture_scores(spark: SparkSession, d: str) -> DataFrame:
    model, mf = _fixture_model(spark, d)
    return X.score_and_explain(FT.active_rows(mf), model)


@query("reference_levels", with_ctes("SELECT column_name, level, position FROM levels", "levels"))
def q_reference_levels(spark: SparkSession, d: str) -> DataFrame:
    return M.reference_levels(FT.training_rows(_features_table(spark, d)))


@query("onehot_features", with_ctes(
    "SELECT l.column_name || '=' || l.level AS feature, CAST(count(a.upc) AS DOUBLE) AS n_hot "
    "FROM levels l LEFT JOIN active_feat a ON "
    "(l.column_name = 'project_type_bucketed' AND a.project_type_bucketed = l.level) OR "
    "(l.column_name = 'road_system_bucketed' AND a.road_system_bucketed = l.level) OR "
    "(l.column_name = 'district_bucketed' AND a.district_bucketed = l.level) GROUP BY 1 "
    "UNION ALL SELECT 'unseen:' || c.column_name, CAST(count_if(NOT EXISTS (SELECT 1 FROM levels l "
    "WHERE l.column_name = c.column_name AND l.level = CASE c.column_name "
    "WHEN 'project_type_bucketed' THEN a.project_type_bucketed WHEN 'road_system_bucketed' THEN a.road_system_bucketed "
    "ELSE a.district_bucketed END)) AS DOUBLE) FROM active_feat a CROSS JOIN col_order c GROUP BY c.column_name",
    "levels", "active_feat", "col_order"))
def q_onehot_features(spark: SparkSession, d: str) -> DataFrame:
    """All-levels one-hot encoding of the active rows (unseen level = all zeros): hot counts per feature."""
    mf = _features_table(spark, d)
    prep = M.fit_prep(FT.training_rows(mf), drop_first=False)
    indexer = M.level_indexer(prep)
    encoded = indexer.transform(FT.active_rows(mf))
    hot = encoded.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(M.INDEX + c).cast("int").alias("number"))
                                            for c in indexer.sizes]))).groupBy("column_name", "number").agg(F.count(F.lit(1)).alias("n"))
    numbers = indexer.dictionary.select(F.concat("column_name", F.lit("="), "level").alias("feature"), "column_name", "number").unionByName(
        spark.createDataFrame([(f"unseen:{c}", c, n) for c, n in indexer.sizes.items()], "feature string, column_name string, number int"))
    return numbers.join(hot, ["column_name", "number"], "left").select("feature", F.coalesce("n", F.lit(0)).cast("double").alias("n_hot"))


@query("impute_indicator", with_ctes(
    "SELECT round(p.med, 6) AS median, p.has_ind AS has_indicator, "
    "(SELECT count_if(log_allocated_budget IS NULL) FROM training) AS n_missing_train, "
    "(SELECT count_if(mi = 1.0) FROM active_feat) AS n_imputed_active, "
    f"(SELECT {r6('sum(x)', 'x')} FROM active_feat) AS sum_imputed FROM num_prep p",
    "num_prep", "training", "active_feat").replace("round(sum(x), 6) AS x", "round(sum(x), 6)"))
def q_impute_indicator(spark: SparkSession, d: str) -> DataFrame:
    mf = _features_table(spark, d)
    train = FT.training_rows(mf)
    prep = M.fit_prep(train)
    x = F.coalesce(F.col("log_allocated_budget"), F.lit(prep.median).cast("double"))
    n_missing = train.agg(F.count_if(F.col("log_allocated_budget").isNull()).alias("n_missing_train"))
    act = FT.active_rows(mf).agg(F.count_if(F.col("log_allocated_budget").isNull()).alias("n_imputed_active"),
                                 F.sum(x).alias("sum_imputed"))
    out = Q.side_by_side(n_missing, act).select(
        F.lit(prep.median).cast("double").alias("median"), F.lit(prep.has_indicator).alias("has_indicator"),
        "n_missing_train", "n_imputed_active", "sum_imputed")
    return rounded(out)


@query("scale_numeric", with_ctes(
    f"SELECT {r6('s.mx', 'mean_x')}, {r6('s.sx', 'std_x')}, {r6('s.mm', 'mean_missing')}, "
    f"{r6('s.sm', 'std_missing')}, {r6('sum((a.x - s.mx) / s.sx)', 'sum_scaled_active')}, "
    f"{r6('sum((a.mi - s.mm) / s.sm)', 'sum_scaled_missing_active')} "
    "FROM active_feat a CROSS JOIN num_scale s GROUP BY s.mx, s.sx, s.mm, s.sm", "active_feat", "num_scale"))
def q_scale_numeric(spark: SparkSession, d: str) -> DataFrame:
    mf = _features_table(spark, d)
    prep = M.fit_prep(FT.training_rows(mf))
    num, *ind = M.numeric_exprs(prep)
    return rounded(FT.active_rows(mf).agg(
        F.lit(prep.mean_x).alias("mean_x"), F.lit(prep.std_x).alias("std_x"),
        F.lit(prep.mean_i).alias("mean_missing"), F.lit(prep.std_i).alias("std_missing"),
        F.sum(num).alias("sum_scaled_active"),
        (F.sum(ind[0]) if ind else F.lit(None).cast("double")).alias("sum_scaled_missing_active")))


@query("global_feature_table", with_ctes(
    f"SELECT feature, column_name, category, {r6('coef')}, {r6('odds_ratio')}, sentence FROM feature_table",
    "feature_table"))
def q_global_feature_table(spark: SparkSession, d: str) -> DataFrame:
    model, _ = _fixture_model(spark, d)
    t = X.global_feature_table(X.coefficient_table(spark, model))
    return rounded(t.select("feature", "column_name", "category", "coef", "odds_ratio", "sentence"))


@query("top_risk_factors", with_ctes(
    f"SELECT direction, CAST(rank AS INTEGER) AS rank, feature, {r6('coef')}, sentence FROM ("
    "SELECT CASE WHEN coef > 0 THEN 'increasing' ELSE 'decreasing' END AS direction, "
    "row_number() OVER (PARTITION BY coef > 0 ORDER BY abs(coef) DESC, idx) AS rank, feature, coef, sentence "
    "FROM feature_table WHERE coef <> 0) t WHERE rank <= 5", "feature_table"))
def q_top_risk_factors(spark: SparkSession, d: str) -> DataFrame:
    model, _ = _fixture_model(spark, d)
    return rounded(X.top_risk_factors(X.global_feature_table(X.coefficient_table(spark, model))))


@query("score_fixed", with_ctes(
    f"SELECT upc, {r6('risk_probability')}, risk_score, allocated_budget, elevated_risk FROM risk_scores",
    "risk_scores"))
def q_score_fixed(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_fixture_scores(spark, d).select("upc", "risk_probability", "risk_score", "allocated_budget",
                                                     "elevated_risk"))


@query("explain_rows", with_ctes("SELECT upc, top_factors FROM risk_scores", "risk_scores"))
def q_explain_rows(spark: SparkSession, d: str) -> DataFrame:
    return _fixture_scores(spark, d).select("upc", "top_factors")


@query("elevated_summary", with_ctes(
    "SELECT count(*) AS n_scored, count_if(elevated_risk) AS n_elevated, "
    f"{r6('avg(CAST(elevated_risk AS INTEGER))', 'share_elevated')}, "
    f"{r6('coalesce(sum(CASE WHEN elevated_risk THEN allocated_budget END), 0.0)', 'dollars_elevated')} "
    "FROM risk_scores", "risk_scores"))
def q_elevated_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.elevated_summary(_fixture_scores(spark, d)))


@query("score_distribution", with_ctes(
    "SELECT min(risk_score) AS min_score, round(median(risk_score), 6) AS median_score, max(risk_score) AS max_score, "
    "round(quantile_cont(risk_score, 0.75), 6) AS p75_score FROM risk_scores", "risk_scores"))
def q_score_distribution(spark: SparkSession, d: str) -> DataFrame:
    # risk_score is an integer in [0, 100]: the exact percentile buffers hold at most
    # 101 distinct values per task, whatever the row count.
    s = _fixture_scores(spark, d)
    return rounded(s.agg(F.min("risk_score").alias("min_score"), F.median("risk_score").alias("median_score"),
                         F.max("risk_score").alias("max_score"),
                         F.percentile("risk_score", 0.75).alias("p75_score")))


@query("top_scored", with_ctes(
    f"SELECT upc, {r6('risk_probability')}, risk_score, top_factors FROM risk_scores "
    "ORDER BY risk_score DESC, risk_probability DESC, upc LIMIT 5", "risk_scores"))
def q_top_scored(spark: SparkSession, d: str) -> DataFrame:
    s = _fixture_scores(spark, d)
    return rounded(s.orderBy(F.col("risk_score").desc(), F.col("risk_probability").desc(), F.col("upc"))
                   .limit(5).select("upc", "risk_probability", "risk_score", "top_factors"))


@query("missing_driver_share", with_ctes(
    "SELECT count(*) AS n_scored, count_if(contains(top_factors, 'log_allocated_budget_missing')) AS n_missing_driver, "
    f"{r6('avg(CAST(contains(top_factors, ' + chr(39) + 'log_allocated_budget_missing' + chr(39) + ') AS INTEGER))', 'share')} "
    "FROM risk_scores", "risk_scores"))
def q_missing_driver_share(spark: SparkSession, d: str) -> DataFrame:
    s = _fixture_scores(spark, d)
    hit = F.col("top_factors").contains("log_allocated_budget_missing")
    return rounded(s.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(hit).alias("n_missing_driver"),
                         F.avg(hit.cast("int")).alias("share")))


@query("coef_rate_corr", with_ctes(
    f"SELECT count(*) AS n_joined, {r6('corr(c.coef, (k.on_time_r_rate + k.on_budget_r_rate) / 2)', 'correlation')}, "
    "corr(c.coef, (k.on_time_r_rate + k.on_budget_r_rate) / 2) > 0.5 AS passed "
    "FROM coefs c JOIN kpi_rates k ON k.cut_type = 'project_type' AND k.cut_value = c.category "
    "WHERE c.column_name = 'project_type_bucketed'", "coefs", "kpi_rates"))
def q_coef_rate_corr(spark: SparkSession, d: str) -> DataFrame:
    p = _projects_table(spark, d)
    rates = _rates_table(spark, p)
    model, _ = _fixture_model(spark, d, build.model_features(p, rates))
    coefs = X.coefficient_table(spark, model).where(F.col("column_name") == "project_type_bucketed")
    r = rates.where(F.col("cut_type") == "project_type").select(
        F.col("cut_value").alias("category"),
        ((F.col("on_time_r_rate") + F.col("on_budget_r_rate")) / 2).alias("avg_r_rate"))
    j = coefs.join(r, "category")
    return rounded(j.agg(F.count(F.lit(1)).alias("n_joined"), F.corr("coef", "avg_r_rate").alias("correlation"))
                   .withColumn("passed", F.col("correlation") > 0.5))


@query("coef_directions", with_ctes(
    "SELECT column_name, category, CAST(sign(coef) AS INTEGER) AS direction FROM coefs WHERE category IS NOT NULL", "coefs"))
def q_coef_directions(spark: SparkSession, d: str) -> DataFrame:
    """Which way each category points against its reference level (sign anchors)."""
    model, _ = _fixture_model(spark, d)
    return (X.coefficient_table(spark, model).where(F.col("category").isNotNull())
            .select("column_name", "category", F.signum("coef").cast("int").alias("direction")))


@query("dq_nonempty_text", with_ctes(agg_rule_sql(
    "empty_text:top_factors", "count_if(top_factors IS NULL OR trim(top_factors) = '')", 0, 0, "risk_scores"),
    "risk_scores"))
def q_dq_nonempty_text(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.expect(_fixture_scores(spark, d), [Q.nonempty_text("top_factors")]))


@query("dq_flag_consistency", with_ctes(union_sql(
    agg_rule_sql("flag_mismatch:elevated_risk", "count_if(elevated_risk <> (risk_score >= 60))", 0, 0, "risk_scores"),
    agg_rule_sql("min:risk_score", "min(risk_score)", 0, 100, "risk_scores"),
    agg_rule_sql("max:risk_score", "max(risk_score)", 0, 100, "risk_scores"),
    agg_rule_sql("min:risk_probability", "min(risk_probability)", 0.0, 1.0, "risk_scores"),
    agg_rule_sql("max:risk_probability", "max(risk_probability)", 0.0, 1.0, "risk_scores"),
    dq_sql("scored_equals_active", "abs(a - b)", "[0, 0]", "a = b",
           "(SELECT count(*) AS a FROM risk_scores) x, (SELECT count(*) AS b FROM model_features "
           "WHERE is_currently_active) y")), "risk_scores"))
def q_dq_flag_consistency(spark: SparkSession, d: str) -> DataFrame:
    model, mf = _fixture_model(spark, d)
    active = FT.active_rows(mf)
    s = X.score_and_explain(active, model)
    rules = [Q.flag_matches_rule("elevated_risk", F.col("risk_score") >= X.ELEVATED_AT)]
    rules += Q.min_max("risk_score", 0, 100) + Q.min_max("risk_probability", 0.0, 1.0)
    parity = Q.counts_match("scored_equals_active", s.agg(F.count(F.lit(1)).alias("n")), "n", active)
    return rounded(Q.union_results([Q.expect(s, rules), parity]))


# ---------------------------------------------------------------- Spark ML training (ML8-18, SRC9)

def _trained(spark: SparkSession, d: str):
    mf = _features_table(spark, d)
    return M.train_logistic(FT.training_rows(mf)), mf


FITTED_FEATURES = ("SELECT l.column_name || '=' || l.level AS feature, true AS at_optimum FROM levels l WHERE l.position > 0 "
                   "UNION ALL SELECT 'log_allocated_budget', true "
                   "UNION ALL SELECT 'log_allocated_budget_missing', true FROM num_prep WHERE has_ind")


@query("train_logistic", with_ctes(FITTED_FEATURES, "levels", "num_prep"))
def q_train_logistic(spark: SparkSession, d: str) -> DataFrame:
    """Final model: preparation with first level dropped + logistic regression on all training
    rows.  Its features, and whether the gradient of the penalised loss, computed from the
    rows, vanishes there (within 1e-6 of the number of rows)."""
    model, mf = _trained(spark, d)
    gradient = M.loss_gradient(FT.training_rows(mf), model)
    return gradient.select("feature", (F.abs("gradient") <= F.lit(1e-6) * F.col("n_rows")).alias("at_optimum"))


@query("score_trained", with_ctes("SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_differ FROM active_feat", "active_feat"))
def q_score_trained(spark: SparkSession, d: str) -> DataFrame:
    """Every active project scored by the model that was saved and loaded again: how many rows,
    and how many where the exact scoring with explanations gives another probability."""
    from projectpulse.session import scratch_path
    model, mf = _trained(spark, d)
    loaded = M.load_pipeline(M.save_model(model, scratch_path(spark, "risk-model")))
    active = FT.active_rows(mf)
    exact = X.score_and_explain(active, model).select("upc", "risk_probability")
    again = loaded.transform(M.with_label(active))
    again = again.select("upc", M.positive_probability(again).alias("p"))
    j = exact.join(again, "upc", "full_outer")
    off = F.coalesce(F.abs(F.col("risk_probability") - F.col("p")) > 1e-9, F.lit(True))
    return j.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(off).alias("n_differ"))


OOF_FOLDS = ("SELECT upc, CAST((row_number() OVER (PARTITION BY at_risk ORDER BY md5(CAST(upc AS VARCHAR) || '-42'), upc) - 1) % 5 "
             "AS INTEGER) AS fold, at_risk AS label")


@query("oof_scores", with_ctes(OOF_FOLDS + ", true AS is_probability FROM training", "training"))
def q_oof_scores(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold logistic-regression probabilities for every training row (5 folds)."""
    train = FT.training_rows(_features_table(spark, d))
    oof = M.cross_validate(train, ["logistic_regression"])
    return oof.select("upc", "fold", "label", ((F.col("score") > 0) & (F.col("score") < 1)).alias("is_probability"))


COMPARED = ["logistic_regression", "decision_tree", "random_forest", "gradient_boosting"]
FINAL = "final_logistic_regression"


def _candidates(names) -> list[M.Candidate]:
    """The named candidates, with all levels, and the final model, without the first."""
    return [*(M.Candidate(n, n) for n in names), M.Candidate(FINAL, "logistic_regression", drop_first=True)]


def _compared_scores(spark: SparkSession, d: str) -> DataFrame:
    from projectpulse.sources.readers import materialize
    train = FT.training_rows(_features_table(spark, d))
    return materialize(M.cross_validate_all(train, _candidates(COMPARED)), spark, "oof-scores")


def model_comparison(oof: DataFrame) -> DataFrame:
    """Per model of out-of-fold scores (model, fold, label, score): mean and deviation of each metric over the
    folds, the pooled AUC, and whether the mean AUC beats the floor."""
    summary = E.cv_summary(E.fold_metrics(oof, by=["model"]), by=["model"])
    pooled = E.roc_auc(oof, by=["model"]).withColumnRenamed("roc_auc", "pooled_roc_auc")
    return summary.join(pooled, "model").withColumn("beats_floor", F.col("roc_auc_mean") > 0.65)


@query("model_comparison")
def q_model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """The model comparison table of the fitted models; ``compare_models`` holds what SQL can check of it."""
    return model_comparison(_compared_scores(spark, d))


@query("trained_features")
def q_trained_features(spark: SparkSession, d: str) -> DataFrame:
    """The global feature table of the final model; ``train_logistic`` holds its check."""
    model, _ = _trained(spark, d)
    return X.global_feature_table(X.coefficient_table(spark, model)).drop("idx")


@query("trained_risk_scores")
def q_trained_risk_scores(spark: SparkSession, d: str) -> DataFrame:
    """risk_scores: every active project scored by the final model with its explanation; ``score_trained``
    holds its check."""
    model, mf = _trained(spark, d)
    return X.score_and_explain(FT.active_rows(mf), model)


@query("model_floor", with_ctes(
    "SELECT m.model, count(DISTINCT t.fold) AS n_folds, true AS beats_floor "
    f"FROM ({OOF_FOLDS} FROM training) t CROSS JOIN (VALUES ('logistic_regression'), ('{FINAL}')) m(model) GROUP BY m.model", "training"))
def q_model_floor(spark: SparkSession, d: str) -> DataFrame:
    """The floor on the trained models: whether the mean out-of-fold AUC of the candidate and of the final logistic
    regression, as fitted here, exceeds 0.65.  The flag comes from the fitted models' scores."""
    train = FT.training_rows(_features_table(spark, d))
    oof = R.materialize(M.cross_validate_all(train, _candidates(COMPARED[:1])), spark, "oof-scores")
    folds = oof.groupBy("model").agg(F.count_distinct("fold").alias("n_folds"))
    return model_comparison(oof).select("model", "beats_floor").join(folds, "model").select("model", "n_folds", "beats_floor")


@query("tree_models", with_ctes(
    "SELECT 'decision_tree' AS model, 1 AS n_trees, true AS depth_within, count(*) AS n_rows, CAST(sum(at_risk) AS BIGINT) AS n_positive, "
    "CAST(0 AS BIGINT) AS n_leaves_off, true AS within_leaf_bound FROM training "
    "UNION ALL SELECT m, n, true, count(*), CAST(sum(at_risk) AS BIGINT), NULL, true FROM training "
    "CROSS JOIN (VALUES ('random_forest', 300), ('gradient_boosting', 100)) v(m, n) GROUP BY m, n", "training"))
def q_tree_models(spark: SparkSession, d: str) -> DataFrame:
    """The tree models fitted on all training rows: number of trees, whether all keep to their depth and to the leaves
    that it allows, and the rows and positives that they score.  Of the single tree every leaf is checked on the rows
    themselves: its probability must be the share of positives among the rows that fall into it."""
    train = FT.training_rows(_features_table(spark, d))
    prep = M.fit_prep(train, drop_first=False)
    estimators = M.candidate_estimators(prep.n_rows)
    rows, by_cell = M.vectors_of(M.with_label(train), prep, ["label"], train, estimators)
    its_cells = M.cells(rows) if by_cell else None
    parts = []
    for name, estimator in estimators.items():
        if name == "logistic_regression":
            continue
        fitted = M.fit_classifier(estimator, rows, its_cells if name in by_cell else None)
        trees = [fitted] if name == "decision_tree" else fitted.trees
        deepest = estimator.getMaxDepth()
        scored = fitted.transform(rows)
        p = M.positive_probability(scored)
        per_leaf = scored.groupBy(p.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
        off = F.count_if(F.abs(F.col("pos") / F.col("n") - F.col("p")) > 1e-9)
        parts.append(per_leaf.agg(F.sum("n").alias("n_rows"), F.sum("pos").cast("bigint").alias("n_positive"),
                                  (off if name == "decision_tree" else F.max(F.lit(None).cast("bigint"))).alias("n_leaves_off")).select(
            F.lit(name).alias("model"), F.lit(len(trees)).alias("n_trees"), F.lit(all(t.depth <= deepest for t in trees)).alias("depth_within"),
            "n_rows", "n_positive", "n_leaves_off",
            F.lit(all((t.numNodes + 1) // 2 <= 2 ** deepest for t in trees)).alias("within_leaf_bound")))
    return reduce(DataFrame.unionByName, parts)


@query("compare_models", with_ctes(
    "SELECT m.model, count(*) AS n_rows, count(DISTINCT fold) AS n_folds, CAST(sum(label) AS BIGINT) AS n_positive, "
    "true AS metrics_in_range, true AS curve_complete, true AS pooled_auc_in_range "
    f"FROM ({OOF_FOLDS} FROM training) t CROSS JOIN (VALUES {', '.join(f'({chr(39)}{m}{chr(39)})' for m in [*COMPARED, FINAL])}) m(model) "
    "GROUP BY m.model", "training"))
def q_compare_models(spark: SparkSession, d: str) -> DataFrame:
    """The four candidates (all levels one-hot) and the final drop-first logistic regression over 5
    stratified folds.  Out-of-fold scores are written once; per model: rows, folds and
    positives, whether the mean metrics lie in [0, 1], whether the pooled ROC curve ends at (1, 1), and
    whether the pooled AUC lies in [0, 1]."""
    oof = _compared_scores(spark, d)
    summary = E.cv_summary(E.fold_metrics(oof, by=["model"]), by=["model"])
    means = [F.col(f"{m}_mean") for m in ("roc_auc", "precision", "recall", "f1")]
    summary = summary.select("model", reduce(lambda a, b: a & b, [m.between(0, 1) for m in means]).alias("metrics_in_range"))
    counts = oof.groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("fold").alias("n_folds"),
                                      F.sum("label").cast("bigint").alias("n_positive"))
    pooled = E.roc_points(oof, by=["model"]).groupBy("model").agg(
        ((F.max("tpr") == 1) & (F.max("fpr") == 1)).alias("curve_complete"))
    auc = E.roc_auc(oof, by=["model"]).select("model", F.col("roc_auc").between(0, 1).alias("pooled_auc_in_range"))
    return counts.join(summary, "model").join(pooled, "model").join(auc, "model")


# ---------------------------------------------------------------- sources and sinks (SRC1-8)

from projectpulse.sources import readers as R  # noqa: E402

DESCRIPTION_SQL = ("'Order ' || CAST(abs(upc) AS VARCHAR) || ', priority \"' || road_system || '\"' "
                   "|| chr(10) || 'second line, ' || project_status")


@query("src_csv", with_ctes(
    "SELECT *, length(" + DESCRIPTION_SQL + ") AS description_chars FROM stg_syip", "stg_syip"))
def q_src_csv(spark: SparkSession, d: str) -> DataFrame:
    """Land the program extract as a headed CSV (free text with quoted commas, quotes and
    line breaks), read it back with an explicit all-string schema, then stage it."""
    from projectpulse.functions.scalar import trim_chars
    from projectpulse.operators.cleaning import ColumnSpec
    from projectpulse.session import scratch_path
    raw = fixtures.raw_program(spark, d)
    description = F.concat(F.lit("Order "), F.abs(F.col("UPC")).cast("string"), F.lit(', priority "'),
                           trim_chars("STATE_HIGHWAY_DESC"), F.lit('"\n'), F.lit("second line, "),
                           F.col("POOL_PRJ_STATUS_DSC"))
    raw = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns], description.alias("DESCRIPTION"))
    path = scratch_path(spark, "program-csv")
    raw.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    back = R.read_csv(spark, path, R.string_schema(raw.columns), multi_line=True)
    spec = [s if s.src != "UPC" else ColumnSpec("UPC", "upc", "bigint") for s in PROGRAM_SPEC]
    staged = stage(back, spec + [ColumnSpec("DESCRIPTION", "description", "keep")])
    return (staged.withColumn("description_chars", F.length("description").cast("bigint"))
            .drop("description"))


@query("sink_roundtrip", with_ctes(
    "SELECT cut_type, cut_value, n_rated, " + ", ".join(r6(c) for c in RATE_COLS) + " FROM kpi_rates",
    "kpi_rates"))
def q_sink_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """KPI rates written with overwrite as Parquet (table sink) and as a one-file CSV
    metrics table; the CSV is read back with an explicit schema."""
    from pyspark.sql import types as T2
    from projectpulse.session import scratch_path
    rates = build.kpi_rates(build.projects(spark, d))
    pq = R.write_table(rates, scratch_path(spark, "kpi-rates"))
    csv_path = R.write_csv(spark.read.parquet(pq), scratch_path(spark, "kpi-rates-csv"))
    schema = T2.StructType([T2.StructField("cut_type", T2.StringType()), T2.StructField("cut_value", T2.StringType()),
                            T2.StructField("n_rated", T2.LongType())]
                           + [T2.StructField(c, T2.DoubleType()) for c in RATE_COLS])
    return rounded(R.read_csv(spark, csv_path, schema, null_tokens=[]))


@query("table_counts", with_ctes(union_sql(*[
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in
    ("stg_syip", "stg_dashboard", "projects", "stg_contracts", "contracts_distinct", "kpi_rates", "model_features")]),
    "projects", "contracts_distinct", "model_features"))
def q_table_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tables that later ones read are counted on their writes, contracts and distinct contracts by one aggregate,
    the others by counts that read no more than their joins need."""
    counts = []

    def put(name: str, df: DataFrame) -> DataFrame:
        out, rows = build.measured(df, name, [Q.row_count(name=name)])
        counts.append(rows.select(F.col("rule").alias("table_name"), F.col("observed").cast("bigint").alias("n_rows")))
        return out
    p = put("projects", build.projects(spark, d))
    rates = put("kpi_rates", build.kpi_rates(p))
    per_contract = build.contracts(spark, d).groupBy("contract_id").agg(F.count(F.lit(1)).alias("n"))
    counts.append(per_contract.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("contracts")).select(F.inline(F.array(
        F.struct(F.lit("stg_contracts").alias("table_name"), F.coalesce("rows", F.lit(0)).alias("n_rows")),
        F.struct(F.lit("contracts_distinct").alias("table_name"), F.col("contracts").alias("n_rows"))))))
    counts.append(R.table_counts({"stg_syip": build.program(spark, d), "stg_dashboard": build.outcome(spark, d),
                                  "model_features": build.model_features(p, rates)}))
    return reduce(DataFrame.unionByName, counts)


# ---------------------------------------------------------------- rules measured on the writes of the build (DQ1-9, DQ13-17)

def _build_rules() -> dict[str, list]:
    """table -> rules that are measured while the table is written."""
    def shared(key: str) -> list:
        return [Q.row_count(1, None, "not_empty"), Q.null_count(key)]
    ds, ot, ob = F.col("data_source"), F.col("on_time_status"), F.col("on_budget_status")
    projects = [Q.row_count(*ROW_BOUNDS), Q.null_count("district"), Q.non_null_share("project_type", 0.99),
                Q.non_null_share("allocated_budget", 0.9), Q.non_null_share("current_estimate", 0.9),
                Q.conditional_count("status_on_program_only", (ds == "syip_only") & (ot.isNotNull() | ob.isNotNull())),
                Q.filtered_total("active_allocated_total", "allocated_budget", ds.isin(list(kpi.ACTIVE)), *TOTAL_BOUNDS)]
    rates = [Q.out_of_range(c, 0, 1) for c in RATE_COLS]
    rates += [Q.shares_sum_to_one([f"{p}_{lv}_rate" for lv in "gyr"], 1e-9, f"shares_sum:{p}") for p in ("on_time", "on_budget")]
    return {"stg_syip": shared("upc"), "stg_dashboard": shared("upc"), "projects": shared("upc") + projects,
            "kpi_rates": rates + Q.min_max("on_time_g_rate", 0, 1)}


def _in_table(table: str, *rules: str) -> str:
    return f"SELECT '{table}' AS table_name, rule, observed, bound, passed FROM ({union_sql(*rules)}) {table}_rules"


def _key_rules_sql(table: str) -> list[str]:
    return [agg_rule_sql("not_empty", "count(*)", 1, None, table), agg_rule_sql("null_count:upc", "count_if(upc IS NULL)", 0, 0, table)]


@query("dq_build_report", with_ctes(union_sql(
    _in_table("stg_syip", *_key_rules_sql("stg_syip")), _in_table("stg_dashboard", *_key_rules_sql("stg_dashboard")),
    _in_table("projects", *_key_rules_sql("projects"), agg_rule_sql("row_count", "count(*)", *ROW_BOUNDS, "projects"),
              agg_rule_sql("null_count:district", "count_if(district IS NULL)", 0, 0, "projects"),
              *[agg_rule_sql(f"non_null_share:{c}", f"avg(CAST({c} IS NOT NULL AS INTEGER))", share, None, "projects")
                for c, share in (("project_type", 0.99), ("allocated_budget", 0.9), ("current_estimate", 0.9))],
              agg_rule_sql("status_on_program_only", "count_if(data_source = 'syip_only' AND (on_time_status IS NOT NULL "
                           "OR on_budget_status IS NOT NULL))", 0, 0, "projects"),
              agg_rule_sql("active_allocated_total", "coalesce(sum(CASE WHEN data_source IN ('both', 'syip_only') THEN allocated_budget END), 0.0)",
                           *TOTAL_BOUNDS, "projects")),
    _in_table("kpi_rates", *[agg_rule_sql(f"out_of_range:{c}", f"count_if({c} IS NOT NULL AND NOT ({c} >= 0 AND {c} <= 1))", 0, 0, "kpi_rates",
                                          f"0 outside {fmt_bound(0, 1)}") for c in RATE_COLS],
              *[agg_rule_sql(f"shares_sum:{p}", f"count_if(abs({p}_g_rate + {p}_y_rate + {p}_r_rate - 1) > 1e-09)", 0, 0, "kpi_rates",
                             "0 rows off by more than 1e-09") for p in ("on_time", "on_budget")],
              agg_rule_sql("min:on_time_g_rate", "min(on_time_g_rate)", 0, 1, "kpi_rates"),
              agg_rule_sql("max:on_time_g_rate", "max(on_time_g_rate)", 0, 1, "kpi_rates"))), "projects", "kpi_rates"))
def q_dq_build_report(spark: SparkSession, d: str) -> DataFrame:
    """The rules of each table, measured as metrics of the write that builds it: no pass of their own."""
    rules, results = _build_rules(), []

    def put(name: str, df: DataFrame) -> DataFrame:
        out, rows = build.measured(df, name, rules[name])
        results.append(rows.withColumn("table_name", F.lit(name)))
        return out
    p = put("projects", build.merge_with_provenance(put("stg_syip", build.program(spark, d)), put("stg_dashboard", build.outcome(spark, d)), "upc"))
    put("kpi_rates", build.kpi_rates(p))
    return rounded(reduce(DataFrame.unionByName, results).select("table_name", "rule", "observed", "bound", "passed"))
