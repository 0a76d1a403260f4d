"""Staging: rename + trim + cast driven by a column-spec list.

``stage(df, spec)`` is one ``select``; strict mode fails the job on malformed text
(under any session setting), lenient mode yields NULL and
``reject_report`` counts what a lenient run turned into NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectpulse.functions.scalar import SOURCE_TS_FORMAT, TRIM_CHARS


@dataclass(frozen=True)
class ColumnSpec:
    src: str
    dst: str
    kind: str  # keep | text | bool | double | int | bigint | date | ts_text_date
    fmt: str | None = None


def _expr(s: ColumnSpec, lenient: bool) -> str:
    """The column as SQL text: one call to the JVM each, where nested column functions would make dozens."""
    c = "`" + s.src.replace("`", "``") + "`"
    text = f"trim(BOTH '{TRIM_CHARS}' FROM {c})"
    if s.kind == "keep":
        return c
    if s.kind == "text":
        return text
    if s.kind in ("bool", "double", "int", "bigint", "date"):
        kind = {"bool": "boolean"}.get(s.kind, s.kind)
        out = f"try_cast({c} AS {kind})"
    elif s.kind == "ts_text_date":
        kind, out = "date", f"CAST(try_to_timestamp({text}, '{s.fmt or SOURCE_TS_FORMAT}') AS date)"
    else:
        raise ValueError(f"unknown column kind {s.kind!r}")
    if lenient:
        return out
    # Strict whatever the session's ANSI setting: a value that does not convert is an error.
    told = s.src.replace("\\", "\\\\").replace("'", "\\'") + f" is not a {kind}: "
    return (f"CASE WHEN {c} IS NOT NULL AND {out} IS NULL THEN CAST(raise_error(concat('{told}', CAST({c} AS string))) AS {kind}) "
            f"ELSE {out} END")


def stage(df: DataFrame, spec, lenient: bool = False) -> DataFrame:
    """Project ``df`` through ``spec``: one narrow select, no shuffle."""
    return df.select([F.expr(_expr(s, lenient)).alias(s.dst) for s in spec])


def reject_report(df: DataFrame, spec) -> DataFrame:
    """Per staged column: how many non-NULL source values a lenient cast turns into NULL."""
    checks = [s for s in spec if s.kind not in ("keep", "text")]
    aggs = [F.count_if(F.col(s.src).isNotNull() & F.expr(_expr(s, True)).isNull()).alias(s.dst) for s in checks]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(s.dst).alias("column"), F.col(s.dst).alias("n_rejected")) for s in checks])))


# Source column → staged column maps of the three extracts.
PROGRAM_SPEC = [
    ColumnSpec("UPC", "upc", "keep"),
    ColumnSpec("DISTRICT_CODE_DESC", "district", "text"),
    ColumnSpec("STATE_HIGHWAY_DESC", "road_system", "text"),
    ColumnSpec("SCOPE_OF_WORK_DESC", "project_type", "text"),
    ColumnSpec("POOL_PRJ_STATUS_DSC", "project_status", "text"),
    ColumnSpec("HAS_PE", "has_pe", "bool"),
    ColumnSpec("HAS_RW", "has_rw", "bool"),
    ColumnSpec("HAS_CN", "has_cn", "bool"),
    ColumnSpec("PE_START_DATE", "pe_start_date", "ts_text_date"),
    ColumnSpec("RW_START_DATE", "rw_start_date", "ts_text_date"),
    ColumnSpec("CN_START_DATE", "cn_start_date", "ts_text_date"),
    ColumnSpec("CN_END_DATE", "cn_end_date", "ts_text_date"),
    ColumnSpec("TOTAL_ALLOCATIONS_CURRENT", "total_allocated", "double"),
    ColumnSpec("Y1_Y6_ALLOCATIONS", "y1_y6_allocated", "double"),
    ColumnSpec("CURRENT_PE_ESTIMATE", "current_pe_estimate", "double"),
    ColumnSpec("CURRENT_RW_ESTIMATE", "current_rw_estimate", "double"),
    ColumnSpec("CURRENT_CN_ESTIMATE", "current_cn_estimate", "double"),
    ColumnSpec("TOTAL_EST_CURRENT", "total_current_estimate", "double"),
    ColumnSpec("CURRENT_YEAR", "syip_vintage_year", "int"),
]

OUTCOME_SPEC = [
    ColumnSpec("UPC", "upc", "keep"),
    ColumnSpec("DISTRICT", "district", "text"),
    ColumnSpec("ROAD_SYSTEM", "road_system", "text"),
    ColumnSpec("SCOPE_OF_WORK", "project_type", "text"),
    ColumnSpec("PROJECT_STATUS", "project_status", "text"),
    ColumnSpec("BUDGET", "budget", "double"),
    ColumnSpec("ESTIMATE", "estimate", "double"),
    ColumnSpec("FISCAL_YEAR", "dashboard_fiscal_year", "text"),
    ColumnSpec("ON_TIME_STATUS", "on_time_status", "text"),
    ColumnSpec("ON_TIME_STATUS_REASON", "on_time_status_reason", "text"),
    ColumnSpec("ON_BUDGET_STATUS", "on_budget_status", "text"),
    ColumnSpec("ON_BUDGET_STATUS_REASON", "on_budget_status_reason", "text"),
]

CONTRACT_SPEC = [
    ColumnSpec("CONTRACT_ID", "contract_id", "keep"),
    ColumnSpec("UPC", "upc", "keep"),
    ColumnSpec("DISTRICT", "district", "text"),
    ColumnSpec("ROAD_SYSTEM", "road_system", "text"),
    ColumnSpec("ORIGINAL_SPECIFIED_COMPLETION_DATE", "original_completion_date", "date"),
    ColumnSpec("CURRENT_SPECIFIED_COMPLETION_DATE", "current_completion_date", "date"),
    ColumnSpec("ACCEPTANCE_DATE", "actual_completion_date", "date"),
    ColumnSpec("CONTRACT_AWARD_AMOUNT", "award_amount", "double"),
    ColumnSpec("CURRENT_CONTRACT_AMOUNT", "current_amount", "double"),
    ColumnSpec("UN_AUDITED_FINAL_COST", "final_cost", "double"),
    ColumnSpec("ON_TIME_STATUS", "on_time_status", "text"),
    ColumnSpec("ON_BUDGET_STATUS", "on_budget_status", "text"),
]

