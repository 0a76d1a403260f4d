"""Full outer merge of two keyed sources with per-row provenance.

``merge_with_provenance`` joins on the key, coalesces overlapping columns with the
preferred (left) side first, passes one-sided columns through and labels every row
``both`` / left-only / right-only.

Scale notes: rows with a NULL key can never match, but hash partitioning on the key
would send all of them to one reducer.  The join key is therefore ``(key, salt)``:
salt 0 for every keyed row (so matching is unchanged) and a deterministic hash of the
row's own values for a NULL-key row, which spreads a flood of NULL keys over all
reducers in the same single pass (NULL = NULL is never true, so they still come out
unmatched, labelled as the SQL CASE labels them: a NULL left key reads as
right-only).  Keys are unique per side (checked by ``quality.unique_key``), so the
sort-merge join has no other hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The provenance labels (matched, program only, outcome only).
PROGRAM_OUTCOME_LABELS = ("both", "syip_only", "dashboard_only")
NULL_SALTS = 4096

# Merged column → (program column, outcome column).
PROJECT_COLUMNS = [
    ("district", "district", "district"),
    ("road_system", "road_system", "road_system"),
    ("project_type", "project_type", "project_type"),
    ("project_status", "project_status", "project_status"),
    ("has_pe", "has_pe", None),
    ("has_rw", "has_rw", None),
    ("has_cn", "has_cn", None),
    ("current_pe_estimate", "current_pe_estimate", None),
    ("current_rw_estimate", "current_rw_estimate", None),
    ("current_cn_estimate", "current_cn_estimate", None),
    ("allocated_budget", "total_allocated", "budget"),
    ("current_estimate", "total_current_estimate", "estimate"),
    ("pe_start_date", "pe_start_date", None),
    ("rw_start_date", "rw_start_date", None),
    ("cn_start_date", "cn_start_date", None),
    ("cn_end_date", "cn_end_date", None),
    ("syip_vintage_year", "syip_vintage_year", None),
    ("dashboard_fiscal_year", None, "dashboard_fiscal_year"),
    ("on_time_status", None, "on_time_status"),
    ("on_time_status_reason", None, "on_time_status_reason"),
    ("on_budget_status", None, "on_budget_status"),
    ("on_budget_status_reason", None, "on_budget_status_reason"),
]


def merge_with_provenance(left: DataFrame, right: DataFrame, key: str, columns=PROJECT_COLUMNS,
                          labels=PROGRAM_OUTCOME_LABELS, provenance: str = "data_source") -> DataFrame:
    both_lbl, left_lbl, right_lbl = labels

    def project():
        lk, rk = F.col(f"l.{key}"), F.col(f"r.{key}")
        exprs = [F.coalesce(lk, rk).alias(key),
                 F.when(lk.isNotNull() & rk.isNotNull(), F.lit(both_lbl))
                  .when(lk.isNotNull(), F.lit(left_lbl)).otherwise(F.lit(right_lbl)).alias(provenance)]
        for out, lc, rc in columns:
            le = F.col(f"l.{lc}") if lc else None
            re_ = F.col(f"r.{rc}") if rc else None
            if le is not None and re_ is not None:
                exprs.append(F.coalesce(le, re_).alias(out))
            else:
                exprs.append((le if le is not None else re_).alias(out))
        return exprs

    def salted(df: DataFrame) -> DataFrame:
        salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(NULL_SALTS)) + 1)
        return df.withColumn("__salt", F.coalesce(salt, F.lit(0).cast("bigint")))

    l = salted(left).alias("l")
    r = salted(right).alias("r")
    cond = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l.__salt") == F.col("r.__salt"))
    return l.join(r, cond, "full_outer").select(project())


def provenance_counts(merged: DataFrame, provenance: str = "data_source") -> DataFrame:
    return merged.groupBy(provenance).agg(F.count(F.lit(1)).alias("n"))
