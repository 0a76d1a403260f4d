"""Plan shape of every registered query: no cross or nested-loop joins, no Python
UDFs, and filters/columns pushed into the Parquet scans."""

import pytest

import __spark_entry__ as entry
from projectpulse.plans.queries import REGISTRY as CORE

FITTED = {"compare_models", "oof_scores", "train_logistic", "score_trained", "model_floor", "tree_models"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CORE) - FITTED))
def test_no_cross_joins_or_python(spark, sf_dir, name):
    plan = _plan(entry.queries()[name](spark, sf_dir))
    assert not [k for k in FORBIDDEN if k in plan], plan


def test_merge_pushes_date_filter_and_prunes_columns(spark, sf_dir):
    plan = _plan(entry.queries()["merge_projects"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "o_comment" not in plan and "o_clerk" not in plan


def test_co_located_tables_join_without_shuffle(spark, sf_dir):
    """Bucketed by the join key on both sides: no Exchange by key, with broadcasts off; same rows as a shuffle join."""
    from pyspark.sql import functions as F

    from projectpulse.operators import quality as Q
    from projectpulse.plans import build
    from projectpulse.plans.queries import RECONCILE
    from projectpulse.sources.layout import co_located
    program, projects = build.program(spark, sf_dir), build.projects(spark, sf_dir)
    hot = program.withColumn("upc", F.when(F.col("upc") % 3 == 0, F.lit(7)).when(F.col("upc") % 3 == 1, None).otherwise(F.col("upc")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for source in (program, hot):
            out = Q.reconcile(co_located(projects, "upc", "a"), co_located(source, "upc", "b"), "upc", RECONCILE)
            plan = _plan(out)
            assert "SortMergeJoin" in plan and "hashpartitioning" not in plan, plan
            assert sorted(map(tuple, out.collect())) == sorted(map(tuple, Q.reconcile(projects, source, "upc", RECONCILE).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
