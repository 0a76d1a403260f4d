"""Inventory of the core queries' physical plans, and of the jobs that run before them (Markdown table).

usage: python tools/plan_inventory.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from projectpulse.session import local_session
    from projectpulse.plans.queries import REGISTRY

    spark = local_session(8, 8)
    print("# Plan inventory\n")
    print(f"Physical plans (before adaptive re-planning) of the registered queries on `{sf_dir}`. "
          "Exchanges are shuffles. A broadcast join ships only its small, size-checked side. "
          "Eager steps (written intermediates, fitted scalars) run before the final plan: the first "
          "column counts their Spark jobs (without the footer reads of tables). "
          "The data-quality queries build each rule's input from the source tables, so identical "
          "extract subtrees repeat. Spark reuses identical exchanges when it runs them.\n")
    print("| query | jobs before | shuffles | sort-merge joins | broadcast joins | windows | hash aggs | sort aggs | scans with pushed filters |")
    print("|---|---|---|---|---|---|---|---|---|")
    sc = spark.sparkContext
    for name, (fn, _) in sorted(REGISTRY.items()):
        sc.setJobGroup(name, name)
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        tracker = sc.statusTracker()
        infos = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(name)]
        stages = [tracker.getStageInfo(s) for i in infos if i for s in i.stageIds]
        jobs = len(infos) - sum(1 for s in stages if s and s.name.startswith("parquet at"))
        # count each operator once per node line
        lines = plan.splitlines()

        def count(pat):
            return sum(1 for ln in lines if re.search(pat, ln))

        pushed = count(r"PushedFilters: \[[^\]]+\]")
        windows = count(r"\bWindow\b")
        print(f"| {name} | {jobs} | {count(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition')} "
              f"| {count(r'SortMergeJoin')} | {count(r'BroadcastHashJoin')} | {windows} "
              f"| {count(r'HashAggregate')} | {count(r'SortAggregate')} | {pushed} |")
    spark.stop()


if __name__ == "__main__":
    main()
