"""Declarative data-quality expectations.

``expect(df, rules)`` evaluates every single-table aggregate rule in **one** pass
(all rules contribute aggregate columns to one ``agg``) and returns one row per rule:
``(rule, observed, bound, passed)``.  Rules that need their own plan (duplicates,
domains, key overlap, reconciliation) build a one-row DataFrame each and are unioned
in.  Nothing is collected: the result is a DataFrame the caller can show, write or
assert on.

``measured_write`` evaluates the same rules while a table is written, as observed metrics
of the write itself, so they cost no pass of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RESULT_COLUMNS = ["rule", "observed", "bound", "passed"]


def fmt_bound(lo=None, hi=None) -> str:
    return f"[{'-inf' if lo is None else repr(lo)}, {'inf' if hi is None else repr(hi)}]"


def _between(x: Column, lo, hi) -> Column:
    conds = []
    if lo is not None:
        conds.append(x >= F.lit(lo))
    if hi is not None:
        conds.append(x <= F.lit(hi))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


@dataclass
class AggRule:
    """A rule whose observed value is one aggregate over the table."""

    name: str
    observed: Column
    lo: float | None = None
    hi: float | None = None
    bound: str | None = field(default=None)

    def bound_text(self) -> str:
        return self.bound if self.bound is not None else fmt_bound(self.lo, self.hi)


def _result(name: str, observed: Column, bound: str, passed: Column) -> Column:
    return F.struct(F.lit(name).alias("rule"), observed.cast("double").alias("observed"),
                    F.lit(bound).alias("bound"), passed.alias("passed"))


# ----------------------------------------------------------------- single-pass rules

def row_count(lo=1, hi=None, name: str = "row_count") -> AggRule:
    return AggRule(name, F.count(F.lit(1)), lo, hi)


def null_count(col: str, lo=0, hi=0) -> AggRule:
    return AggRule(f"null_count:{col}", F.count_if(F.col(col).isNull()), lo, hi)


def non_null_share(col: str, min_share: float) -> AggRule:
    return AggRule(f"non_null_share:{col}", F.avg(F.col(col).isNotNull().cast("int")), min_share, None)


def castable_share(col: str, dtype: str, min_share: float = 1.0) -> AggRule:
    """Share of non-NULL values that cast cleanly to ``dtype``."""
    c = F.col(col)
    return AggRule(f"castable_share:{col}:{dtype}",
                   F.avg(F.when(c.isNotNull(), c.try_cast(dtype).isNotNull().cast("int"))), min_share, None)


def out_of_range(col: str, lo=None, hi=None) -> AggRule:
    """Count of non-NULL values outside [lo, hi]; passes when zero."""
    c = F.col(col)
    return AggRule(f"out_of_range:{col}", F.count_if(c.isNotNull() & ~_between(c, lo, hi)), 0, 0,
                   bound=f"0 outside {fmt_bound(lo, hi)}")


def min_max(col: str, lo=None, hi=None) -> list[AggRule]:
    c = F.col(col)
    return [AggRule(f"min:{col}", F.min(c), lo, hi), AggRule(f"max:{col}", F.max(c), lo, hi)]


def shares_sum_to_one(cols, tol: float = 1e-9, name: str | None = None) -> AggRule:
    """Count of rows whose shares do not sum to 1 within ``tol``; passes when zero."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    return AggRule(name or f"shares_sum:{'+'.join(cols)}", F.count_if(F.abs(total - 1) > tol), 0, 0,
                   bound=f"0 rows off by more than {tol!r}")


def conditional_count(name: str, predicate: Column, lo=0, hi=0) -> AggRule:
    return AggRule(name, F.count_if(predicate), lo, hi)


def filtered_total(name: str, value: str, predicate: Column, lo=None, hi=None) -> AggRule:
    return AggRule(name, F.coalesce(F.sum(F.when(predicate, F.col(value))), F.lit(0.0)), lo, hi)


def nonempty_text(col: str) -> AggRule:
    c = F.col(col)
    return AggRule(f"empty_text:{col}", F.count_if(c.isNull() | (F.trim(c) == "")), 0, 0)


def flag_matches_rule(flag: str, rule: Column, name: str | None = None) -> AggRule:
    """Rows where the stored flag differs from its defining predicate; passes when zero."""
    return AggRule(name or f"flag_mismatch:{flag}", F.count_if(F.col(flag) != rule), 0, 0)


def expect(df: DataFrame, rules) -> DataFrame:
    """Evaluate aggregate rules in one pass; one output row per rule."""
    rules = list(rules)
    if not rules:
        raise ValueError("no rules")
    wide = df.agg(*[r.observed.alias(f"__r{i}") for i, r in enumerate(rules)])
    return wide.select(F.inline(F.array(*[
        _result(r.name, F.col(f"__r{i}"), r.bound_text(), _between(F.col(f"__r{i}"), r.lo, r.hi))
        for i, r in enumerate(rules)])))


def _holds(value: float | None, lo, hi) -> bool | None:
    if value is None:
        return None if lo is not None or hi is not None else True
    return (lo is None or value >= lo) and (hi is None or value <= hi)


def measured_write(df: DataFrame, rules, write: Callable[[DataFrame], object]) -> tuple[object, DataFrame]:
    """What ``write`` returns for ``df``, and the results of the rules over the rows it wrote, one row per rule.

    ``write`` is one action over all of its argument, such as a table write.  The rules' aggregates sit at the top
    of its plan, so they run in the tasks that write, which Spark counts once each, also when a lost executor makes
    them run again; below a shuffle they could be counted twice.  One row of numbers comes to the driver.
    """
    rules = list(rules)
    if not rules:
        raise ValueError("no rules")
    watch = Observation(f"rules-{uuid.uuid4().hex}")
    out = write(df.observe(watch, *[r.observed.alias(f"r{i}") for i, r in enumerate(rules)]))
    seen = [watch.get[f"r{i}"] for i in range(len(rules))]
    rows = [(r.name, None if v is None else float(v), r.bound_text(), _holds(v, r.lo, r.hi)) for r, v in zip(rules, seen)]
    return out, df.sparkSession.createDataFrame(rows, "rule string, observed double, bound string, passed boolean")


# ----------------------------------------------------------------- rules with their own plan

def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Place the columns of several one-row aggregates in one row without a join:
    union them (missing columns NULL) and take each column's non-NULL value."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    cols = list(dict.fromkeys(c for d in one_row for c in d.columns))
    return u.agg(*[F.max(c).alias(c) for c in cols])


def _one_row(df: DataFrame, name: str, observed: Column, bound: str, passed_fn) -> DataFrame:
    return df.select(F.lit(name).alias("rule"), observed.cast("double").alias("observed"),
                     F.lit(bound).alias("bound")).withColumn("passed", passed_fn(F.col("observed")))


def unique_key(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Key not NULL and unique: observed = NULL keys + surplus rows of repeated keys."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    agg = per_key.agg(F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
                      F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1)), F.lit(0)).alias("dups"))
    return _one_row(agg, name or f"unique_key:{key}", F.col("nulls") + F.col("dups"), "[0, 0]", lambda o: o == 0)


def duplicate_row_share(df: DataFrame, max_share: float, name: str = "duplicate_row_share") -> DataFrame:
    """Share of rows that repeat an earlier full row (NULLs compare equal, as in pandas)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    agg = g.agg((F.sum(F.col("__n") - 1) / F.sum("__n")).alias("share"))
    return _one_row(agg, name, F.coalesce(F.col("share"), F.lit(0.0)), fmt_bound(None, max_share),
                    lambda o: o <= max_share)


def domain(df: DataFrame, col: str, allowed, exact: bool = False) -> DataFrame:
    """Values of ``col`` outside ``allowed`` (NULL ignored); with ``exact`` also allowed values never seen.
    One aggregate: distinct values outside the domain, and a flag per allowed value."""
    allowed, c = list(allowed), F.col(col)
    aggs = [F.count_distinct(F.when(~c.isin(allowed), c)).alias("n")]
    if exact:
        aggs += [F.coalesce(F.max((c == v).cast("int")), F.lit(0)).alias(f"seen{i}") for i, v in enumerate(allowed)]
    observed = reduce(lambda x, y: x + y, [F.lit(1) - F.col(f"seen{i}") for i in range(len(allowed))], F.col("n")) if exact else F.col("n")
    name = f"{'domain_equals' if exact else 'domain_subset'}:{col}"
    return _one_row(df.agg(*aggs), name, observed, "0 values outside {" + ",".join(allowed) + "}", lambda o: o == 0)


def key_overlap(a: DataFrame, b: DataFrame, key: str, min_count: int) -> DataFrame:
    """Number of keys present in both tables (set intersection, distinct)."""
    inter = a.select(key).intersect(b.select(key)).agg(F.count(F.lit(1)).alias("n"))
    return _one_row(inter, f"key_overlap:{key}", F.col("n"), fmt_bound(min_count, None),
                    lambda o: o >= min_count)


def partition_total(df: DataFrame, by: str) -> DataFrame:
    """Group counts add up to the row count: observed = |sum(group counts) − count|, both from one rollup."""
    counts = df.rollup(by).agg(F.count(F.lit(1)).alias("n"), F.grouping(by).alias("total"))
    j = counts.agg(F.sum(F.when(F.col("total") == 0, F.col("n"))).alias("s"), F.sum(F.when(F.col("total") == 1, F.col("n"))).alias("t"))
    return _one_row(j, f"partition_total:{by}", F.abs(F.coalesce("s", F.lit(0)) - F.coalesce("t", F.lit(0))), "[0, 0]", lambda o: o == 0)


def required_columns(df: DataFrame, required, name: str) -> DataFrame:
    """One row per required column of the input ``name``: whether it is present, how many non-NULL values
    it has, and whether the rule holds (present)."""
    present = set(df.columns)
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in required if c in present] or [F.lit(0).alias("__none")])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("input_name"), F.lit(c).alias("column_name"), F.lit(c in present).alias("present"),
                 (F.col(c) if c in present else F.lit(None).cast("bigint")).alias("n_non_null"), F.lit(c in present).alias("passed"))
        for c in required])))


def union_results(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.select(*RESULT_COLUMNS) for p in parts])


def reconcile(merged: DataFrame, source: DataFrame, key: str, pairs) -> DataFrame:
    """Rows where the merged value differs from the preferred source's non-NULL value.

    ``pairs`` = [(merged_column, source_column)]; one rule per pair, passes when zero.
    """
    s = source.select(key, *[F.col(sc).alias(f"__src_{sc}") for _, sc in pairs])
    j = merged.select(key, *[mc for mc, _ in pairs]).join(s, key)
    return expect(j, [conditional_count(f"reconcile:{mc}",
                                        F.col(f"__src_{sc}").isNotNull() & (F.col(mc) != F.col(f"__src_{sc}")))
                      for mc, sc in pairs])


def counts_match(name: str, a: DataFrame, a_col: str, b: DataFrame) -> DataFrame:
    """A stored count (one-row ``a[a_col]``) equals the row count of ``b``: observed = |difference|."""
    j = side_by_side(a.select(F.col(a_col).cast("bigint").alias("__a")),
                     b.agg(F.count(F.lit(1)).alias("__b")))
    return _one_row(j, name, F.abs(F.col("__a") - F.col("__b")), "[0, 0]", lambda o: o == 0)


def consistent_within_key(df: DataFrame, key: str, cols, tasks: int | None = None) -> DataFrame:
    """Keys whose repeated attributes disagree between rows (0 expected).

    Two partial aggregates: distinct (key, attributes) rows, then keys with more than one.  With ``tasks`` the rows
    are dealt by key over so many tasks first, and both run there: a task holds its keys' distinct rows, and repeats,
    also those of a hot key, add none.
    """
    if tasks:
        df = df.select(key, *cols).repartition(tasks, key)
    distinct_rows = df.groupBy(key, *cols).agg(F.count(F.lit(1)).alias("__n"))
    per_key = distinct_rows.groupBy(key).agg(F.count(F.lit(1)).alias("__v"))
    agg = per_key.agg(F.count_if(F.col("__v") > 1).alias("bad"))
    return _one_row(agg, f"inconsistent_within:{key}", F.col("bad"), "[0, 0]", lambda o: o == 0)


def small_groups(rates: DataFrame, n_col: str = "n_rated", threshold: int = 30) -> DataFrame:
    """Per cut type: groups under the sample threshold, at or over it, and whether most are under."""
    return (rates.where(F.col("cut_type") != "overall").groupBy("cut_type")
            .agg(F.count_if(F.col(n_col) < threshold).alias("n_small"),
                 F.count_if(F.col(n_col) >= threshold).alias("n_large"))
            .withColumn("mostly_small", F.col("n_small") > F.col("n_large")))


def named_small_groups(rates: DataFrame, groups, n_col: str = "n_rated", threshold: int = 30) -> DataFrame:
    """For named (cut_type, cut_value) groups: the sample size and whether it lies under the threshold."""
    wanted = reduce(lambda a, b: a | b, [(F.col("cut_type") == t) & (F.col("cut_value") == v) for t, v in groups])
    return rates.where(wanted).select("cut_type", "cut_value", F.col(n_col), (F.col(n_col) < threshold).alias("passed"))
