"""Exact grouped medians that stay bounded per task.

``F.median`` keeps every distinct value of a group in one aggregation buffer; for a
group that holds a third of all rows (the ``overall`` cut always holds all of them)
that is an unbounded group in one task.  This operator gets the same exact,
interpolated median (DuckDB ``median`` / ``quantile_cont(0.5)``) by rank on bit patterns:

1. ``order_key`` turns a double into a 64-bit integer of the same order: sign,
   exponent and mantissa, with infinities at both ends and NaN after all numbers, as
   SQL orders them;
2. a round counts the rows of every group by the leading bits of the key, in a plain
   hash aggregate that is combined on the map side, and takes the part that holds the
   middle ranks; the next round looks at the rows of that part alone, by ``BITS`` more bits;
3. a group is settled when its two middle ranks lie in different parts (the greatest
   value of the one and the least of the other are the middle values) or when all
   values of its part are equal.

A round cuts a range to one part in 2**16, whatever the values, so 64 bits take four
rounds after the pass that counts the groups, and most data take one or two: parts that
hold few rows go to the last bit at once.  No step holds more than 2**16 parts of a
group in one task.  Keys are written once with the input; ``key_value`` turns those of
the middle values back.

``rollup_stats`` adds the same from finest cells: counts, sums and the histograms of each
round are taken per cell and added up to the groups that the cell belongs to, so no
input row is repeated for a group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from projectpulse.operators.joins import null_safe_join
from projectpulse.sources.readers import materialize

BITS = 16
#: Where no part has more rows, they are ranked by all remaining bits; groups of at most ``TINY`` rows from the start.
SMALL, TINY = 1 << 18, 1 << 13


def order_key(x: Column) -> Column:
    """The double ``x`` as a long in the same order; NULL stays NULL, -0.0 equals 0.0, NaN is greatest."""
    x = x.cast("double")
    a = F.abs(x)
    guess = F.floor(F.log2(a)).cast("int")  # one off at most, near powers of two
    power = lambda e: F.pow(F.lit(2.0), e)  # noqa: E731 - exact for whole exponents
    e = guess + F.when(a >= power(guess + 1), 1).when(a < power(guess), -1).otherwise(0)
    mantissa = ((a / power(e) - 1) * 2.0**52).cast("bigint")
    normal = (e + 1023).cast("bigint") * F.lit(1 << 52) + mantissa
    tiny = (a * 2.0**537 * 2.0**537).cast("bigint")
    bits = (F.when(a == 0, F.lit(0).cast("bigint")).when(a == float("inf"), F.lit(2047 << 52))
            .when(a < 2.0**-1022, tiny).otherwise(normal))
    return F.when(F.isnan(x), F.lit((2047 << 52) + 1)).when(x < 0, -bits).otherwise(bits)


def key_value(k: Column) -> Column:
    """The double of an ``order_key``."""
    bits = F.abs(k)
    e, m = F.shiftright(bits, 52), bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    size = (F.when(bits == F.lit(2047 << 52), F.lit(float("inf"))).when(e == 0, m * 2.0**-537 * 2.0**-537)
            .otherwise((m / 2.0**52 + 1) * F.pow(F.lit(2.0), (e - 1023).cast("double"))))
    return F.when(bits > F.lit(2047 << 52), F.lit(float("nan"))).when(k < 0, -size).otherwise(size)


def _keyed(df: DataFrame, medians: dict, spark, write: bool) -> DataFrame:
    """``df`` with the key of each measure; written once to the shared checkpoint folder."""
    out = df.select("*", *[order_key(F.col(v)).alias(f"__k{i}") for i, v in enumerate(medians.values())])
    return materialize(out, spark, "median-input") if write else out


def grouped_stats(df: DataFrame, keys, aggs=(), medians: dict | None = None,
                  materialize_input: bool = True) -> DataFrame:
    """``df.groupBy(keys).agg(*aggs)`` plus exact medians ``{out_name: value_column}``.

    ``keys`` may be empty (one global row).  NULL values are skipped by the medians,
    as in SQL; a group with no non-NULL value gets a NULL median.

    The median passes read ``df`` several times; with ``materialize_input`` it is
    written once to the shared checkpoint folder (only the columns the caller
    selected), so the passes re-read compact Parquet instead of recomputing the
    upstream plan, and a lost executor re-reads files instead of re-running joins.
    """
    keys = list(keys)
    medians = dict(medians or {})
    spark = df.sparkSession
    if medians:
        df = _keyed(df, medians, spark, materialize_input)
    gkeys = keys or ["__g"]
    src = df if keys else df.withColumn("__g", F.lit(0))
    if not medians:
        out = src.groupBy(*gkeys).agg(*aggs) if aggs else src.groupBy(*gkeys).count()
        return out if keys else out.drop("__g")
    sizes = [F.count(f"__k{i}").alias(f"__n{i}") for i in range(len(medians))]
    base = materialize(src.groupBy(*gkeys).agg(*aggs, *sizes), spark, "median-groups")
    out = _with_medians(base, src, gkeys, gkeys, medians)
    return out if keys else out.drop("__g")


@dataclass(frozen=True)
class Stat:
    """A statistic that can be added up from parts: the count of a condition's rows (of all rows without one),
    or the mean of a column's non-NULL values."""

    name: str
    kind: str  # count | mean
    of: Column | None = None

    def parts(self, i: int) -> list[Column]:
        if self.kind == "count":
            return [(F.count(F.lit(1)) if self.of is None else F.count_if(self.of)).alias(f"__s{i}")]
        return [F.sum(self.of).alias(f"__s{i}"), F.count(self.of).alias(f"__c{i}")]

    def result(self, i: int) -> Column:
        total = F.col(f"__s{i}")
        return (total if self.kind == "count" else F.try_divide(total, F.col(f"__c{i}"))).alias(self.name)


def rollup_stats(df: DataFrame, cells, keys, expand: Callable[[DataFrame, list], DataFrame], stats, medians: dict | None = None) -> DataFrame:
    """Statistics (and exact medians ``{out_name: value_column}``) of groups that are unions of cells.

    ``cells`` are the columns of ``df`` that make a finest cell; ``expand(rows, columns)`` gives one row with
    ``keys`` and ``columns`` for each group that a row's cell belongs to.  It is applied to cells and to parts of
    their histograms, never to rows of ``df``.
    """
    cells, keys, stats, medians = list(cells), list(keys), list(stats), dict(medians or {})
    spark = df.sparkSession
    if medians:
        df = _keyed(df, medians, spark, True)
    sizes = [F.count(f"__k{i}").alias(f"__n{i}") for i in range(len(medians))]
    states = [c for i, s in enumerate(stats) for c in s.parts(i)] + sizes
    per_cell = df.groupBy(*cells).agg(*states)
    if medians:
        per_cell = materialize(per_cell, spark, "rollup-cells")
    names = [c for c in per_cell.columns if c not in cells]
    totals = expand(per_cell, names).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    wanted = [s.result(i) for i, s in enumerate(stats)]
    if not medians:
        return totals.select(*keys, *wanted)
    base = materialize(totals.select(*keys, *wanted, *[f"__n{i}" for i in range(len(medians))]), spark, "median-groups")
    return _with_medians(base, df, cells, keys, medians, expand, per_cell.select(*cells))


def _with_medians(base: DataFrame, src: DataFrame, cells, keys, medians: dict, expand=None, cell_rows: DataFrame | None = None) -> DataFrame:
    """``base`` (keys, ..., ``__n<i>``: non-NULL values of measure i) with the medians instead of the sizes."""
    sizes = base.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(i).alias("m"), F.col(f"__n{i}").alias("n")) for i in range(len(medians))]))).where(F.col("n") > 0)
    stacked = src.select(*cells, F.inline(F.array(*[
        F.struct(F.lit(i).alias("m"), F.col(f"__k{i}").alias("k")) for i in range(len(medians))]))).where(F.col("k").isNotNull())
    settled = _settle(sizes, stacked, list(cells), list(keys), expand, cell_rows)
    a, b = key_value(F.col("a")), key_value(F.col("b"))
    settled = settled.withColumn("median", F.when(F.col("a") == F.col("b"), a).otherwise(a * 0.5 + b * 0.5))
    wide = settled.groupBy(*keys).agg(*[F.max(F.when(F.col("m") == i, F.col("median"))).alias(out) for i, out in enumerate(medians)])
    return null_safe_join(base.drop(*[f"__n{i}" for i in range(len(medians))]), wide, keys, "left")


def _settle(sizes: DataFrame, stacked: DataFrame, cells, keys, expand, cell_rows) -> DataFrame:
    """(keys, m, a, b) of every group and measure of ``sizes`` (keys, m, n) from rows (cells, m, k): the keys of
    its two middle values."""
    spark = sizes.sparkSession
    mkeys = [*keys, "m"]
    open_ = sizes.select(*mkeys, "n", F.lit(0).cast("bigint").alias("below"), F.lit(None).cast("bigint").alias("prefix"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    first, second = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    done, before, shift = [], None, 0 if largest <= min(SMALL, TINY) else 64 - BITS
    while True:
        rows = stacked
        if before is not None:  # the rows of the parts that hold some group's middle, once each
            near = open_ if expand is None else null_safe_join(expand(cell_rows, cells), open_, keys)
            rows = null_safe_join(rows.withColumn("prefix", F.shiftright("k", before)), near.select(*cells, "m", "prefix").distinct(), [*cells, "m", "prefix"])
        counts = rows.groupBy(*cells, "m", F.shiftright("k", shift).alias("part")).agg(
            F.count(F.lit(1)).alias("c"), F.min("k").alias("least"), F.max("k").alias("most"))
        if expand is not None:
            counts = expand(counts, ["m", "part", "c", "least", "most"]).groupBy(*mkeys, "part").agg(
                F.sum("c").alias("c"), F.min("least").alias("least"), F.max("most").alias("most"))
        own = null_safe_join(counts, open_, mkeys)
        if before is not None:
            own = own.where(F.shiftright("part", before - shift) == F.col("prefix"))
        upto = Window.partitionBy(*mkeys).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = own.withColumn("end", F.col("below") + F.sum("c").over(upto)).withColumn("start", F.col("end") - F.col("c"))
        hold = lambda rank: F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.struct("start", "c", "part", "least", "most")))
        middle = materialize(ranked.groupBy(*mkeys, "n").agg(hold(first).alias("a"), hold(second).alias("b")), spark, "median-parts")
        apart = F.col("a.part") != F.col("b.part")
        one = F.col("a.least") == F.col("a.most")
        done.append(middle.where(apart | one).select(*mkeys, F.col("a.most").alias("a"), F.col("b.least").alias("b")))
        if shift == 0:  # a part is one value
            return reduce(DataFrame.unionByName, done)
        left = middle.where(~apart & ~one)
        largest = left.agg(F.max("a.c")).first()[0]
        if largest is None:
            return reduce(DataFrame.unionByName, done)
        open_ = left.select(*mkeys, "n", F.col("a.start").alias("below"), F.col("a.part").alias("prefix"))
        before, shift = shift, 0 if largest <= SMALL else max(0, shift - BITS)
