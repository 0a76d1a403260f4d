"""Evaluation operators: folds, ROC points, AUC, precision/recall/F1, CV summary.

Running totals over a global order (ROC curves, stratified fold positions) would
normally need a window with no partition key — every row in one task.  ``running_totals``
takes prefix sums over range partitions instead: rows are sorted into ranges of about
``RANGE_ROWS``, a window runs within each range, and the totals of the ranges, added up
in their order, give each range its offset.  The number of ranges comes from the number
of rows, so a task's share does not grow with the data; up to one range it is a plain window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from projectpulse.operators.joins import checked_broadcast, null_safe_join
from projectpulse.sources.readers import materialize

#: Rows of a range: what one task sorts.
RANGE_ROWS = 1_000_000
FOLD_SEED = 42
N_FOLDS = 5


def running_totals(df: DataFrame, order, sums, by=(), inclusive: bool = True, range_rows: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` = running sum of each column in ``sums`` along ``order`` within ``by``.

    ``order`` is a column or a list of columns; rows that it does not tell apart take any order among
    themselves, and are spread over ranges like others, so a flood of equal or NULL order values is no
    hot key.  ``inclusive=False`` sums strictly earlier rows only.  No row is lost: NULL group values are
    groups of their own, and rows whose order value is NULL come before all others (Spark sorts NULLs first).
    """
    by = list(by)
    orders = [o if isinstance(o, Column) else F.col(o) for o in (order if isinstance(order, (list, tuple)) else [order])]
    names = [f"__o{i}" for i in range(len(orders))]
    x = materialize(df.select("*", *[o.alias(n) for o, n in zip(orders, names)], F.monotonically_increasing_id().alias("__tie")),
                    df.sparkSession, "prefix-input")
    last = Window.currentRow if inclusive else -1
    ranges = max(1, math.ceil(x.count() / (range_rows or RANGE_ROWS)))
    if ranges == 1:
        w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(*names, "__tie").rowsBetween(Window.unboundedPreceding, last)
        return x.select(*df.columns, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"cum_{c}") for c in sums])
    # Written, so that the number of a row's range is the same wherever it is read.
    x = materialize(x.repartitionByRange(ranges, *by, *names, "__tie").withColumn("__range", F.spark_partition_id()), df.sparkSession, "prefix-ranges")
    before = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = x.groupBy(*by, "__range").agg(*[F.sum(c).alias(f"__t_{c}") for c in sums]).select(
        *by, "__range", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__off_{c}") for c in sums])
    w = Window.partitionBy("__range", *by).orderBy(*names, "__tie").rowsBetween(Window.unboundedPreceding, last)
    within = x.repartitionByRange(ranges, "__range").select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"__in_{c}") for c in sums])
    j = null_safe_join(within, checked_broadcast(offsets), by + ["__range"])
    return j.select(*df.columns, *[(F.col(f"__off_{c}") + F.col(f"__in_{c}")).alias(f"cum_{c}") for c in sums])


def score_counts(scored: DataFrame, label: str = "label", score: str = "score", by=()) -> DataFrame:
    """One row per (by, distinct score) with positive and negative counts (partial aggregation).
    A NULL score or label and a score that is not a number have no place on a curve: they raise an error."""
    known = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull()
    checked = F.when(known, F.col(score)).otherwise(
        F.raise_error("a score or label is NULL or not a number").cast(scored.schema[score].dataType))
    return scored.withColumn(score, checked).groupBy(*by, score).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                          F.count_if(F.col(label) == 0).alias("neg"))


def roc_points(scored: DataFrame, label: str = "label", score: str = "score", by=()) -> DataFrame:
    """ROC curve: one point per distinct score threshold, highest threshold first.  A rate is NULL
    where the data have no row of its class."""
    by = list(by)
    sc = score_counts(scored, label, score, by)
    cum = running_totals(sc, -F.col(score), ["pos", "neg"], by)
    if by:
        tot = sc.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        j = null_safe_join(cum, checked_broadcast(tot), by)
    else:
        # one curve: the class totals are two scalars
        t = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
        j = cum.withColumns({"P": F.lit(t["P"]), "N": F.lit(t["N"])})
    return j.select(*by, F.col(score).alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                    F.try_divide("cum_pos", "P").alias("tpr"), F.try_divide("cum_neg", "N").alias("fpr"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score", by=()) -> DataFrame:
    """Exact ROC AUC (ties count one half): Σ_s neg_s · (pos above s + pos_s / 2) / (P · N); NULL
    where only one class is present."""
    by = list(by)
    sc = score_counts(scored, label, score, by)
    cum = running_totals(sc, -F.col(score), ["pos"], by, inclusive=False)
    g = cum.groupBy(*by) if by else cum.groupBy()
    return g.agg(F.try_divide(F.sum(F.col("neg") * (F.col("cum_pos") + F.col("pos") / 2.0)),
                              F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def classification_metrics(scored: DataFrame, label: str = "label", score: str = "score", by=(),
                           threshold: float = 0.5) -> DataFrame:
    """Precision, recall and F1 of class 1 with prediction = score > threshold (0 when undefined)."""
    pred = F.col(score) > threshold
    y = F.col(label) == 1
    g = scored.groupBy(*by) if by else scored.groupBy()
    c = g.agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
              F.count_if(~pred & y).alias("fn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    return (c.withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                        .otherwise(F.lit(0.0))))


def fold_order_hash(key: str, seed: int = FOLD_SEED) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = N_FOLDS, seed: int = FOLD_SEED,
                     fold_col: str = "fold") -> DataFrame:
    """Shuffled stratified k-fold: within each label, rows ordered by a seeded hash of the
    key take folds 0, 1, …, k−1 in turn, so every fold gets the same share of each class
    (sizes differ by at most one).  No step holds a whole class in one task: positions
    are prefix sums over ranges."""
    x = df.withColumn("__one", F.lit(1))
    pos = running_totals(x, [fold_order_hash(key, seed), F.col(key)], ["__one"], [label])
    return pos.select(*df.columns, F.pmod(F.col("cum___one") - 1, F.lit(k)).cast("int").alias(fold_col))


def fold_metrics(scored: DataFrame, label: str = "label", score: str = "score", fold: str = "fold",
                 by=()) -> DataFrame:
    """Per (by, fold): roc_auc, precision, recall, f1."""
    keys = list(by) + [fold]
    auc = roc_auc(scored, label, score, keys)
    cm = classification_metrics(scored, label, score, keys).select(*keys, "precision", "recall", "f1")
    return null_safe_join(auc, cm, keys)


def cv_summary(per_fold: DataFrame, by=(), metrics=("roc_auc", "precision", "recall", "f1")) -> DataFrame:
    """Mean and population std of each metric over folds."""
    g = per_fold.groupBy(*by) if by else per_fold.groupBy()
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return g.agg(*aggs)
