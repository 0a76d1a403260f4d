"""Scoring with exact per-row explanations, and the global feature table.

A linear model's logit is Σ coef_j · x_j + intercept, so each feature's contribution
is exact.  Coefficients of levels are a table that rows look up by a join (broadcast
while it is small); the non-zero contributions are an array of structs
``(-|c|, index, c)``; ``filter`` drops |c| ≤ 1e-9, ``sort_array`` orders by magnitude
with the feature index breaking ties, and the first ``top_k`` become the plain-language
explanation.  No UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from projectpulse.functions.scalar import logistic, score_0_100
from projectpulse.operators.model import LinearModel, Prep, _long_levels, fit_prep, numeric_exprs, with_contributions
from projectpulse.sources.readers import materialize

# Explanation wording.
NO_DRIVER = "no strong individual driver"
RAISES, LOWERS = "raises risk", "lowers risk"
INDICATOR_SENTENCE = "Indicator for projects with no allocated-budget figure to compute a size feature from."
ELEVATED_AT = 60
TOP_K = 2
TINY = 1e-9


def score_and_explain(df: DataFrame, model: LinearModel, key: str = "upc", top_k: int = TOP_K,
                      carry=("allocated_budget",), elevated_at: int = ELEVATED_AT) -> DataFrame:
    """(key, risk_probability, risk_score, top_factors, *carry, elevated_risk) for every row."""
    rows, parts = with_contributions(df, model)
    # A level's description holds the row's own value; the numeric ones are fixed.
    told = [F.concat(F.lit(f"{c}='"), F.col(c), F.lit("'")) for c in model.prep.categorical] + [F.lit(f.name) for _, f, _ in model.numbers]
    # Computed once into columns; the logit and the explanation array reference them.
    base = rows.select(key, *carry, *[c for names in parts for c in names], *[t.alias(f"__t{j}") for j, t in enumerate(told)])
    logit = F.lit(float(model.intercept))
    for _, c in parts:
        logit = logit + F.col(c)
    items = F.array(*[F.struct((-F.abs(F.col(c))).alias("neg_abs"), F.col(i).alias("idx"), F.col(c).alias("c"), F.col(f"__t{j}").alias("told"))
                      for j, (i, c) in enumerate(parts)])
    # magnitude order, feature index breaking ties; |c| <= 1e-9 dropped; first top_k kept
    top = F.slice(F.sort_array(F.filter(items, lambda s: s["neg_abs"] < -TINY)), 1, top_k)
    text = F.array_join(F.transform(top, lambda s: F.concat(
        s["told"], F.when(s["c"] > 0, F.lit(f" ({RAISES})")).otherwise(F.lit(f" ({LOWERS})")))), "; ")
    p = logistic(logit)
    scored = base.select(
        key,
        p.alias("risk_probability"),
        score_0_100(p).alias("risk_score"),
        F.when(F.size(top) > 0, text).otherwise(F.lit(NO_DRIVER)).alias("top_factors"),
        *carry)
    return scored.withColumn("elevated_risk", F.col("risk_score") >= elevated_at)


def coefficient_table(spark: SparkSession, model: LinearModel) -> DataFrame:
    """(idx, feature, column_name, category, kind, coef, reference) — one row per coefficient."""
    levels = model.levels.join(model.prep.references(), "column_name").select(
        "idx", F.concat("column_name", F.lit("="), "level").alias("feature"), "column_name", F.col("level").alias("category"),
        F.lit("cat").alias("kind"), "coef", "reference")
    numbers = [(i, f.name, f.column, None, f.kind, float(c), None) for i, f, c in model.numbers]
    return levels.unionByName(spark.createDataFrame(
        numbers, "idx int, feature string, column_name string, category string, kind string, coef double, reference string"))


def global_feature_table(coefs: DataFrame, numeric_label: str = "log(allocated budget)",
                         unit: str = "one-standard-deviation") -> DataFrame:
    """Odds ratio, direction and a sentence per coefficient, largest |coef| first.

    The numeric input is standardised, so the default wording is per standard
    deviation; pass ``unit="one-unit"`` for the raw-unit wording.
    """
    # The wording of the three sentences.
    odds = F.exp(F.col("coef"))
    odds_txt = F.format_string("%.2f", odds)
    cat_sentence = F.concat(
        F.col("column_name"), F.lit("='"), F.col("category"), F.lit("' carries "), odds_txt,
        F.lit("x the odds of being flagged at-risk compared to "), F.col("column_name"), F.lit("='"),
        F.col("reference"), F.lit("' ("), F.when(F.col("coef") > 0, F.lit("higher")).otherwise(F.lit("lower")),
        F.lit(" risk)."))
    num_sentence = F.concat(
        F.lit(f"Each {unit} increase in {numeric_label} "),
        F.when(F.col("coef") > 0, F.lit("increases")).otherwise(F.lit("decreases")),
        F.lit(" the odds of being flagged at-risk by "), odds_txt, F.lit("x"),
        F.when(F.col("coef") > 0, F.lit(" — bigger projects trend riskier")).otherwise(F.lit("")), F.lit("."))
    sentence = (F.when(F.col("kind") == "cat", cat_sentence)
                .when(F.col("kind") == "ind", F.lit(INDICATOR_SENTENCE)).otherwise(num_sentence))
    return (coefs.select("idx", "feature", "column_name", "category", "coef", odds.alias("odds_ratio"),
                         sentence.alias("sentence"))
            .orderBy(F.abs(F.col("coef")).desc(), F.col("idx").asc()))


def top_risk_factors(table: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` risk-raising and top ``k`` risk-lowering features by |coef|."""
    from pyspark.sql import Window
    signed = table.where(F.col("coef") != 0).withColumn(
        "direction", F.when(F.col("coef") > 0, F.lit("increasing")).otherwise(F.lit("decreasing")))
    w = Window.partitionBy("direction").orderBy(F.abs(F.col("coef")).desc(), F.col("idx").asc())
    return (signed.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("direction", "rank", "feature", "coef", "sentence"))


def elevated_summary(scores: DataFrame, flag: str = "elevated_risk", dollars: str = "allocated_budget") -> DataFrame:
    return scores.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(F.col(flag)).alias("n_elevated"),
                      F.avg(F.col(flag).cast("int")).alias("share_elevated"),
                      F.coalesce(F.sum(F.when(F.col(flag), F.col(dollars))), F.lit(0.0)).alias("dollars_elevated"))


# ---------------------------------------------------------------- data-derived coefficient fixture

def univariate_model(train: DataFrame, drop_first: bool = True) -> LinearModel:
    """A closed-form linear model fitted from class counts, used to check scoring exactly.

    coef(level) = log-odds of the level − log-odds of the reference level (counts + ½);
    coef(numeric or indicator) = mean standardised value among positives − among
    negatives; intercept = overall log-odds.  Every number comes from aggregates over
    the training rows, so the scoring check grows with the data and has a SQL twin.
    """
    prep: Prep = fit_prep(train, drop_first=drop_first)
    y = F.col("at_risk") == 1
    odds = F.log((F.count_if(y) + 0.5) / (F.count_if(~y) + 0.5)).alias("odds")
    counted = _long_levels(train, prep.categorical, ["at_risk"]).groupBy("column_name", "level").agg(odds)
    base = counted.join(prep.references().withColumnRenamed("reference", "level"), ["column_name", "level"]).select(
        "column_name", F.col("odds").alias("base"))
    levels = materialize(prep.level_features().join(counted, ["column_name", "level"]).join(base, "column_name").select(
        "column_name", "level", "idx", (F.col("odds") - F.col("base")).alias("coef")), train.sparkSession, "coefficients")
    agg = train.agg(F.count_if(y).alias("P"), F.count_if(~y).alias("N"), *[
        (F.avg(F.when(y, x)) - F.avg(F.when(~y, x))).alias(f"d{i}") for i, x in enumerate(numeric_exprs(prep))]).first()
    numbers = [(i, f, float(agg[f"d{j}"] or 0.0)) for j, (i, f) in enumerate(prep.numeric_features())]
    return LinearModel(prep, levels, numbers, math.log((agg["P"] + 0.5) / (agg["N"] + 0.5)))
