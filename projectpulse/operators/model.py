"""Feature preparation and Spark ML models.

Preparation is fitted on the training rows.  Category levels are a numbered table (the
dictionary) and rows get their level's number by a join, which Spark broadcasts while the
table is small; one-hot vectors are sparse.  The median, means and population standard
deviations are scalars that become literals.  The whole ``PipelineModel``, the dictionary
included, saves and loads with Spark ML persistence.

* one-hot: all levels (comparison) or first level dropped as reference (final
  model); an unseen level or NULL encodes as all zeros;
* numeric: median imputation, a missing indicator when the training rows have a
  NULL, both standardised with the **population** standard deviation (0 → 1);
* ``fit_preps`` fits the preparations of all folds at once: statistics are taken per fold
  in one aggregate and added up over the folds that are not held out, which equals
  refitting on those rows;
* logistic regression matches an L2 penalty of ½‖w‖² on the summed loss:
  ``regParam = 1/n`` with ``standardization=False`` (intercept not penalised);
* trees split the number at 32 quantiles at most, so rows with equal levels, bin and label are one to them: from
  ``CELL_ROWS`` training rows on, the tree models learn from these cells, weighted by their rows.  A forest draws the
  rows of a cell together (``forest``); of more cells than a task should hold it learns from rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import Bucketizer, OneHotEncoder, SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from projectpulse.functions.scalar import logistic
from projectpulse.operators.evaluate import running_totals
from projectpulse.operators.features import CATEGORICAL, NUMERIC
from projectpulse.operators.forest import fit_forest, fits_a_task
from projectpulse.operators.quantiles import grouped_stats, rollup_stats
from projectpulse.sources.readers import materialize

SEED = 42
MISSING_SUFFIX = "_missing"
INDEX = "__level_"  # prefix of the columns that hold a level's number
NUMBERS = ("__number", "__missing")
#: Training rows from which on the models named learn from weighted cells, and bins of the number in a cell.
CELL_ROWS, CELL_MODELS, BINS = 100_000, ("decision_tree", "random_forest", "gradient_boosting"), 32


@dataclass(frozen=True)
class Feature:
    name: str
    column: str
    category: str | None
    kind: str  # cat | num | ind


class Levels(Mapping):
    """The levels of each column in order, read from the dictionary when they are asked for."""

    def __init__(self, dictionary: DataFrame, columns):
        self.dictionary, self.columns, self.read = dictionary, list(columns), {}

    def __getitem__(self, column: str) -> list[str]:
        if column not in self.columns:
            raise KeyError(column)
        if column not in self.read:
            rows = self.dictionary.where(F.col("column_name") == column).orderBy("position").select("level").collect()
            self.read[column] = [r["level"] for r in rows]
        return self.read[column]

    def __iter__(self):
        return iter(self.columns)

    def __len__(self) -> int:
        return len(self.columns)


@dataclass
class Prep:
    levels: Mapping[str, list[str]]
    drop_first: bool
    numeric: str
    median: float | None
    has_indicator: bool
    mean_x: float
    std_x: float
    mean_i: float
    std_i: float
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL))
    #: column_name, level, position (0 is the reference): a written table, and its rows per column.
    dictionary: DataFrame | None = None
    sizes: dict[str, int] = field(default_factory=dict)
    n_rows: int = 0

    def encoded(self, column: str) -> int:
        """How many features the column has."""
        return max(0, self.sizes[column] - (1 if self.drop_first else 0))

    def offsets(self) -> dict[str, int]:
        """The index of each column's first feature; of the numeric feature under its name."""
        out, at = {}, 0
        for c in self.categorical:
            out[c] = at
            at += self.encoded(c)
        return out | {self.numeric: at}

    def numeric_features(self) -> list[tuple[int, Feature]]:
        at = self.offsets()[self.numeric]
        out = [(at, Feature(self.numeric, self.numeric, None, "num"))]
        if self.has_indicator:
            out.append((at + 1, Feature(self.numeric + MISSING_SUFFIX, self.numeric + MISSING_SUFFIX, None, "ind")))
        return out

    def level_features(self) -> DataFrame:
        """column_name, level and idx (index of the feature) of every encoded level."""
        first = 1 if self.drop_first else 0
        offset = F.create_map(*[F.lit(x) for c, o in self.offsets().items() for x in (c, o)])
        return self.dictionary.where(F.col("position") >= first).select(
            "column_name", "level", (F.element_at(offset, F.col("column_name")) + F.col("position") - first).cast("int").alias("idx"))

    def references(self) -> DataFrame:
        """column_name and reference: the first level of every column."""
        return self.dictionary.where("position = 0").select("column_name", F.col("level").alias("reference"))

    def features(self) -> list[Feature]:
        out = []
        for c in self.categorical:
            lv = self.levels[c][1:] if self.drop_first else self.levels[c]
            out += [Feature(f"{c}={v}", c, v, "cat") for v in lv]
        out.append(Feature(self.numeric, self.numeric, None, "num"))
        if self.has_indicator:
            out.append(Feature(self.numeric + MISSING_SUFFIX, self.numeric + MISSING_SUFFIX, None, "ind"))
        return out

    def reference(self, column: str) -> str | None:
        lv = self.levels.get(column) or []
        return lv[0] if lv else None


def numbered(levels: DataFrame, by=()) -> DataFrame:
    """Distinct levels (by, column_name, level) with their position in order, from 0 in each column."""
    ranked = running_totals(levels.withColumn("__one", F.lit(1)), F.col("level"), ["__one"], [*by, "column_name"], inclusive=False)
    return ranked.select(*by, "column_name", "level", F.col("cum___one").cast("int").alias("position"))


def _long_levels(rows: DataFrame, categorical, keep=()) -> DataFrame:
    return rows.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("level")) for c in categorical]))).where(F.col("level").isNotNull())


def reference_levels(train: DataFrame, categorical=CATEGORICAL) -> DataFrame:
    """(column_name, level, position): sorted distinct training levels; position 0 is the reference.  NULL is no level."""
    return numbered(_long_levels(train, categorical).distinct())


@dataclass(frozen=True)
class _Moments:
    """Rows, non-NULL values, their mean and population variance; parts can be added."""

    rows: int = 0
    n: int = 0
    mean: float = 0.0
    var: float = 0.0

    def __add__(self, o: "_Moments") -> "_Moments":
        n = self.n + o.n
        if not n:
            return _Moments(self.rows + o.rows)
        d = o.mean - self.mean
        spread = self.n * self.var + o.n * o.var + d * d * self.n * o.n / n
        return _Moments(self.rows + o.rows, n, self.mean + d * o.n / n, spread / n)

    def prepared(self, median: float | None) -> dict:
        """Mean and deviation with the median in the place of NULLs, and of the indicator."""
        whole = self + _Moments(0, self.rows - self.n, median or 0.0, 0.0)
        share = (self.rows - self.n) / self.rows if self.rows else 0.0
        return {"has_indicator": self.rows > self.n, "mean_x": whole.mean, "std_x": math.sqrt(whole.var) or 1.0,
                "mean_i": share, "std_i": math.sqrt(share * (1 - share)) or 1.0, "median": median, "n_rows": self.rows}


def _moments(numeric: str) -> list[Column]:
    x = F.col(numeric)
    return [F.count(F.lit(1)).alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var")]


def _as_moments(r) -> _Moments:
    return _Moments(r["rows"], r["n"], r["mean"] or 0.0, r["var"] or 0.0)


def _prep(dictionary: DataFrame, sizes: dict, moments: _Moments, median, categorical, numeric: str, drop_first: bool) -> Prep:
    return Prep(levels=Levels(dictionary, categorical), drop_first=drop_first, numeric=numeric, categorical=list(categorical),
                dictionary=dictionary, sizes={c: sizes.get(c, 0) for c in categorical}, **moments.prepared(median))


def fit_prep(train: DataFrame, categorical=CATEGORICAL, numeric: str = NUMERIC[0], drop_first: bool = True) -> Prep:
    """Fit the preparation on ``train``: the dictionary is written, only a few scalars come back."""
    dictionary = materialize(reference_levels(train, categorical), train.sparkSession, "levels")
    sizes = {r["column_name"]: r["n"] for r in dictionary.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    row = grouped_stats(train.select(numeric), [], _moments(numeric), {"med": numeric}).first()
    return _prep(dictionary, sizes, _as_moments(row), row["med"], categorical, numeric, drop_first)


def fit_preps(rows: DataFrame, fold: str, k: int, categorical=CATEGORICAL, numeric: str = NUMERIC[0], drop_first: bool = True) -> dict[int, Prep]:
    """The preparation for each held-out fold 0..k-1, fitted on the rows of all other folds; ``rows`` should be a
    written table.  Level counts, moments and median histograms are taken per fold, once, and added up."""
    spark = rows.sparkSession
    n, spread = F.count(F.lit(1)), F.array(*[F.lit(i) for i in range(k)])
    counts = _long_levels(rows, categorical, [fold]).groupBy("column_name", "level").agg(
        n.alias("n"), *[F.count_if(F.col(fold) == i).alias(f"n{i}") for i in range(k)])
    left = F.filter(spread, lambda i: F.col("n") > F.element_at(F.array(*[F.col(f"n{j}") for j in range(k)]), i + 1))
    dictionary = materialize(numbered(counts.select("column_name", "level", F.explode(left).alias("held")), ["held"]), spark, "levels")
    sizes: dict[int, dict[str, int]] = {i: {} for i in range(k)}
    for r in dictionary.groupBy("held", "column_name").agg(n.alias("n")).collect():  # one row per fold and column
        sizes[r["held"]][r["column_name"]] = r["n"]
    parts = {r[fold]: _as_moments(r) for r in rows.groupBy(fold).agg(*_moments(numeric)).collect()}  # one row per fold

    def others(d: DataFrame, columns) -> DataFrame:
        return d.select(*columns, F.explode(F.filter(spread, lambda i: i != F.col(fold))).alias("held"))
    medians = {r["held"]: r["med"] for r in rollup_stats(rows.select(fold, numeric), [fold], ["held"], others, [], {"med": numeric}).collect()}
    return {i: _prep(dictionary.where(F.col("held") == i).drop("held"), sizes[i], sum((m for f, m in parts.items() if f != i), _Moments()),
                     medians.get(i), categorical, numeric, drop_first) for i in range(k)}


class LevelIndexer(Transformer, MLWritable, MLReadable):
    """Pipeline stage: adds for each column the number of its level by a join with the dictionary
    (column_name, level, number).  The reference, unseen levels and NULL get ``sizes[column]``, which a one-hot
    encoder that drops its last category encodes as all zeros.  Saved with the dictionary as a table beside it."""

    def __init__(self, dictionary: DataFrame | None = None, sizes: dict[str, int] | None = None):
        super().__init__()
        self.dictionary, self.sizes = dictionary, dict(sizes or {})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for c, size in self.sizes.items():
            own = self.dictionary.where(F.col("column_name") == c).select(F.col("level").alias("__of"), F.col("number").alias("__number_of"))
            number = F.coalesce(F.col("__number_of"), F.lit(size)).cast("double")
            told = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
            out = out.join(own, out[c] == own["__of"], "left").select(*out.columns, number.alias(INDEX + c, metadata=told))
        return out

    def write(self) -> MLWriter:
        return _LevelIndexerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LevelIndexerReader(cls)


class _LevelIndexerWriter(MLWriter):
    def __init__(self, stage: LevelIndexer):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"sizes": json.dumps(self.stage.sizes)})
        self.stage.dictionary.write.parquet(f"{path}/dictionary")


class _LevelIndexerReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LevelIndexer:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls(self.sparkSession.read.parquet(f"{path}/dictionary"), json.loads(metadata["sizes"]))
        stage._resetUid(metadata["uid"])
        return stage


def level_indexer(prep: Prep) -> LevelIndexer:
    first = 1 if prep.drop_first else 0
    numbers = prep.dictionary.where(F.col("position") >= first).select("column_name", "level", (F.col("position") - first).alias("number"))
    return LevelIndexer(numbers, {c: prep.encoded(c) for c in prep.categorical if prep.encoded(c)})


def numeric_exprs(prep: Prep) -> list[Column]:
    """The standardised number and, if there is one, the indicator."""
    x = F.coalesce(F.col(prep.numeric), F.lit(prep.median).cast("double"))
    out = [(x - F.lit(prep.mean_x)) / F.lit(prep.std_x)]
    if prep.has_indicator:
        out.append((F.col(prep.numeric).isNull().cast("double") - F.lit(prep.mean_i)) / F.lit(prep.std_i))
    return out


def preparation(prep: Prep) -> list:
    """Pipeline stages from the feature columns to the vector ``features``, in the order of ``Prep.offsets``."""
    indexer = level_indexer(prep)
    columns = list(indexer.sizes)
    stages = [indexer]
    if columns:
        stages.append(OneHotEncoder(inputCols=[INDEX + c for c in columns], outputCols=[f"__hot_{c}" for c in columns], dropLast=True))
    x = f"coalesce(`{prep.numeric}`, CAST({_sql_lit(prep.median)} AS DOUBLE))"
    parts = [f"({x} - {_sql_lit(prep.mean_x)}D) / {_sql_lit(prep.std_x)}D AS {NUMBERS[0]}"]
    if prep.has_indicator:
        parts.append(f"(CAST(`{prep.numeric}` IS NULL AS DOUBLE) - {_sql_lit(prep.mean_i)}D) / {_sql_lit(prep.std_i)}D AS {NUMBERS[1]}")
    stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"))
    stages.append(VectorAssembler(inputCols=[f"__hot_{c}" for c in columns] + list(NUMBERS[:len(parts)]), outputCol="features"))
    return stages


def cell_stages(prep: Prep, train: DataFrame) -> list:
    """Stages after ``preparation`` that add the vector ``binned``: ``features`` with the number's bin in the place of
    the number.  The cuts are quantiles of all training rows."""
    numeric = f"coalesce(`{prep.numeric}`, CAST({_sql_lit(prep.median)} AS DOUBLE))"
    cuts = sorted(set(train.select(F.expr(numeric).alias("x")).approxQuantile("x", [i / BINS for i in range(1, BINS)], 1e-3)))
    hot = [f"__hot_{c}" for c in prep.categorical if prep.encoded(c)]
    return [SQLTransformer(statement=f"SELECT *, {numeric} AS __x FROM __THIS__"),
            Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="__x", outputCol="__bin", handleInvalid="keep"),
            SQLTransformer(statement="SELECT *, __bin + 0D AS __place FROM __THIS__"),  # a number: bins are marked as categories without order
            VectorAssembler(inputCols=[*hot, "__place", *(NUMBERS[1:] if prep.has_indicator else ())], outputCol="binned")]


def cell_parts(prep: Prep) -> list[Column]:
    """What ``binned`` is made of, after ``cell_stages``: ``hot``, the index of each column's feature that is 1 (the number of
    the levels' features where none is), and ``numbers``, the values of the features after them."""
    offsets = prep.offsets()
    hot = [F.when(F.col(INDEX + c) < prep.encoded(c), F.col(INDEX + c) + offsets[c]).otherwise(offsets[prep.numeric]).cast("int")
           for c in prep.categorical if prep.encoded(c)]
    return [F.array(*hot).cast("array<int>").alias("hot"), F.array("__place", *(NUMBERS[1:] if prep.has_indicator else ())).alias("numbers")]


def cells(vectors: DataFrame) -> DataFrame:
    """(binned, its parts, label, weight): the rows of each cell counted; their number is bounded by the levels, not by the rows."""
    parts = [c for c in ("hot", "numbers") if c in vectors.columns]
    return materialize(vectors.groupBy("binned", *parts, "label").agg(F.count(F.lit(1)).cast("double").alias("weight")), vectors.sparkSession, "cells")


def vectors_of(rows: DataFrame, prep: Prep, columns, train: DataFrame, estimator_names) -> tuple[DataFrame, list[str]]:
    """``columns`` of ``rows`` with their vectors, written, and the models among those named that learn from cells."""
    by_cell = [n for n in estimator_names if n in CELL_MODELS and prep.n_rows >= CELL_ROWS]
    stages = preparation(prep) + (cell_stages(prep, train) if by_cell else [])
    ready = Pipeline(stages=stages).fit(rows).transform(rows)
    kept = (["binned"] if by_cell else []) + (cell_parts(prep) if "random_forest" in by_cell else [])
    return materialize(ready.select(*columns, "features", *kept), rows.sparkSession, "vectors"), by_cell


def fit_classifier(estimator, train: DataFrame, its_cells: DataFrame | None = None):
    """The estimator fitted on rows with vectors, or on their cells."""
    if its_cells is None:
        return without_summary(estimator.fit(train))
    if isinstance(estimator, RandomForestClassifier):
        return fit_forest(estimator, its_cells) if fits_a_task(its_cells) else without_summary(estimator.fit(train))
    return without_summary(estimator.setFeaturesCol("binned").setWeightCol("weight").fit(its_cells))


def feature_exprs(prep: Prep) -> list[tuple[Feature, Column]]:
    x = F.coalesce(F.col(prep.numeric), F.lit(prep.median).cast("double"))
    out = []
    for f in prep.features():
        if f.kind == "cat":
            e = F.when(F.col(f.column) == F.lit(f.category), F.lit(1.0)).otherwise(F.lit(0.0))
        elif f.kind == "num":
            e = (x - F.lit(prep.mean_x)) / F.lit(prep.std_x)
        else:
            e = (F.col(prep.numeric).isNull().cast("double") - F.lit(prep.mean_i)) / F.lit(prep.std_i)
        out.append((f, e))
    return out


def transform(df: DataFrame, prep: Prep, prefix: str = "f") -> tuple[DataFrame, list[str]]:
    """Add one double column per feature (``f0``, ``f1``, …): a narrow projection, for few levels."""
    exprs = feature_exprs(prep)
    names = [f"{prefix}{i}" for i in range(len(exprs))]
    return df.select("*", *[e.alias(n) for (_, e), n in zip(exprs, names)]), names


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(v))


def prep_sql_transformer(prep: Prep, prefix: str = "f") -> tuple[SQLTransformer, list[str]]:
    """The fitted preparation as one persistable ``SQLTransformer`` stage with a column per feature, for few levels."""
    parts, names = [], []
    x = f"coalesce(`{prep.numeric}`, CAST({_sql_lit(prep.median)} AS DOUBLE))"
    for i, f in enumerate(prep.features()):
        n = f"{prefix}{i}"
        names.append(n)
        if f.kind == "cat":
            parts.append(f"CASE WHEN `{f.column}` = {_sql_lit(f.category)} THEN 1.0D ELSE 0.0D END AS {n}")
        elif f.kind == "num":
            parts.append(f"({x} - {_sql_lit(prep.mean_x)}D) / {_sql_lit(prep.std_x)}D AS {n}")
        else:
            parts.append(f"(CAST(`{prep.numeric}` IS NULL AS DOUBLE) - {_sql_lit(prep.mean_i)}D) / "
                         f"{_sql_lit(prep.std_i)}D AS {n}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"), names


def candidate_estimators(n_rows: int) -> dict:
    """The four compared classifiers (label column ``label``, features ``features``)."""
    return {
        "logistic_regression": LogisticRegression(
            regParam=1.0 / max(n_rows, 1), elasticNetParam=0.0, standardization=False, maxIter=1000,
            tol=1e-10, fitIntercept=True),
        "decision_tree": DecisionTreeClassifier(maxDepth=5, impurity="gini", seed=SEED),
        "random_forest": RandomForestClassifier(numTrees=300, maxDepth=8, featureSubsetStrategy="sqrt", seed=SEED),
        "gradient_boosting": GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=SEED),
    }


def without_summary(model):
    """A fitted classifier without its training summary.  A summary holds the session, which cannot be sent to tasks
    any more once anything has been observed in it (``quality.measured_write``): scoring would fail."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def build_pipeline(prep: Prep, estimator) -> Pipeline:
    return Pipeline(stages=[*preparation(prep), estimator])


def with_label(df: DataFrame, label: str = "at_risk") -> DataFrame:
    return df.withColumn("label", F.col(label).cast("double"))


def positive_probability(pred: DataFrame) -> Column:
    return vector_to_array(F.col("probability"))[1]


@dataclass
class LinearModel:
    """A fitted linear model: ``levels`` (column_name, level, idx, coef) is a written table of all encoded levels,
    ``numbers`` the numeric features with their index and coefficient."""

    prep: Prep
    levels: DataFrame
    numbers: list[tuple[int, Feature, float]]
    intercept: float
    pipeline: PipelineModel | None = None

    @property
    def coefs(self) -> list[float]:
        """All coefficients in the order of the features."""
        return [r["coef"] for r in self.levels.orderBy("idx").select("coef").collect()] + [c for _, _, c in self.numbers]


def train_logistic(train: DataFrame, drop_first: bool = True) -> LinearModel:
    """Fit preparation + logistic regression on all training rows (one Spark ML fit)."""
    spark = train.sparkSession
    prep = fit_prep(train, drop_first=drop_first)
    lr = candidate_estimators(prep.n_rows)["logistic_regression"]
    pm = build_pipeline(prep, lr).fit(with_label(train))
    fitted = [float(c) for c in without_summary(pm.stages[-1]).coefficients.toArray()]
    numbers = prep.numeric_features()
    table = spark.createDataFrame(list(enumerate(fitted[:numbers[0][0]])), "idx int, coef double")
    levels = materialize(prep.level_features().join(table, "idx").select("column_name", "level", "idx", "coef"), spark, "coefficients")
    return LinearModel(prep, levels, [(i, f, fitted[i]) for i, f in numbers], float(pm.stages[-1].intercept), pm)


def with_contributions(df: DataFrame, model: LinearModel) -> tuple[DataFrame, list[tuple[str, str]]]:
    """``df`` with two columns (index, contribution to the logit) for each input column, and their names.

    A row has at most one hot level per categorical column, so that column's contribution is the hot level's
    coefficient, found by a join with the level table; the reference, unseen levels and NULL contribute 0 and have no index."""
    out, names = df, []
    for j, c in enumerate(model.prep.categorical):
        own = model.levels.where(F.col("column_name") == c).select(F.col("level").alias("__of"), F.col("idx").alias(f"__i{j}"), F.col("coef").alias("__coef"))
        out = out.join(own, out[c] == own["__of"], "left").select(
            *out.columns, f"__i{j}", F.coalesce("__coef", F.lit(0.0)).alias(f"__c{j}"))
        names.append((f"__i{j}", f"__c{j}"))
    for (i, _, coef), x in zip(model.numbers, numeric_exprs(model.prep)):
        j = len(names)
        out = out.withColumns({f"__i{j}": F.lit(i), f"__c{j}": F.lit(float(coef)) * x})
        names.append((f"__i{j}", f"__c{j}"))
    return out, names


def loss_gradient(train: DataFrame, model: LinearModel, label: str = "at_risk") -> DataFrame:
    """(feature, gradient, n_rows): the derivative of the summed log-loss plus ½‖w‖² by each
    coefficient, at the model, in one aggregate over the rows: a level's is a sum over its rows."""
    rows, names = with_contributions(train, model)
    z = sum((F.col(c) for _, c in names), F.lit(float(model.intercept)))
    off = logistic(z) - F.col(label)
    cats = names[:len(model.prep.categorical)]
    terms = [F.struct(F.col(i).alias("idx"), F.col("__off").alias("g")) for i, _ in cats]
    terms += [F.struct(F.lit(i).alias("idx"), (F.col("__off") * x).alias("g")) for (i, _, _), x in zip(model.numbers, numeric_exprs(model.prep))]
    sums = rows.withColumn("__off", off).select(F.inline(F.array(*terms))).where(F.col("idx").isNotNull()).groupBy("idx").agg(F.sum("g").alias("g"))
    spark = train.sparkSession
    named = model.levels.select("idx", F.concat("column_name", F.lit("="), "level").alias("feature"), "coef").unionByName(
        spark.createDataFrame([(i, f.name, float(c)) for i, f, c in model.numbers], "idx int, feature string, coef double"))
    return named.join(sums, "idx", "left").select(
        "feature", (F.coalesce("g", F.lit(0.0)) + F.col("coef")).alias("gradient"), F.lit(model.prep.n_rows).cast("bigint").alias("n_rows"))


def save_model(model: LinearModel, path: str) -> str:
    model.pipeline.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


#: Training rows that are fitted at once, over all fits: each holds its rows in memory.
FIT_ROWS = 40_000_000


@dataclass(frozen=True)
class Candidate:
    """A model to compare: its name in the result, its estimator, and whether its features leave out the first levels."""

    name: str
    estimator: str
    drop_first: bool = False


def without_first(prep: Prep) -> list[int]:
    """The indices of the features of a preparation with all levels that remain without the first level of each column."""
    offsets = prep.offsets()
    first = {offsets[c] for c in prep.categorical if prep.sizes[c]}
    return [i for i in range(offsets[prep.numeric] + len(prep.numeric_features())) if i not in first]


def cross_validate(train: DataFrame, estimator_names, k: int = 5, drop_first: bool = False,
                   key: str = "upc", label: str = "at_risk", model_name: str | None = None,
                   parallelism: int = 8) -> DataFrame:
    """Out-of-fold probabilities of every named estimator: (model, key, fold, label, score) for every row and model."""
    return cross_validate_all(train, [Candidate(model_name or n, n, drop_first) for n in estimator_names], k, key, label, parallelism)


def cross_validate_all(train: DataFrame, candidates, k: int = 5, key: str = "upc", label: str = "at_risk",
                       parallelism: int = 8) -> DataFrame:
    """Out-of-fold probabilities of every candidate.

    Folds are stratified on the label; for each fold the preparation is that of the
    other folds (``fit_preps``: all from one pass), its vectors are written once and shared by all
    candidates, and each candidate is fitted and scores the held-out fold.  Where some leave out the first
    levels and others do not, theirs are slices of the written vectors.  Returns
    (model, key, fold, label, score) for every row and model.
    The driver only orchestrates: every fit and score is a Spark job, and up to
    ``parallelism`` (fold, model) fits are submitted at once (as ``CrossValidator``'s
    ``parallelism`` does), so small fits do not leave the cluster idle; of large ones only as many as keep to
    ``FIT_ROWS`` rows, which stay in the executors' memory.
    """
    from concurrent.futures import ThreadPoolExecutor

    from projectpulse.operators.evaluate import stratified_folds
    spark = train.sparkSession
    candidates = list(candidates)
    estimator_names = [c.estimator for c in candidates]
    all_dropped = all(c.drop_first for c in candidates)
    folded = materialize(stratified_folds(train, key, label, k), spark, "cv-folds")
    preps = fit_preps(folded, "fold", k, drop_first=all_dropped)

    def vectors(i: int) -> tuple[DataFrame, list[str], DataFrame | None]:
        rows, by_cell = vectors_of(with_label(folded, label), preps[i], [key, "fold", "label"], folded.where(F.col("fold") != i), estimator_names)
        return rows, by_cell, cells(rows.where(F.col("fold") != i)) if by_cell else None

    def fit_one(task):
        i, c = task
        rows, by_cell, its_cells = encoded[i]
        if c.drop_first and not all_dropped:
            if c.estimator in by_cell:
                raise ValueError(f"{c.estimator} learns from cells, which hold all levels")
            rows = VectorSlicer(inputCol="features", outputCol="__slice", indices=without_first(preps[i])).transform(rows).select(
                key, "fold", "label", F.col("__slice").alias("features"))
        fitted = fit_classifier(candidate_estimators(preps[i].n_rows)[c.estimator], rows.where(F.col("fold") != i),
                                its_cells if c.estimator in by_cell else None)
        pred = fitted.transform(rows.where(F.col("fold") == i))
        return pred.select(F.lit(c.name).alias("model"), key, "fold",
                           F.col("label").cast("int").alias("label"), positive_probability(pred).alias("score"))

    most = max((p.n_rows for p in preps.values()), default=0)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        encoded = list(pool.map(vectors, range(k)))
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, FIT_ROWS // max(most, 1)))) as pool:
        parts = list(pool.map(fit_one, [(i, c) for i in range(k) for c in candidates]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
