"""A random forest learned from counted cells.

A forest draws each row for each tree by itself, a Poisson number with mean 1.  Rows that are equal in everything a tree
can see are one to it, and the draws of w such rows add up to a Poisson number with mean w: so a cell of w rows is drawn
as a whole, and a tree learns from the drawn cells as it would from the drawn rows.

Trees grow as MLlib's do: at each node a fresh subset of √F features, the split with the largest gain of Gini impurity
among theirs, none without gain; two leaves beside each other that predict the same class become one.  Trees are dealt
over tasks, each of which holds all cells, so cells and features are bounded (``CELLS``, ``FEATURES``).  The result is
MLlib's own model: the nodes take the place of those of a saved model, which is loaded again.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectpulse.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Cells and features up to which a task holds all cells, and groups over which the trees are dealt.
CELLS, FEATURES, GROUPS = 1_000_000, 10_000, 24
NODES = ("treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
         "leftChild int, rightChild int, featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int")


def gini(stats: np.ndarray) -> np.ndarray:
    """Impurity by the last axis (weight of class 0, of class 1); 0 where there is no weight."""
    total = stats.sum(-1)
    return np.where(total > 0, 1 - (stats ** 2).sum(-1) / np.maximum(total, 1) ** 2, 0.0)


def grow(hot: np.ndarray, numbers: list[np.ndarray], label: np.ndarray, weight: np.ndarray, n_hot: int, max_depth: int, rng) -> list[dict]:
    """One tree as a list of nodes, the root first.

    ``hot`` holds for each cell and column the index of the feature that is 1, or ``n_hot`` where all are 0; ``numbers``
    the values of each further feature.  ``weight`` are the rows of the cells, from which ``rng`` draws."""
    places = [np.unique(x, return_inverse=True) for x in numbers]
    n_features = n_hot + len(numbers)
    # Candidates: the features of the levels, then the gaps between the values of each number.
    feature = np.concatenate([np.arange(n_hot), *(np.full(len(v) - 1, n_hot + j) for j, (v, _) in enumerate(places))]).astype(np.int64)
    first = np.concatenate([[n_hot], n_hot + np.cumsum([len(v) - 1 for v, _ in places])]).astype(np.int64)
    subset = min(n_features, math.ceil(math.sqrt(n_features)))
    draw = rng.poisson(weight).astype(np.float64)
    cells = np.flatnonzero(draw)
    at = np.zeros(len(cells), np.int64)  # each cell's place among the nodes that may still be split

    def counted(key: np.ndarray, width: int, nodes: int) -> np.ndarray:
        """(node, key, class): drawn rows."""
        return np.bincount((at * width + key) * 2 + label[cells], draw[cells], nodes * width * 2).reshape(nodes, width, 2)

    def node(stats: np.ndarray) -> dict:
        return {"stats": stats, "gain": -1.0, "left": -1, "right": -1, "feature": -1, "values": [], "categories": -1}
    tree = [node(counted(np.zeros(len(cells), np.int64), 1, 1)[0, 0])]
    growing = [0] if gini(tree[0]["stats"]) > 0 else []
    for depth in range(max_depth):
        m = len(growing)
        if not m:
            break
        total = np.array([tree[i]["stats"] for i in growing])[:, None, :]
        levels = sum((counted(hot[cells, c], n_hot + 1, m) for c in range(hot.shape[1])), np.zeros((m, n_hot + 1, 2)))
        left = np.concatenate([total - levels[:, :n_hot], *(counted(code[cells], len(v), m).cumsum(1)[:, :-1] for v, code in places)], 1)
        right = total - left
        n_left, n_right, n = left.sum(-1), right.sum(-1), total.sum(-1)
        gain = np.where((n_left > 0) & (n_right > 0), gini(total) - (n_left * gini(left) + n_right * gini(right)) / n, -1.0)
        chosen = np.zeros((m, n_features), bool)
        np.put_along_axis(chosen, np.argpartition(rng.random((m, n_features)), subset - 1, 1)[:, :subset], True, 1)
        gain = np.where(chosen[:, feature], gain, -1.0)
        best = gain.argmax(1) if gain.shape[1] else np.zeros(m, np.int64)
        goes_on = np.full((m, 2), -1, np.int64)
        next_growing = []
        for j in np.flatnonzero(gain[np.arange(m), best] > 0) if gain.shape[1] else ():
            b, own = int(best[j]), tree[growing[j]]
            f = int(feature[b])
            own |= {"gain": float(gain[j, b]), "feature": f, "values": [0.0], "categories": 2}
            if f >= n_hot:
                values, gap = places[f - n_hot][0], b - first[f - n_hot]
                own |= {"values": [float(values[gap] + values[gap + 1]) / 2], "categories": -1}
            for side, (name, stats) in enumerate((("left", left[j, b]), ("right", right[j, b]))):
                own[name] = len(tree)
                if depth + 1 < max_depth and stats.min() > 0:
                    goes_on[j, side] = len(next_growing)
                    next_growing.append(len(tree))
                tree.append(node(stats))
        by = best[at]  # the split that each cell meets
        to_right = (hot[cells] == by[:, None]).any(1)
        for j, (_, code) in enumerate(places):
            here = (by >= first[j]) & (by < first[j + 1])
            to_right = np.where(here, code[cells] > by - first[j], to_right)
        at = goes_on[at, to_right.astype(np.int64)]
        cells, at = cells[at >= 0], at[at >= 0]
        growing = next_growing
    return tree


def pruned(tree: list[dict]) -> list[dict]:
    """The tree with two leaves of one parent that predict the same class made one, and its nodes numbered again."""
    for own in reversed(tree):  # children come after their parent
        if own["left"] >= 0:
            a, b = tree[own["left"]], tree[own["right"]]
            if a["left"] < 0 and b["left"] < 0 and a["stats"].argmax() == b["stats"].argmax():
                own |= {"gain": -1.0, "left": -1, "right": -1, "feature": -1, "values": [], "categories": -1}
    order = [0]
    for i in order:
        if tree[i]["left"] >= 0:
            order += [tree[i]["left"], tree[i]["right"]]
    number = {i: n for n, i in enumerate(order)} | {-1: -1}
    return [tree[i] | {"left": number[tree[i]["left"]], "right": number[tree[i]["right"]]} for i in order]


def rows_of(tree: list[dict], number: int) -> list[tuple]:
    return [(number, i, float(n["stats"].argmax()), float(gini(n["stats"])), n["stats"].tolist(), int(n["stats"].sum()), n["gain"],
             n["left"], n["right"], n["feature"], n["values"], n["categories"]) for i, n in enumerate(tree)]


def fits_a_task(cells: DataFrame) -> bool:
    """Whether a task can hold these cells."""
    one = cells.select("binned").first()
    return one is not None and one["binned"].size <= FEATURES and cells.count() <= CELLS


def fit_forest(estimator: RandomForestClassifier, cells: DataFrame) -> RandomForestClassificationModel:
    """The forest fitted on cells (binned, hot, numbers, label, weight); it scores the vectors ``binned``."""
    if estimator.getFeatureSubsetStrategy() != "sqrt" or estimator.getImpurity() != "gini":
        raise ValueError("a forest from cells takes subsets of √F features and the Gini impurity")
    spark = cells.sparkSession
    one = cells.first()
    n_columns, n_numbers, size = len(one["hot"]), len(one["numbers"]), one["binned"].size
    n_hot, n_trees, max_depth, seed = size - n_numbers, estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed() % 2 ** 63
    groups = min(GROUPS, n_trees)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([c for c in pdf.columns if c != "weight"], ignore_index=True)  # trees do not depend on the cells' order
        hot = np.stack([pdf[f"h{c}"].to_numpy(np.int64) for c in range(n_columns)], 1) if n_columns else np.empty((len(pdf), 0), np.int64)
        numbers = [pdf[f"x{j}"].to_numpy(np.float64) for j in range(n_numbers)]
        label, weight = pdf["label"].to_numpy(np.int64), pdf["weight"].to_numpy(np.float64)
        out = []
        for t in range(int(pdf["group"].iloc[0]), n_trees, groups):
            out += rows_of(pruned(grow(hot, numbers, label, weight, n_hot, max_depth, np.random.default_rng([seed, t]))), t)
        return pd.DataFrame(out, columns=[c.split()[0] for c in NODES.split(", ")])
    dealt = cells.select(*[F.col("hot")[c].alias(f"h{c}") for c in range(n_columns)], *[F.col("numbers")[j].alias(f"x{j}") for j in range(n_numbers)],
                         "label", "weight", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")).repartition(groups, "group")
    nodes = dealt.groupBy("group").applyInPandas(learn, NODES)
    split = F.struct("featureIndex", "leftCategoriesOrThreshold", "numCategories").alias("split")
    data = F.struct("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", split).alias("nodeData")
    # A model without splits, saved, gives all but the nodes.
    path, empty = scratch_path(spark, "forest"), Vectors.sparse(size, [], [])
    estimator.setFeaturesCol("binned").fit(spark.createDataFrame([(empty, 0.0), (empty, 1.0)], ["binned", "label"])).save(path)
    nodes.select("treeID", data).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
