"""The forest from counted cells: MLlib's trees from the rows of the cells, drawn together."""

import random

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from projectpulse.operators import forest, model as M


class WithoutDraws:
    """Each cell with all its rows; F of 2 features is no more than the subset of a node."""

    def poisson(self, weight):
        return weight

    def random(self, shape):
        return np.zeros(shape)


def _score(tree, hot, x):
    at = 0
    while tree[at]["left"] >= 0:
        n = tree[at]
        right = (hot if n["feature"] == 0 else x) > (0.5 if n["feature"] == 0 else n["values"][0])
        at = n["right" if right else "left"]
    return tree[at]["stats"][1] / tree[at]["stats"].sum()


def test_tree_from_cells_is_the_tree_of_their_rows(spark):
    rnd = random.Random(5)
    cells = [(h, float(x), y, rnd.randint(1, 20)) for h in (0, 1) for x in range(12) for y in (0, 1) if rnd.random() < 0.9]
    rows = spark.createDataFrame([(Vectors.dense([h, x]), float(y)) for h, x, y, w in cells for _ in range(w)], ["features", "label"])
    for depth in (2, 4, 8):
        fitted = DecisionTreeClassifier(maxDepth=depth).fit(rows)
        h, x, y, w = (np.array(c) for c in zip(*cells))
        tree = forest.pruned(forest.grow(np.where(h == 1, 0, 1)[:, None], [x], y, w, 1, depth, WithoutDraws()))
        assert len(tree) == fitted.numNodes and tree[0]["stats"].tolist() == [float(w[y == k].sum()) for k in (0, 1)]
        assert all(abs(_score(tree, a, b) - fitted.predictProbability(Vectors.dense([a, b]))[1]) < 1e-12 for a, b, _, _ in cells)


def test_rows_of_a_cell_are_drawn_by_themselves():
    """Draws of 400 rows in one cell vary as those of 400 rows do (variance 400; as one row of weight 400: 160,000)."""
    hot, label = np.zeros((2, 1), np.int64), np.array([0, 1])
    drawn = [forest.grow(hot, [np.array([1.0, 1.0])], label, np.array([400.0, 100.0]), 1, 3, np.random.default_rng([1, t]))[0]["stats"]
             for t in range(2000)]
    assert np.allclose(np.mean(drawn, 0), [400, 100], rtol=0.02) and np.allclose(np.var(drawn, 0), [400, 100], rtol=0.2)


def _rows(spark, n):
    rnd, rows = random.Random(3), []
    for i in range(n):
        t, r, b = rnd.choice("abcde"), rnd.choice(["x", "y", None]), rnd.choice([None, *range(9)])
        p = 0.15 + 0.3 * (t in "ab") + 0.25 * (r == "x") + 0.25 * (b is not None and b > 5)
        rows.append((i, t, r, "one", None if b is None else float(b), int(rnd.random() < p)))
    return spark.createDataFrame(rows, "upc long, project_type_bucketed string, road_system_bucketed string, district_bucketed string, "
                                       "log_allocated_budget double, at_risk int")


def test_forest_learns_from_cells_what_it_learns_from_rows(spark, monkeypatch):
    """Every row is scored once by a forest fitted on counted cells, and as by one fitted on rows but for the draws."""
    rows, seen, fit = _rows(spark, 1000).cache(), [], M.fit_classifier

    def watched(estimator, train, its_cells=None):
        fitted = fit(estimator, train, its_cells)
        seen.append((train.count(), its_cells and its_cells.agg(F.count("*"), F.sum("weight")).first(), fitted))
        return fitted
    monkeypatch.setattr(M, "fit_classifier", watched)
    scores = {}
    for least, seed in ((1, 42), (10**9, 42), (10**9, 7)):
        monkeypatch.setattr(M, "CELL_ROWS", least)
        monkeypatch.setattr(M, "candidate_estimators", lambda n: {
            "random_forest": RandomForestClassifier(numTrees=60, maxDepth=8, featureSubsetStrategy="sqrt", seed=seed)})
        scores[least, seed] = {r.upc: (r.fold, r.label, r.score) for r in M.cross_validate(rows, ["random_forest"], k=2).collect()}
    n, (n_cells, weight), fitted = seen[0]
    assert weight == n and n_cells < n and [c is not None for _, c, _ in seen] == [True, True] + [False] * 4
    assert fitted.getNumTrees == 60 and all(t.depth <= 8 for t in fitted.trees) and len({t.numNodes for t in fitted.trees}) > 5
    assert all(len(s) == rows.count() for s in scores.values())
    a, b, c = scores.values()
    assert all(a[k][:2] == b[k][:2] for k in b)

    def off(x, y):
        return sum(abs(x[k][2] - y[k][2]) for k in y) / len(y)
    assert off(a, b) < 2 * off(b, c) + 0.01, (off(a, b), off(b, c))


def test_forest_does_not_depend_on_the_order_of_cells(spark):
    rows = M.with_label(_rows(spark, 400))
    prep = M.fit_prep(rows, drop_first=False)
    estimator = RandomForestClassifier(numTrees=9, maxDepth=8, featureSubsetStrategy="sqrt", seed=42)
    before = M.CELL_ROWS
    try:
        M.CELL_ROWS = 1
        vectors, by_cell = M.vectors_of(rows, prep, ["label"], rows, ["random_forest"])
    finally:
        M.CELL_ROWS = before
    cells = M.cells(vectors)
    assert by_cell == ["random_forest"] and set(cells.columns) == {"binned", "hot", "numbers", "label", "weight"}
    # What a cell is made of gives its vector.
    for r in cells.collect():
        want = np.zeros(r.binned.size)
        want[[h for h in r.hot if h < r.binned.size - len(r.numbers)]] = 1.0
        want[r.binned.size - len(r.numbers):] = r.numbers
        assert np.allclose(r.binned.toArray(), want)
    debug = [forest.fit_forest(estimator, c).toDebugString.split("\n", 1)[1] for c in (cells, cells.orderBy(F.rand(3)).repartition(5))]
    assert debug[0] == debug[1]


def test_more_cells_than_a_task_holds_are_learned_from_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL_ROWS", 1)
    monkeypatch.setattr(forest, "CELLS", 10)
    monkeypatch.setattr(M, "fit_forest", None)
    monkeypatch.setattr(M, "candidate_estimators", lambda n: {
        "random_forest": RandomForestClassifier(numTrees=5, maxDepth=8, featureSubsetStrategy="sqrt", seed=42)})
    rows = _rows(spark, 300)
    assert M.cross_validate(rows, ["random_forest"], k=2).select("upc").distinct().count() == rows.count()
