"""Model parity: Spark ML logistic regression against an independent numpy Newton solve
of the same objective (sum of log-losses + ½‖w‖², intercept unpenalised)."""

import numpy as np
from pyspark.sql import functions as F

from projectpulse.operators import explain as X, features as FT, model as M
from projectpulse.plans import build


def test_logistic_matches_newton_and_scoring_is_consistent(spark, sf_dir):
    p = build.projects(spark, sf_dir)
    train = FT.training_rows(build.model_features(p)).cache()
    model = M.train_logistic(train)
    enc, names = M.transform(train, model.prep)
    rows = enc.select(*names, "at_risk").collect()
    Xm = np.array([[r[n] for n in names] for r in rows])
    y = np.array([r.at_risk for r in rows], dtype=float)
    Xa = np.hstack([Xm, np.ones((len(y), 1))])
    w = np.zeros(Xa.shape[1])
    pen = np.ones(Xa.shape[1])
    pen[-1] = 0.0
    for _ in range(50):
        pr = 1 / (1 + np.exp(-Xa @ w))
        g = Xa.T @ (pr - y) + pen * w
        H = (Xa * (pr * (1 - pr))[:, None]).T @ Xa + np.diag(pen)
        w -= np.linalg.solve(H, g)
    assert np.allclose(model.coefs, w[:-1], atol=1e-6)
    assert abs(model.intercept - w[-1]) < 1e-6

    scored = X.score_and_explain(train, model).select("upc", "risk_probability")
    ml = model.pipeline.transform(M.with_label(train)).select("upc", M.positive_probability(
        model.pipeline.transform(M.with_label(train))).alias("p"))
    j = scored.join(ml, "upc").agg(F.max(F.abs(F.col("risk_probability") - F.col("p"))).alias("d")).first()
    assert j.d < 1e-9


def test_model_comparison_against_plain_computation(spark):
    import random
    import statistics

    from projectpulse.plans.queries import model_comparison
    rnd = random.Random(9)
    rows = [(m, k % 5, int(rnd.random() < 0.4), round(rnd.random(), 1)) for m in ("noise", "good") for k in range(150)]
    rows = [(m, f, y, 0.3 * s + 0.6 * y if m == "good" else s) for m, f, y, s in rows]

    def plain_auc(part):
        pos, neg = ([s for _, _, y, s in part if y == k] for k in (1, 0))
        return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))

    def plain(part):
        tp, fp, fn = (sum(1 for _, _, y, s in part if (y, s > 0.5) == k) for k in ((1, True), (0, True), (1, False)))
        p, r = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0
        return plain_auc(part), p, r, 2 * p * r / (p + r) if p + r else 0.0
    out = {r.model: r.asDict() for r in model_comparison(spark.createDataFrame(rows, "model string, fold int, label int, score double")).collect()}
    assert set(out) == {"noise", "good"} and out["good"]["beats_floor"] and not out["noise"]["beats_floor"]
    for m, r in out.items():
        own = [x for x in rows if x[0] == m]
        folds = list(zip(*(plain([x for x in own if x[1] == f]) for f in range(5))))
        for name, values in zip(("roc_auc", "precision", "recall", "f1"), folds):
            assert abs(r[f"{name}_mean"] - statistics.mean(values)) < 1e-9 and abs(r[f"{name}_std"] - statistics.pstdev(values)) < 1e-9
        assert abs(r["pooled_roc_auc"] - plain_auc(own)) < 1e-9


def test_trained_tables_are_registered(spark, sf_dir):
    import __spark_entry__ as entry
    queries = entry.queries()
    assert "model_comparison" in queries
    checked = queries["train_logistic"](spark, sf_dir).count()
    assert queries["trained_features"](spark, sf_dir).count() >= checked
    scored = queries["trained_risk_scores"](spark, sf_dir)
    assert {"risk_score", "risk_probability", "top_factors"} <= set(scored.columns)
    assert scored.count() == queries["score_trained"](spark, sf_dir).first().n_scored


def _rows_with_folds(spark, n=600):
    import random
    rnd = random.Random(6)
    rows = []
    for i in range(n):
        fold = i % 5
        t = rnd.choice("abcd") if fold != 3 else rnd.choice(["a", "only three", "b'\\"])
        v = None if rnd.random() < 0.2 else 1e6 + rnd.gauss(0, 1) + fold
        rows.append((i, t, rnd.choice(["x", "y", None]), v, rnd.randint(0, 1), fold))
    rows += [(1000 + i, "a", "x", None, 1, 4) for i in range(9)]
    return spark.createDataFrame(rows, "upc long, t string, r string, v double, at_risk int, fold int")


def test_preparations_of_all_folds_equal_refitting(spark):
    rows = _rows_with_folds(spark)
    for drop_first in (True, False):
        preps = M.fit_preps(rows, "fold", 5, ["t", "r"], "v", drop_first)
        assert sorted(preps) == list(range(5))
        for i, got in preps.items():
            want = M.fit_prep(rows.where(F.col("fold") != i), ["t", "r"], "v", drop_first)
            assert [f.name for f in got.features()] == [f.name for f in want.features()]
            assert (got.sizes, got.has_indicator, got.n_rows, got.median) == (want.sizes, want.has_indicator, want.n_rows, want.median)
            for name in ("mean_x", "std_x", "mean_i", "std_i"):
                assert abs(getattr(got, name) - getattr(want, name)) <= 1e-9 * abs(getattr(want, name)), name
            direct = rows.where(F.col("fold") != i).withColumn("v", F.coalesce("v", F.lit(got.median)))
            mean, std = direct.agg(F.avg("v"), F.stddev_pop("v")).first()
            assert abs(got.mean_x - mean) < 1e-6 and abs(got.std_x - std) < 1e-6
    assert "t=only three" not in [f.name for f in preps[3].features()] and "t=only three" in [f.name for f in preps[0].features()]


def test_folds_without_rows_or_values(spark):
    rows = spark.createDataFrame([(1, "a", None, 0, 0), (2, "b", None, 1, 0), (3, "a", 2.0, 1, 1)], "upc long, t string, v double, at_risk int, fold int")
    preps = M.fit_preps(rows, "fold", 3, ["t"], "v")
    assert (preps[0].n_rows, preps[1].n_rows, preps[2].n_rows) == (1, 2, 3)
    assert preps[1].median is None and preps[0].median == 2.0 and preps[0].sizes == {"t": 1}


def test_many_levels_train_and_score_the_same_from_disk(spark, tmp_path):
    """More levels than a CASE text or a list of literals could hold; unseen levels and NULL score as the reference."""
    n = 30_000
    rows = spark.range(2 * n).select(
        F.col("id").alias("upc"), F.format_string("level '%06d\\", F.col("id") % n).alias("project_type_bucketed"), F.lit("one").alias("road_system_bucketed"),
        (F.col("id") % 3).cast("string").alias("district_bucketed"), F.when(F.col("id") % 5 > 0, (F.col("id") % 17).cast("double")).alias("log_allocated_budget"),
        (F.col("id") % 7 == 0).cast("int").alias("at_risk"), F.lit(1.0).alias("allocated_budget"))
    model = M.train_logistic(rows)
    assert model.prep.sizes == {"project_type_bucketed": n, "road_system_bucketed": 1, "district_bucketed": 3}
    assert model.numbers[0][0] == n + 1 and len(model.coefs) == n + 3
    odd = rows.limit(5).withColumn("project_type_bucketed", F.lit("never seen")).unionByName(rows.limit(5).withColumn("district_bucketed", F.lit(None).cast("string")))
    both = rows.limit(200).unionByName(odd).withColumn("upc", F.monotonically_increasing_id())
    both = spark.createDataFrame(both.collect(), both.schema)
    loaded = M.load_pipeline(M.save_model(model, str(tmp_path / "model")))
    again = loaded.transform(M.with_label(both))
    j = X.score_and_explain(both, model).join(again.select("upc", M.positive_probability(again).alias("p")), "upc").select(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("risk_probability") - F.col("p"))).alias("d")).first()
    assert j.n == 210 and j.d < 1e-9
    gradient = M.loss_gradient(rows, model).agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("gradient")).alias("g")).first()
    assert gradient.n == n + 3 and gradient.g < 1e-6 * 2 * n


def test_models_score_after_something_was_observed(spark):
    """Spark sends a fitted model with its summary, and with it the session, which holds what was observed."""
    from projectpulse.operators import quality as Q
    Q.measured_write(spark.range(3), [Q.row_count()], lambda d: d.write.format("noop").mode("overwrite").save())
    rows = _rows_with_folds(spark, 200).select("upc", F.col("t").alias("project_type_bucketed"), F.lit("x").alias("road_system_bucketed"),
                                               F.lit("y").alias("district_bucketed"), F.col("v").alias("log_allocated_budget"), "at_risk")
    oof = M.cross_validate(rows, ["logistic_regression", "decision_tree"], k=2)
    assert oof.count() == 2 * rows.count()
    model = M.train_logistic(rows)
    assert model.pipeline.transform(M.with_label(rows)).select("probability").count() == rows.count()


def test_trees_from_cells_equal_trees_from_rows(spark, monkeypatch):
    """Rows with equal levels, bin and label, counted: the single tree and the boosted trees are those of the rows, and every row is scored."""
    rows = _rows_with_folds(spark, 900).select(
        "upc", F.col("t").alias("project_type_bucketed"), F.col("r").alias("road_system_bucketed"), F.lit("y").alias("district_bucketed"),
        F.when(F.col("v").isNotNull(), (F.col("upc") % 7).cast("double")).alias("log_allocated_budget"), "at_risk")
    names, seen = ["decision_tree", "gradient_boosting"], []
    fit = M.fit_classifier

    def watched(estimator, train, its_cells=None):
        seen.append((train.count(), its_cells and its_cells.agg(F.count("*"), F.sum("weight")).first()))
        return fit(estimator, train, its_cells)
    monkeypatch.setattr(M, "fit_classifier", watched)
    monkeypatch.setattr(M, "candidate_estimators", lambda n, all_of=M.candidate_estimators: {
        k: e.setMaxIter(5) if k == "gradient_boosting" else e for k, e in all_of(n).items()})
    scores = []
    for least in (1, 10**9):
        monkeypatch.setattr(M, "CELL_ROWS", least)
        scores.append({(r.model, r.upc): (r.fold, r.label, r.score) for r in M.cross_validate(rows, names, k=2).collect()})
    assert [c is not None for _, c in seen] == [True] * 4 + [False] * 4
    assert all(c[1] == n and c[0] < n / 2 for n, c in seen[:4])
    assert scores[0].keys() == scores[1].keys() and len(scores[0]) == 2 * rows.count()
    off = [(k, scores[0][k], scores[1][k]) for k in scores[0] if scores[0][k][:2] != scores[1][k][:2] or abs(scores[0][k][2] - scores[1][k][2]) > 1e-6]
    assert not off, (len(off), off[:9])


def test_models_with_and_without_first_levels_share_folds_and_vectors(spark, monkeypatch):
    """One set of folds, preparations and vectors for both; scores are those of a run for each."""
    rows = _rows_with_folds(spark, 300).select(
        "upc", F.col("t").alias("project_type_bucketed"), F.col("r").alias("road_system_bucketed"), F.lit("y").alias("district_bucketed"),
        F.col("v").alias("log_allocated_budget"), "at_risk")
    calls = []
    for name in ("fit_preps", "vectors_of"):
        def watched(*args, of=getattr(M, name), name=name, **kw):
            calls.append(name)
            return of(*args, **kw)
        monkeypatch.setattr(M, name, watched)
    both = M.cross_validate_all(rows, [M.Candidate("all", "logistic_regression"), M.Candidate("less", "logistic_regression", True)], k=3)
    got = {(r.model, r.upc): (r.fold, r.label, r.score) for r in both.collect()}
    assert sorted(calls) == ["fit_preps"] + ["vectors_of"] * 3
    want = {}
    for name, drop in (("all", False), ("less", True)):
        want |= {(r.model, r.upc): (r.fold, r.label, r.score)
                 for r in M.cross_validate(rows, ["logistic_regression"], k=3, drop_first=drop, model_name=name).collect()}
    assert got.keys() == want.keys() and len(got) == 2 * rows.count()
    assert all(got[x][:2] == want[x][:2] and abs(got[x][2] - want[x][2]) < 1e-9 for x in got)


def test_large_fits_do_not_run_side_by_side(spark, monkeypatch):
    import threading
    rows = _rows_with_folds(spark, 100).select(
        "upc", F.col("t").alias("project_type_bucketed"), F.lit("x").alias("road_system_bucketed"), F.lit("y").alias("district_bucketed"),
        F.col("v").alias("log_allocated_budget"), "at_risk")
    running, most, lock, fit = [0], [0], threading.Lock(), M.fit_classifier

    def watched(*args):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return fit(*args)
        finally:
            with lock:
                running[0] -= 1
    monkeypatch.setattr(M, "fit_classifier", watched)
    monkeypatch.setattr(M, "FIT_ROWS", 60)
    assert M.cross_validate(rows, ["logistic_regression"], k=3).count() == rows.count() and most[0] == 1
