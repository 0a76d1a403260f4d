"""Operator semantics on hand-made micro tables (the traps of the survey) and on the
driver's sf0.001 tables."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from projectpulse.functions import scalar as S
from projectpulse.operators import evaluate as E
from projectpulse.operators import kpi, quality as Q, variance
from projectpulse.operators.cleaning import ColumnSpec, reject_report, stage
from projectpulse.operators.features import bucket_rare, OTHER
from projectpulse.operators.merge import merge_with_provenance
from projectpulse.operators.quantiles import grouped_stats
from projectpulse.sources.readers import read_table


def test_merge_provenance_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a", 10.0), (2, "b", None), (None, "n", 5.0)], "k long, d string, x double")
    right = spark.createDataFrame([(2, "B", 7.0), (3, "C", 8.0), (None, "m", 1.0)], "k long, d string, y double")
    out = merge_with_provenance(left, right, "k", [("d", "d", "d"), ("v", "x", "y")])
    rows = sorted((r.k if r.k is not None else -1, r.data_source, r.d, r.v) for r in out.collect())
    assert rows == [(-1, "dashboard_only", "m", 1.0), (-1, "dashboard_only", "n", 5.0),
                    (1, "syip_only", "a", 10.0), (2, "both", "b", 7.0), (3, "dashboard_only", "C", 8.0)]


def test_cuts_keep_null_dimension_as_own_group(spark):
    df = spark.createDataFrame([("x", "G"), (None, "R"), (None, "G")], "district string, s string")
    out = kpi.multi_cut_agg(df, ["district"], [F.count(F.lit(1)).alias("n")], ["district"])
    got = {(r.cut_type, r.cut_value): r.n for r in out.collect()}
    assert got == {("overall", "ALL"): 3, ("district", "x"): 1, ("district", None): 2}


def test_exact_median_matches_builtin_on_skewed_groups(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    # one group holds most rows: every return flag but 'R' goes to the hot group
    df = li.select(F.when(F.col("l_returnflag") == "R", "cold").otherwise("hot").alias("g"),
                   F.col("l_extendedprice").alias("v"), F.col("l_quantity").alias("q"))
    ours = grouped_stats(df, ["g"], [F.count(F.lit(1)).alias("n")], {"mv": "v", "mq": "q"})
    ref = df.groupBy("g").agg(F.median("v").alias("mv"), F.median("q").alias("mq"))
    a = {r.g: (r.mv, r.mq) for r in ours.collect()}
    b = {r.g: (r.mv, r.mq) for r in ref.collect()}
    for g in b:
        assert a[g][0] == pytest.approx(b[g][0], rel=1e-12)
        assert a[g][1] == pytest.approx(b[g][1], rel=1e-12)


def test_exact_median_rescue_path(spark, sf_dir, monkeypatch):
    """A bracket that misses the middle rank falls back to the exact per-group path."""
    import projectpulse.operators.quantiles as qmod

    class BadSketch:
        def __getattr__(self, name):
            return getattr(F, name)

        @staticmethod
        def percentile_approx(col, probs, acc):
            return F.array(F.max(col), F.max(col))  # bracket at the top: middle rank missed

    monkeypatch.setattr(qmod, "F", BadSketch())
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    ours = {r.l_returnflag: r.m for r in qmod.grouped_stats(li, ["l_returnflag"], medians={"m": "l_quantity"}).collect()}
    monkeypatch.undo()
    ref = {r.l_returnflag: r.m for r in li.groupBy("l_returnflag").agg(F.median("l_quantity").alias("m")).collect()}
    assert ours == pytest.approx(ref)


def test_global_median_even_and_odd(spark):
    for vals in ([1, 2, 3, 4], [5, 1, 3], [7]):
        df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v long")
        got = grouped_stats(df, [], [F.count(F.lit(1)).alias("n")], {"m": "v"}).first()
        s = sorted(vals)
        n = len(s)
        want = (s[(n - 1) // 2] + s[n // 2]) / 2
        assert got.m == want and got.n == len(vals) + 1


def test_dedup_first_orders_nulls_last_and_counts(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "y"), (1, 3, "z"), (2, None, "w")], "c long, upc long, a string")
    out = {r.c: (r.a, r.project_count) for r in variance.dedup_first(df, "c", "upc", drop=("upc",)).collect()}
    assert out == {1: ("z", 3), 2: ("w", 1)}


def test_calendar_day_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 23), dt.datetime(2020, 1, 2, 1))], "a timestamp, b timestamp")
    assert df.select(S.calendar_day_diff("a", "b").alias("d")).first().d == 1


def test_parse_timestamp_one_digit_hour_and_noon(spark):
    df = spark.createDataFrame([(" 7/4/2021 12:00:00 AM",), ("7/4/2021 1:05:00 PM",), ("12/31/2020 12:30:00 PM",)], "t string")
    got = [r.d for r in df.select(S.parse_timestamp("t").alias("d")).collect()]
    assert got == [dt.datetime(2021, 7, 4, 0, 0), dt.datetime(2021, 7, 4, 13, 5), dt.datetime(2020, 12, 31, 12, 30)]


def test_strict_cast_fails_lenient_cast_reports(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,)], "x string")
    spec = [ColumnSpec("x", "x", "double")]
    with pytest.raises(Exception):
        stage(df, spec).collect()
    assert [r.x for r in stage(df, spec, lenient=True).collect()] == [1.5, None, None]
    assert reject_report(df, spec).first().n_rejected == 1


def test_trim_removes_nbsp_but_not_tab(spark):
    df = spark.createDataFrame([("  a  ",), ("\tb",)], "s string")
    assert [r.t for r in df.select(S.trim_chars("s").alias("t")).collect()] == ["a", "\tb"]


def test_log_positive_and_safe_ratio(spark):
    df = spark.createDataFrame([(0.0, 2.0), (-1.0, 0.0), (math.e, None)], "x double, y double")
    rows = df.select(S.log_positive("x").alias("l"), S.safe_ratio("x", "y").alias("r")).collect()
    assert [r.l for r in rows] == [None, None, pytest.approx(1.0)]
    assert [r.r for r in rows] == [0.0, None, None]


def test_score_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (0.005,), (0.015,)], "p double")
    got = [r.s for r in df.select(S.score_0_100(F.col("p")).alias("s")).collect()]
    assert got == [round(0.125 * 100), round(0.135 * 100), round(0.005 * 100), round(0.015 * 100)]


def test_bucket_rare_null_and_unseen(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "t string")
    q = spark.createDataFrame([("A",), (None,)], "cut_value string")
    got = sorted((r.t or "", r.b) for r in bucket_rare(df, "t", q, "b").collect())
    assert got == [("", OTHER), ("A", "A"), ("B", OTHER)]


def test_stratified_folds_balanced(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    f = E.stratified_folds(o, "o_orderkey", "y")
    counts = {(r.y, r.fold): r.n for r in f.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    for y in (0, 1):
        sizes = [counts.get((y, k), 0) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_auc_matches_pairwise_brute_force(spark):
    random.seed(7)
    rows = [(i, random.randint(0, 1), round(random.random(), 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    brute = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert E.roc_auc(df).first().roc_auc == pytest.approx(brute, abs=1e-12)
    pts = E.roc_points(df).orderBy(F.col("threshold").desc()).collect()
    assert pts[-1].tpr == pytest.approx(1.0) and pts[-1].fpr == pytest.approx(1.0)


def test_expect_single_pass_rules(spark):
    df = spark.createDataFrame([(1, "G"), (2, None), (2, "X")], "k long, s string")
    out = {r.rule: (r.observed, r.passed) for r in Q.expect(df, [
        Q.row_count(1, 10), Q.null_count("s"), Q.non_null_share("s", 0.5)]).collect()}
    assert out["row_count"] == (3.0, True)
    assert out["null_count:s"] == (1.0, False)
    assert out["non_null_share:s"][0] == pytest.approx(2 / 3)
    assert Q.unique_key(df, "k").first().observed == 1.0
    assert Q.domain(df, "s", ["G", "Y", "R"]).first().observed == 1.0


def test_running_totals_keep_rows_with_null_keys_and_groups(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (None, 1), (4, None), (None, None), (6, 0)], "k long, y int")
    f = E.stratified_folds(df, "k", "y")
    assert f.count() == 6
    assert sorted(str(r.y) + str(r.n) for r in f.groupBy("y").agg(F.count("fold").alias("n")).collect()) == ["02", "12", "None2"]


def test_auc_rejects_null_scores_and_is_null_for_one_class(spark):
    rows = [(1, 0.5), (0, None), (0, 0.2)]
    with pytest.raises(Exception, match="NULL"):
        E.roc_auc(spark.createDataFrame(rows, "label int, score double")).collect()
    one = spark.createDataFrame([(1, 0.5), (1, 0.2)], "label int, score double")
    assert E.roc_auc(one).first().roc_auc is None
    assert [r.fpr for r in E.roc_points(one).collect()] == [None, None]


def test_strict_cast_fails_without_ansi(spark):
    df = spark.createDataFrame([("abc", "13/45/2020 1:00:00 AM")], "x string, t string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for spec in (ColumnSpec("x", "x", "double"), ColumnSpec("t", "t", "ts_text_date")):
            with pytest.raises(Exception, match="is not a"):
                stage(df, [spec]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_medians_of_odd_data(spark):
    """Hot values, wide ranges, signs, infinitely close values, NULL groups and one-row groups."""
    random.seed(3)
    rows = [("hot", 7.0)] * 500 + [("hot", float(i)) for i in range(90)]
    rows += [("wide", random.choice([-1, 1]) * 10.0 ** random.randint(-300, 300)) for _ in range(401)]
    rows += [("close", 1.0 + i * 2.0**-52) for i in range(50)] + [(None, 3.0), (None, 4.0), ("one", -0.5), ("null", None)]
    rows += [("big", 1.7e308), ("big", -1.7e308), ("big", 5.0)]
    out = {r.g: r.m for r in grouped_stats(spark.createDataFrame(rows, "g string, v double"), ["g"], [], {"m": "v"}).collect()}
    for g in {r[0] for r in rows}:
        v = sorted(x for k, x in rows if k == g and x is not None)
        want = None if not v else v[(len(v) - 1) // 2] + (v[len(v) // 2] - v[(len(v) - 1) // 2]) * 0.5
        assert out[g] == want, g


def test_level_with_quote_and_backslash_in_saved_pipeline(spark):
    from projectpulse.operators import model as M
    level = "a\\b'c\\"
    prep = M.Prep({"t": ["x", level]}, True, "v", 0.0, False, 0.0, 1.0, 0.0, 1.0, ["t"])
    df = spark.createDataFrame([(level, 1.0), ("x", 2.0)], "t string, v double")
    sqlt, names = M.prep_sql_transformer(prep)
    assert [r[names[0]] for r in sqlt.transform(df).collect()] == [1.0, 0.0]


def test_no_local_scratch_folder_on_a_cluster():
    from projectpulse.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError, match="share"):
        ensure_checkpoint_dir(Session())


def _middle(values):
    """The interpolated median with NaN after all numbers, as SQL orders it."""
    v = sorted(values, key=lambda x: (math.isnan(x), x))
    a, b = v[(len(v) - 1) // 2], v[len(v) // 2]
    return a if a == b else a * 0.5 + b * 0.5


def _same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def _odd_doubles():
    import struct
    rnd = random.Random(11)
    bits = [rnd.getrandbits(64) for _ in range(3000)]
    out = [struct.unpack("<d", struct.pack("<Q", b))[0] for b in bits]
    out += [s * 2.0**e * f for s in (-1, 1) for e in range(-1074, 1024, 7) for f in (1.0, 1.0 + 2**-52, 2.0 - 2**-52)]
    return [x for x in out if not math.isinf(x)] + [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 2.0**-1022, 1.7976931348623157e308]


def test_order_key_keeps_the_order_of_all_doubles(spark):
    import struct

    from projectpulse.operators.quantiles import key_value, order_key
    values = _odd_doubles()
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None)], "i int, v double").select("i", order_key(F.col("v")).alias("k"))
    for r in got.select("i", "k", key_value(F.col("k")).alias("v")).collect():
        if r.i < 0:
            assert r.k is None
            continue
        v = values[r.i]
        assert _same(r.v, v)
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert r.k == ((2047 << 52) + 1 if math.isnan(v) else -bits if v < 0 else bits), v


@pytest.mark.parametrize("small", [0, 40, 1 << 16])
def test_medians_of_any_doubles_in_six_passes(spark, monkeypatch, small):
    """NaN, infinities, heavy tails and values one bit apart; rounds are counted by the tables they write."""
    import projectpulse.operators.quantiles as qmod
    rnd = random.Random(5)
    inf, nan = math.inf, math.nan
    groups = {"nan": [1.0, 2.0, nan], "nans": [nan, nan, 3.0], "half nan": [1.0, nan], "inf": [1.0, inf], "infs": [inf, inf, 0.0], "both": [-inf, inf],
              "tail": [10.0**-k for k in range(298)], "spread": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(400)],
              "close": [1.0 + k * 2.0**-52 for k in range(60)], "tiny": [k * 5e-324 for k in range(-20, 21)], "zero": [0.0, -0.0, 0.0, -0.0],
              "any": [v for v in _odd_doubles()], "hot": [7.0] * 800 + [float(k) for k in range(90)], "null": [None, None]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    written = []
    monkeypatch.setattr(qmod, "SMALL", small)
    monkeypatch.setattr(qmod, "materialize", lambda df, s, name, real=qmod.materialize: written.append(name) or real(df, s, name))
    out = {r.g: r.m for r in qmod.grouped_stats(spark.createDataFrame(rows, "g string, v double"), ["g"], [], {"m": "v"}).collect()}
    for g, vs in groups.items():
        want = _middle(vs) if vs[0] is not None else None
        assert _same(out[g], want), (g, out[g], want)
    assert written.count("median-parts") + written.count("median-groups") <= 6


@pytest.mark.parametrize("small", [0, 1 << 16])
def test_cut_rollup_equals_repeated_rows(spark, monkeypatch, small):
    """Rolled up from cells or from rows repeated per cut: the same, NULL dimensions and odd values included."""
    import projectpulse.operators.quantiles as qmod
    monkeypatch.setattr(qmod, "SMALL", small)
    rnd = random.Random(8)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["x", "y", "z", None]), rnd.choice([None, float(rnd.randint(-9, 9)), rnd.gauss(0, 1e6)]),
             rnd.randint(0, 3) or None) for _ in range(700)] + [("c", "x", None, None), ("d", "x", math.nan, 1)]
    df = spark.createDataFrame(rows, "p string, q string, v double, w int")
    dims = ["p", ("second", "q")]
    got = kpi.cut_rollup(df, dims, [qmod.Stat("n", "count"), qmod.Stat("n_one", "count", F.col("w") == 1), qmod.Stat("mean", "mean", F.col("w"))],
                         medians={"mv": "v", "mw": "w"}).collect()
    cuts = {("overall", "ALL"): rows}
    for name, i in (("p", 0), ("second", 1)):
        for value in {r[i] for r in rows}:
            cuts[name, value] = [r for r in rows if r[i] == value]
    assert {(r.cut_type, r.cut_value) for r in got} == set(cuts) and len(got) == len(cuts)
    for r in got:
        own = cuts[r.cut_type, r.cut_value]
        v, w = [x[2] for x in own if x[2] is not None], [x[3] for x in own if x[3] is not None]
        assert (r.n, r.n_one) == (len(own), sum(x == 1 for x in w))
        assert r["mean"] == (pytest.approx(sum(w) / len(w)) if w else None)
        assert _same(r.mv, _middle(v) if v else None) and r.mw == (_middle([float(x) for x in w]) if w else None)


@pytest.mark.parametrize("range_rows", [1, 7, 50, 10**6])
def test_running_totals_over_ranges(spark, range_rows):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, *range(40)]), rnd.randint(0, 5), i) for i in range(160)]
    df = spark.createDataFrame(rows, "g string, k long, x long, i long").repartition(5)
    for inclusive in (True, False):
        got = {r.i: (r.cum_x, r.cum_i) for r in E.running_totals(df, [F.col("k"), F.col("i")], ["x", "i"], ["g"], inclusive, range_rows).collect()}
        for g, k, x, i in rows:
            before = [r for r in rows if r[0] == g and ((r[1] is not None, r[1] or 0, r[3]) < (k is not None, k or 0, i) or inclusive and r[3] == i)]
            assert got[i] == (sum(r[2] for r in before), sum(r[3] for r in before))


def test_equal_order_values_are_spread_over_ranges(spark):
    """One order value, or NULL, on all rows: every position is taken once, and no range holds more than its share."""
    from unittest import mock
    df = spark.range(3000).select("id", F.lit(None).cast("string").alias("k"), F.lit(1).alias("one")).repartition(4)
    written = {}
    real = E.materialize
    with mock.patch.object(E, "materialize", lambda d, s, name: written.setdefault(name, real(d, s, name))):
        out = E.running_totals(df, F.col("k"), ["one"], range_rows=300)
    assert sorted(r.cum_one for r in out.collect()) == list(range(1, 3001))
    sizes = [r["count"] for r in written["prefix-ranges"].groupBy("__range").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 600


def test_curves_over_ranges_equal_one_window(spark, monkeypatch):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.choice("ab"), rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(400)], "m string, label int, score double")
    whole = (sorted(map(tuple, E.roc_points(df, by=["m"]).collect())), sorted(map(tuple, E.roc_auc(df, by=["m"]).collect())), E.roc_auc(df).first())
    monkeypatch.setattr(E, "RANGE_ROWS", 25)
    assert (sorted(map(tuple, E.roc_points(df, by=["m"]).collect())), sorted(map(tuple, E.roc_auc(df, by=["m"]).collect())), E.roc_auc(df).first()) == whole
    f = E.stratified_folds(df.withColumn("id", F.monotonically_increasing_id()), "id", "label").groupBy("label", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in f if r.label == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_scores_that_are_no_numbers_raise(spark):
    with pytest.raises(Exception, match="not a number"):
        E.roc_auc(spark.createDataFrame([(1, 0.5), (0, math.nan)], "label int, score double")).collect()


def test_rules_measured_on_a_write_equal_a_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, "G", 0.5), (2, None, 1.5), (2, "X", None)], "k long, s string, x double").repartition(3)
    rules = [Q.row_count(1, 10), Q.null_count("s"), Q.non_null_share("s", 0.5), Q.out_of_range("x", 0, 1), *Q.min_max("x", 0, 1),
             Q.conditional_count("odd", F.col("k") % 2 == 1, 1, 1), Q.filtered_total("sum", "x", F.col("k") == 2, None, 1.0)]
    path, got = Q.measured_write(df.groupBy("k", "s", "x").count(), rules, lambda d: d.write.parquet(str(tmp_path / "t")) or "written")
    assert path == "written" and spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert got.collect() == Q.expect(df, rules).collect()
    _, empty = Q.measured_write(df.where("k > 9"), rules, lambda d: d.write.parquet(str(tmp_path / "e")))
    assert empty.collect() == Q.expect(df.where("k > 9"), rules).collect()


def test_rules_are_not_measured_when_the_write_fails(spark, tmp_path):
    broken = spark.range(3).select(F.raise_error("no").cast("long").alias("k"))
    with pytest.raises(Exception, match="no"):
        Q.measured_write(broken, [Q.row_count()], lambda d: d.write.parquet(str(tmp_path / "t")))


def test_required_columns_tells_a_missing_one(spark):
    got = {r.column_name: tuple(r) for r in Q.required_columns(spark.createDataFrame([(1, None)], "a int, b string"), ["a", "b", "c"], "in").collect()}
    assert got == {"a": ("in", "a", True, 1, True), "b": ("in", "b", True, 0, True), "c": ("in", "c", False, None, False)}


def test_contract_rows_are_dealt_over_tasks_by_their_number(spark, tmp_path, monkeypatch):
    """Narrow pairs become wide rows: tasks are bounded by rows, not by the bytes read, before and after a shuffle join."""
    from projectpulse.operators import quality as Q, variance
    from projectpulse.plans import build
    from projectpulse.plans.queries import CONSISTENT_COLS
    from projectpulse.sources import fixtures, layout
    monkeypatch.setattr(layout, "TASK_ROWS", 500)
    d = str(tmp_path)
    keys = spark.range(5_000).select((F.col("id") % 1_700).alias("l_orderkey"), (F.col("id") % 90).alias("l_partkey"))
    keys.unionByName(keys.limit(700)).write.parquet(f"{d}/lineitem.parquet")
    spark.range(90).select(F.col("id").alias("p_partkey"), F.lit(2.5).alias("p_retailprice"), F.lit("b").alias("p_brand")).write.parquet(f"{d}/part.parquet")
    pairs = keys.distinct().count()
    for most in (200_000, 10):
        monkeypatch.setattr(fixtures, "BROADCAST_MAX_ROWS", most)
        rows = build.contracts(spark, d)
        shares = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert sum(shares) == pairs and max(shares) <= 1_000 and fixtures.contract_tasks(spark, d) == 12
        want = keys.select((F.col("l_partkey") * 10 + F.col("l_orderkey") % 10).alias("k"), "l_orderkey").distinct().groupBy("k").agg(
            F.min("l_orderkey").alias("upc"), F.count("*").alias("n"))
        got = variance.dedup_first(rows, "contract_id", "upc").select("contract_id", "upc", "project_count")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    hot = rows.withColumn("contract_id", F.when(F.col("upc") % 3 > 0, F.lit(1)).when(F.col("upc") % 2 > 0, F.col("contract_id")))
    for t in (rows, hot):
        assert Q.consistent_within_key(t, "contract_id", CONSISTENT_COLS, 12).first() == Q.consistent_within_key(t, "contract_id", CONSISTENT_COLS).first()
