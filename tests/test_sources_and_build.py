"""Sources, sinks and the end-to-end build."""

import os
import tempfile

from pyspark.sql import functions as F

from projectpulse.plans import build
from projectpulse.sources import readers as R


def test_csv_with_bom_quoted_commas_and_line_breaks(spark):
    d = tempfile.mkdtemp(prefix="pp-csv-")
    with open(os.path.join(d, "part-0.csv"), "w", encoding="utf-8") as fh:
        fh.write("\ufeffOBJECTID,UPC,DESCRIPTION,TOTAL\n")
        fh.write('1,101,"Widen road, add lanes",100\n')
        fh.write('2,102,"Two lines\nsecond, with comma",NA\n')
        fh.write("3,103,,N/A\n")
    df = R.read_csv(spark, d, R.string_schema(["OBJECTID", "UPC", "DESCRIPTION", "TOTAL"]), multi_line=True)
    rows = sorted(df.collect(), key=lambda r: r.UPC)
    assert [r.OBJECTID for r in rows] == ["1", "2", "3"]
    assert rows[0].DESCRIPTION == "Widen road, add lanes"
    assert rows[1].DESCRIPTION == "Two lines\nsecond, with comma"
    assert [r.TOTAL for r in rows] == ["100", None, None]
    assert rows[2].DESCRIPTION is None


def test_register_and_query_by_name(spark, sf_dir):
    R.register(build.projects(spark, sf_dir), "projects_view")
    got = {r.data_source: r.n for r in spark.sql(
        "SELECT data_source, count(*) AS n FROM projects_view GROUP BY data_source").collect()}
    assert set(got) == {"both", "syip_only", "dashboard_only"}


def test_build_all_and_score(spark, sf_dir):
    out = tempfile.mkdtemp(prefix="pp-build-")
    paths = build.build_all(spark, sf_dir, out)
    counts = {r.table_name: r.n_rows for r in spark.read.parquet(paths["table_counts"]).collect()}
    assert counts["projects"] == counts["stg_syip"] + counts["stg_dashboard"] - spark.read.parquet(
        paths["projects"]).where(F.col("data_source") == "both").count()
    scored = build.train_and_score(spark, paths["model_features"], out)
    rs = spark.read.parquet(scored["risk_scores"])
    active = spark.read.parquet(paths["model_features"]).where("is_currently_active").count()
    assert rs.count() == active
    assert rs.where("top_factors IS NULL OR trim(top_factors) = ''").count() == 0
    assert rs.where("elevated_risk <> (risk_score >= 60)").count() == 0


def _plain_csv(folder, name, records, newline="\n", header="A,B,C"):
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as fh:
        fh.write("﻿" + header + newline)
        for r in records:
            fh.write(",".join('"' + x.replace('"', '""') + '"' if any(c in x for c in ',"\n\r') else x for x in r) + newline)


def _multi_line(spark, path, schema):
    return (spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


def test_csv_splits_cut_anywhere_give_the_rows_of_the_multi_line_reader(spark, tmp_path):
    """Splits of a few bytes up to the whole file: quotes, line breaks and doubled quotes on every split's edge."""
    import random
    from projectpulse.sources.csv_splits import read_csv_splits
    rnd = random.Random(12)
    bits = ["a", "line\nbreak", 'say "so"', ",", "\n\n", '"', '""', "é", " x ", 'end"\n"start', ""]
    for name in ("one.csv", "two.csv"):
        _plain_csv(tmp_path, name, [(str(i), "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 5))), rnd.choice(["z", "last\nfield"])) for i in range(40)])
    _plain_csv(tmp_path, "long.csv", [("7", "x\n" * 400 + '"', "z"), ("8", "", "z")])
    _plain_csv(tmp_path, "header only.csv", [])
    schema = R.string_schema(["A", "B", "C"])
    want = sorted(map(repr, _multi_line(spark, str(tmp_path), schema).collect()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in (7, 13, 64, 500, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            got = read_csv_splits(spark, str(tmp_path), schema)
            assert sorted(map(repr, got.collect())) == want, size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_csv_splits_one_file_is_many_tasks(spark, tmp_path):
    from projectpulse.sources.csv_splits import _lines
    _plain_csv(tmp_path, "big.csv", [(str(i), "two\nlines", "z") for i in range(3000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        assert _lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_splits_open_quote_and_windows_line_ends(spark, tmp_path):
    import pytest
    from projectpulse.sources.csv_splits import read_csv_splits
    schema = R.string_schema(["A", "B", "C"])
    good, bad, none = tmp_path / "good", tmp_path / "bad", tmp_path / "none"
    for d in (good, bad, none):
        d.mkdir()
    _plain_csv(good, "a.csv", [("1", "x", "y"), ("2", "", "z")], newline="\r\n")
    assert sorted(map(tuple, read_csv_splits(spark, str(good), schema).collect())) == [("1", "x", "y"), ("2", None, "z")]
    (bad / "a.csv").write_text('A,B,C\n1,"open,2\n3,4,5\n')
    with pytest.raises(Exception, match="open quote"):
        read_csv_splits(spark, str(bad), schema).collect()
    (none / "a.csv").write_text("")
    assert read_csv_splits(spark, str(none), schema).collect() == []


def test_failed_replace_leaves_the_old_table(spark, tmp_path):
    import pytest
    from projectpulse.sources.tables import current, read_current, write_table
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        current(spark, path)
    write_table(spark.range(10), path)
    before = read_current(spark, path)
    broken = spark.range(20).select(F.when(F.col("id") < 15, F.col("id")).otherwise(F.raise_error("half way").cast("long")).alias("id")).repartition(7)
    with pytest.raises(Exception, match="half way"):
        write_table(broken, path)
    assert before.count() == read_current(spark, path).count() == 10
    assert sum(n.startswith("v-") for n in os.listdir(path)) == 1


def test_table_replaced_by_a_plan_that_reads_it(spark, tmp_path):
    from projectpulse.sources.tables import read_current, write_table
    path = str(tmp_path / "table")
    write_table(spark.range(5).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    old = read_current(spark, path)
    for n in (2, 3, 4, 5):
        write_table(read_current(spark, path).select((F.col("id") * 2).alias("id"), "p"), path, partition_by=["p"])
        assert sorted(r.id for r in read_current(spark, path).collect()) == [2 ** (n - 1) * i for i in range(5)]
        if n == 2:  # a reader that resolved the table before still reads the old version
            assert sorted(r.id for r in old.collect()) == list(range(5))
    assert sum(x.startswith("v-") for x in os.listdir(path)) == 2 and sum(x.startswith("_current") for x in os.listdir(path)) == 1
