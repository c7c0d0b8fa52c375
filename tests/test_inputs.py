"""CSV files in place of tables, segmentation from raw columns, the command line."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tabml.plans import catalog, jobs, run
from tabml.sources import table, using


def test_queries_run_on_csv_files(spark, tmp_path):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    li.repartition(3).write.option("header", True).csv(str(tmp_path / "li"))
    want = {r.feature: r.coefficient for r in catalog.QUERIES["linear_ols"](spark, SF001).collect()}
    schema = li.schema.simpleString()[7:-1].replace(":", " ")
    for source in (f"{tmp_path}/li/part-*.csv", (f"{tmp_path}/li", schema)):
        with using({"lineitem": source}):
            assert table(spark, SF001, "lineitem").count() == li.count()
            got = {r.feature: r.coefficient for r in catalog.QUERIES["linear_ols"](spark, SF001).collect()}
        assert got == want
    assert table(spark, SF001, "lineitem").schema == li.schema             # no longer in place
    with pytest.raises(ValueError, match="unknown table"):
        with using({"no_such_table": "x.csv"}):
            pass


def test_command_line_takes_csv(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(run, "build_session", lambda *a, **b: spark)
    spark.read.parquet(f"{SF001}/lineitem.parquet").write.option("header", True).csv(str(tmp_path / "li"))
    out = str(tmp_path / "out")
    assert run.main(["count_by_pair", "--sf-dir", SF001, "--csv", f"lineitem={tmp_path}/li/*.csv", "--out", out]) == 0
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, catalog.QUERIES["count_by_pair"](spark, SF001).collect()))
    assert run.main(["count_by_pair", "--csv", "lineitem"]) == 2


def test_segments_of_raw_columns(spark):
    rows = [("F" if i % 2 else "M", float(10 * (i % 3)) + i / 1000, 5.0) for i in range(60)]
    df = spark.createDataFrame(rows, "gender string, age double, reps double")
    sizes, quality, centres = jobs.segment_columns(df, ["age", "reps"], ["gender"], k=3, seed=1)
    assert sorted(r.n for r in sizes.collect()) == [20, 20, 20]
    q = {r.metric: r.value for r in quality.collect()}
    assert q["silhouette"] > 0.9 and q["sse"] > 0
    assert sorted({round(r.value / 10) * 10 for r in centres.filter("name = 'age'").collect()}) == [0, 10, 20]
    assert {r.name for r in centres.collect()} == {"age", "reps", "gender_vec_F", "gender_vec_M"}
    with pytest.raises(Exception):                                          # a missing number is not a value
        jobs.segment_columns(df.withColumn("age", F.lit(None).cast("double")), ["age"], [], k=2)[0].collect()
