from pyspark.sql import functions as F

from tabml.operators import prep


def test_fill_zero_touches_numerics_only(spark):
    df = spark.createDataFrame([(None, None, None), ("a", True, 1.5)],
                               "s string, b boolean, n double")
    out = prep.fill_zero(df, ["s", "b", "n"]).orderBy(F.col("n")).collect()
    assert out[0]["s"] is None and out[0]["b"] is None and out[0]["n"] == 0.0
    assert out[1]["n"] == 1.5


def test_ratio_zero_and_null_divisor(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0), (None, 1.0)],
                               "a double, b double")
    got = [r["r"] for r in prep.ratio(df, "r", "a", "b").collect()]
    assert got == [None, None, 1.5, None]


def test_threshold_labels_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,), (2.0,)], "x double")
    out = prep.inverted_label(prep.threshold_label(df, "ge", "x", 1), "inv", "x", 0).collect()
    assert [(r["ge"], r["inv"]) for r in out] == [(0, 1), (0, 1), (1, 0), (1, 0)]


def test_group_categories_case_and_table(spark):
    df = spark.createDataFrame([("GB",), ("DE",), ("XX",), (None,), ("US",)], "k string")
    g = prep.group_categories(df, "k", ["GB", "US"], {"EUROPE": ["DE", "FR"]}, out="g")
    assert [r["g"] for r in g.orderBy(F.col("k").asc_nulls_first()).collect()] == \
        ["OTHER", "EUROPE", "GB", "US", "OTHER"]
    mapping = spark.createDataFrame([("GB", "GB"), ("DE", "EUROPE")], "v string, g string")
    t = prep.group_categories(df, "k", mapping=mapping, out="g")
    assert sorted(r["g"] for r in t.collect()) == ["EUROPE", "GB", "OTHER", "OTHER", "OTHER"]


def test_drop_absent_and_outputs(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "a int, prediction double, probability double")
    assert prep.drop_columns(df, "nope", "a").columns == ["prediction", "probability"]
    assert prep.drop_outputs(df).columns == ["a"]


def test_filters(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, c boolean")
    assert [r.k for r in prep.filter_expr(df, "c = FALSE").collect()] == [2]
    assert [r.k for r in prep.filter_key(df, "k", 3).collect()] == [3]
    assert prep.numeric_columns(df) == ["k"]


def test_mapping_with_duplicate_value_does_not_duplicate_rows(spark):
    df = spark.createDataFrame([("GB",), ("DE",)], "k string")
    mapping = spark.createDataFrame([("GB", "UK"), ("GB", "EU"), ("DE", "EU")], "v string, g string")
    out = sorted((r.k, r.g) for r in prep.group_categories(df, "k", mapping=mapping, out="g").collect())
    assert out == [("DE", "EU"), ("GB", "EU")]
