from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabml.operators import features as fe


def test_category_map_order_ties_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)],
                               "k string")
    m = [(r["value"], r["index"], r["n"]) for r in fe.category_map(df, "k").orderBy("index").collect()]
    assert m == [("c", 0, 2), ("a", 1, 1), ("b", 2, 1)]


def test_category_map_equals_string_indexer(spark):
    p = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    model = fe.indexer(["p_brand"], ["i"]).fit(p)
    labels = model.labelsArray[0]
    m = fe.category_map(p, "p_brand").orderBy("index").collect()
    assert [r.value for r in m] == list(labels)


def test_dense_index_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(13)
    out = fe.dense_index(df, [F.col("v").desc()], "i").collect()
    pairs = sorted((r.i, r.v) for r in out)
    assert [i for i, _ in pairs] == list(range(5000))
    vs = [v for _, v in pairs]
    assert vs == sorted(vs, reverse=True)


def test_unseen_category_keep_vs_error(spark):
    train = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("x", 3.0)], "k string, n double")
    test = spark.createDataFrame([("z", 1.0), ("x", 2.0)], "k string, n double")
    keep = Pipeline(stages=fe.feature_stages(["k"], ["n"], handle_invalid="keep")).fit(train)
    rows = keep.transform(test).select("k_idx").collect()
    assert sorted(r.k_idx for r in rows) == [0.0, 2.0]   # unseen -> extra index
    err = Pipeline(stages=fe.feature_stages(["k"], ["n"], handle_invalid="error")).fit(train)
    try:
        err.transform(test).collect()
        raised = False
    except Exception:
        raised = True
    assert raised


def test_one_hot_assemble_and_names(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0), ("c", 4.0)], "k string, n double")
    out = Pipeline(stages=fe.feature_stages(["k"], ["n"], handle_invalid="error")).fit(df).transform(df)
    names = fe.feature_names(out)
    assert names[0] == "n" and len(names) == 3
    flat = fe.vector_columns(out, "features", 3, keep=("k",)).collect()
    for r in flat:
        assert r.f1 == (1.0 if r.k == "a" else 0.0)
        assert r.f2 == (1.0 if r.k == "b" else 0.0)
    back = fe.index_to_value(out.select("k_idx").distinct(), "k_idx")
    assert {r.value for r in back.collect()} == {"a", "b", "c"}
