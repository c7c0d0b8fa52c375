"""NULLs in every statistic, and other edges that once gave wrong answers."""

import math

from tabml.operators import metrics as me, models as mo, recommend as rc, split as sp


def test_regression_metrics_use_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (9.0, None), (None, 4.0)], "label double, prediction double")
    r = me.regression_metrics(df).first()
    assert (r.n, r.rmse, r.r2) == (2, 1.0, 0.0) and me.incomplete_pairs(df).first().incomplete == 2
    assert me.regression_metrics(df.limit(0)).first().rmse is None


def test_accuracy_agrees_with_class_rates(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, None), (None, 1.0), (0.0, None)], "label double, prediction double")
    assert me.accuracy(df).first().accuracy == 0.5
    rates = {r["class"]: r for r in me.class_rates(df).collect()}
    assert rates[None].tp == 1 and rates[None].fn == 1 and rates[None].fp == 1 and rates[0.0].accuracy == 0.5


def test_key_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3), ("b", 4)], "k string, n int")
    assert sum(p.count() for p in sp.hash_split(df, "k", [0.5, 0.5])) == 4
    assert sum(p.count() for p in sp.hash_split(df, ["k", "n"], [0.5, 0.5])) == 4
    assert sp.with_split(df, "k", [0.5, 0.5]).filter("part is null").count() == 0


def test_clusters(spark):
    df = spark.createDataFrame([([0.0, 1.0], 0), ([2.0, 1.0], 0)], "x array<double>, k int")
    assert me.silhouette(df, "x", "k").first().silhouette is None
    s = me.sse(df, "x", "k").first()
    assert (s.n, s.sse) == (2, 2.0) and me.cluster_means(df, "x", "k").first().center == [1.0, 1.0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = me.sse(df, "x", "k")._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bad_vectors_do_not_stop_the_scorer(spark):
    u = spark.createDataFrame([(1, [1.0, math.nan]), (2, [1.0, 0.0]), (3, None), (4, [1.0, None])], "id long, features array<double>")
    i = spark.createDataFrame([(7, [1.0, 1.0]), (8, [2.0, 1.0]), (9, None)], "id long, features array<double>")
    got = {(r.user, r["rank"]): r.item for r in rc.top_k_from_factors(u, i, 2).collect()}
    assert got[2, 1] == 8 and got[2, 2] == 7 and {x for x, _ in got} == {1, 2}


def test_wide_recommender_ids(spark):
    from tabml.plans.jobs import recommend_courses
    big = 1 << 34
    rows = [(big + u, big * 2 + i, float((u * i) % 5)) for u in range(6) for i in range(8) if (u + i) % 3]
    out = recommend_courses(spark.createDataFrame(rows, "u long, i long, r double"), "u", "i", "r", k=3).collect()
    recs = [r for r in out if r.source == "recommended"]
    assert {r.user for r in recs} == {big + u for u in range(6)} and all(r.item >= big * 2 for r in recs)


def test_pin_keeps_the_scans_partitions(spark):
    df = spark.range(0, 1000, 1, 3)
    a, b = mo.pin(df), mo.pin(df, partitions=5)
    assert a.rdd.getNumPartitions() == 3 and b.rdd.getNumPartitions() == 5
    a.unpersist(), b.unpersist()
