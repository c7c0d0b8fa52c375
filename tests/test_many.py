"""Many models in one scan, sparse pivots, NaN correlations, and the line stream."""

import datetime as dt
import math
import os
import tempfile

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabml.operators import metrics as me, models as mo, stats as st
from tabml.streaming import logstream as ls


def test_many_models_as_each_alone(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    data = VectorAssembler(inputCols=["l_quantity", "l_tax"], outputCol="features").transform(
        li.withColumn("label", F.col("l_extendedprice")))
    fits = [mo.fit_linear(data, reg=r) for r in (0.0, 100.0, 1e4)]
    many = {r.model: r for r in me.many_regression_metrics(data.withColumn("s", me.linear_scores(fits)), "s", 3).collect()}
    for i, m in enumerate(fits):
        one = me.regression_metrics(m.transform(data)).first()
        assert all(math.isclose(many[i][c], one[c], rel_tol=1e-9) for c in ("n", "r2", "rmse", "mse", "mae"))
    data = data.withColumn("label", (F.col("l_extendedprice") > 40000).cast("double"))
    fits = [mo.fit_logistic(data, reg=r) for r in (0.0, 0.1)]
    scored = data.withColumn("s", me.linear_scores(fits, probability=True))
    for bins in (200, 1_000_000):
        rows = {r.model: r for r in me.many_auc(scored, "s", bins=bins).collect()}
        for i, m in enumerate(fits):
            exact = BinaryClassificationEvaluator(numBins=0).evaluate(m.transform(data))
            assert rows[i].n == 6000 and abs(rows[i].auc - exact) <= rows[i].bound + 1e-12
    assert rows[0].bound < 0.01


def test_auc_edges(spark):
    t = spark.createDataFrame([(1, [0.9, 0.5]), (0, [0.1, None]), (None, [0.3, 0.3])], "label int, s array<double>")
    rows = {r.model: r for r in me.many_auc(t, "s").collect()}
    assert (rows[0].n, rows[0].auc, rows[0].bound) == (2, 1.0, 0.0)
    assert rows[1].n == 1 and rows[1].auc is None              # one class only
    assert me.many_auc(t.limit(0), "s").count() == 0


def test_sparse_pivot_as_the_dense_one(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn(
        "event_type", F.when(F.col("event_id") % 17 != 0, F.col("event_type")))
    dense = {r.user_id: r for r in st.pivot_sum(ev, "user_id", "event_type", "value").collect()}
    for r in st.pivot_sparse(ev, "user_id", "event_type", "value").collect():
        row = dense[r.user_id].asDict()
        for k, v in row.items():
            if k != "user_id":
                assert (v is None and r.sums.get(k) is None) or math.isclose(v, r.sums[k])
    wide = spark.range(50_000).select((F.col("id") % 3).alias("r"), F.col("id").alias("c"), F.lit(1.0).alias("v"))
    assert [len(x.sums) for x in st.pivot_sparse(wide, "r", "c", "v").orderBy("r").collect()] == [16667, 16667, 16666]


def test_nan_and_constant_alike_at_any_width(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in rng.normal(size=3)) + (float("nan") if i == 3 else float(i), 2.0)
            for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    small = {(r.col_a, r.col_b): r["corr"] for r in st.corr_matrix(df).collect()}
    monkeypatch.setattr(st, "FUSED_COLUMNS", 2)
    wide = {(r.col_a, r.col_b): r["corr"] for r in st.corr_matrix(df).collect()}
    assert set(small) == set(wide) and len(small) == 25
    for k, v in small.items():
        w = wide[k]
        assert (v is None and w is None) or (math.isnan(v) and math.isnan(w)) or math.isclose(v, w, abs_tol=1e-12), (k, v, w)
    assert math.isnan(small[("a", "d")]) and math.isnan(small[("d", "d")]) and small[("a", "e")] is None


def test_line_stream_restarts_and_counts_late_lines(spark):
    base = tempfile.mkdtemp(prefix="tabml-lines-")
    src, out, ck = (os.path.join(base, x) for x in ("in", "out", "ck"))
    os.mkdir(src)

    def put(name, lines):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(lines))

    def line(day, hour, level="INFO"):
        return f"{level},{dt.datetime(2026, 1, day, hour).strftime('%a %b %d %H:%M:%S UTC %Y')}"

    def run():
        ls.start_line_job(spark, src, out, ck, watermark="1 hour").awaitTermination(120)

    put("1.txt", [line(1, 10), line(1, 11), line(5, 12, "WARN"), "nonsense", line(2, 3).replace("Jan", "Foo")])
    run()
    put("2.txt", [line(1, 12), line(5, 13), "9x,Thu Jan 01 00:00:00 UTC 2026"])      # day 1 closed long ago
    run()
    run()                                                      # nothing new
    counts = {(r.window_start.day, r.level): r.n for r in ls.line_counts(spark, out).collect()}
    assert counts == {(1, "INFO"): 2, (5, "WARN"): 1, (5, "INFO"): 1}
    assert sorted(r.reason for r in ls.bad_lines(spark, out).collect()) == ["bad date", "bad level", "no separator"]
    stats = spark.read.parquet(f"{out}/stats").agg(*[F.sum(c) for c in ("lines", "bad", "late")]).first()
    assert tuple(stats) == (8, 3, 1)
