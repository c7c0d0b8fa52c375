"""Searches by moments against Spark's own fits and evaluators."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabml.operators import features as fe, grams, tuning as tu


def _data(spark, constant=False):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    df = li.withColumn("label", F.col("l_extendedprice") * (1 - F.col("l_discount")) + 1e6) \
        .withColumn("flag", (F.col("l_returnflag") == "R").cast("double")).withColumn("one", F.lit(7.0))
    cols = ["l_extendedprice", "l_discount", "l_tax", "flag"] + ["one"] * constant
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df)


@pytest.mark.parametrize("constant", [False, True])
def test_moments_search_as_sparks_fits(spark, monkeypatch, constant):
    data = _data(spark, constant)
    lr = LinearRegression(tol=1e-12, maxIter=1000)
    grid = tu.param_grid(lr, {"regParam": (0.0, 0.1, 50.0, 1e6), "elasticNetParam": (0.0, 0.5, 1.0), "standardization": (True, False)})
    for metric in ("r2", "rmse"):
        fast = tu.tune(lr, grid, metric, 0.8, key="l_orderkey").fit(data)
        monkeypatch.setattr(grams, "MAX_FEATURES", 2)          # too wide: every candidate is fitted
        slow = tu.tune(lr, grid, metric, 0.8, key="l_orderkey").fit(data)
        monkeypatch.undo()
        assert np.allclose(fast.validationMetrics, slow.validationMetrics, rtol=1e-6, atol=1e-6)
    assert tu.best_model(fast).getRegParam() == tu.best_model(slow).getRegParam()


def test_coefficients_as_sparks(spark):
    data = _data(spark)
    m = grams.moments(data, F.lit("all"))["all"]
    for reg, alpha in ((0.0, 0.0), (100.0, 0.3), (2000.0, 1.0)):
        mine, b = grams.solve(m, reg, alpha)
        model = LinearRegression(regParam=reg, elasticNetParam=alpha, tol=1e-14, maxIter=5000, solver="normal").fit(data)
        assert np.allclose(mine, model.coefficients.toArray(), rtol=1e-4, atol=1e-3) and np.isclose(b, model.intercept, rtol=1e-5)
        assert np.isclose(grams.evaluate(m, mine, b), RegressionEvaluator(metricName="r2").evaluate(model.transform(data)), atol=1e-8)


def test_moments_edges(spark, monkeypatch):
    data = _data(spark).limit(0)
    assert grams.moments(data, F.lit("x")) == {}
    with pytest.raises(ValueError, match="no label"):
        grams.moments(_data(spark).withColumn("label", F.lit(None).cast("double")), F.lit("x"))
    flat = _data(spark).withColumn("label", F.lit(3.0))
    m = grams.moments(flat, F.col("flag") > 0)
    assert set(m) == {"true", "false"}
    coef, b = grams.solve(m["true"], 0.1, 0.5)
    assert not coef.any() and b == 3.0 and np.isnan(grams.evaluate(m["false"], coef, b))
    monkeypatch.setattr(grams, "ROWS_AT_ONCE", 7)              # many pieces, many partial sums
    monkeypatch.setattr(grams, "PARTIALS", 2)
    a, c = (grams.moments(_data(spark).repartition(k), F.lit("x"))["x"] for k in (1, 13))
    assert a.n == c.n and np.allclose(a.centred()[1], c.centred()[1])


def test_vector_columns_keep_every_slot(spark):
    df = _data(spark)
    assert fe.vector_columns(df, "features").columns == ["f0", "f1", "f2", "f3"]
    with pytest.raises(ValueError, match="4 slots, not 2"):
        fe.vector_columns(df, "features", 2)
    from pyspark.ml.linalg import Vectors
    bare = spark.createDataFrame([(Vectors.dense([1.0, 2.0, 3.0]),), (Vectors.sparse(3, [1], [5.0]),)], ["v"])
    with pytest.raises(ValueError, match="pass it"):
        fe.vector_columns(bare, "v")
    assert [tuple(r) for r in fe.vector_columns(bare, "v", 3).collect()] == [(1.0, 2.0, 3.0), (0.0, 5.0, 0.0)]
    with pytest.raises(Exception, match="has not 2 slots but 3"):
        fe.vector_columns(bare, "v", 2).collect()
