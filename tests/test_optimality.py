"""Optimality checks: 0 for finished fits, not 0 for unfinished or altered ones."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabml.operators import models as mo, optimality as op, recommend as rc


def _rows(spark, n=400):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3)) * [1, 10, 100]
    y = x @ [3.0, 0.0, -0.2] + rng.normal(size=n)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(d), float(d > 0), 1.0) for (a, b, c), d in zip(x, y)],
                               "a double, b double, c double, y double, z double, one double")
    return VectorAssembler(inputCols=["a", "b", "c", "one"], outputCol="features").transform(df)


def test_linear_and_logistic(spark):
    df = _rows(spark)
    for reg, alpha in ((0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.5, 1.0)):
        lin = df.withColumnRenamed("y", "label")
        done = op.linear_kkt(lin, mo.fit_linear(lin, reg=reg, enet=alpha, tol=1e-12, max_iter=1000)).first()
        assert done.n == 400 and done.violation < 1e-5 and done.intercept_violation < 1e-8
        log = df.withColumnRenamed("z", "label")
        done = op.logistic_kkt(log, mo.fit_logistic(log, reg=reg / 10 + 0.01, enet=alpha, tol=1e-12, max_iter=1000)).first()
        assert done.violation < 1e-5 and done.intercept_violation < 1e-5
        early = op.logistic_kkt(log, mo.fit_logistic(log, reg=0.01, enet=alpha, max_iter=2)).first()
        assert early.violation > 1e-3
    lasso = op.linear_kkt(lin, mo.fit_linear(lin, reg=3.0, enet=1.0, tol=1e-12)).first()
    assert lasso.nonzero < 3 and lasso.violation < 1e-5
    other = mo.fit_linear(lin, reg=3.0, enet=1.0, tol=1e-12)
    assert op.linear_kkt(lin.filter("a > 0"), other).first().violation > 1e-2      # other rows: no minimum there


def test_slopes_are_plain_sums_and_equal_the_summarizers(spark, monkeypatch):
    log = _rows(spark).withColumnRenamed("z", "label")
    model = mo.fit_logistic(log, reg=0.01, max_iter=2)
    used, summarize = [], op.Summarizer.mean
    monkeypatch.setattr(op.Summarizer, "mean", lambda *a: used.append(1) or summarize(*a))
    few = op.logistic_kkt(log, model).first()
    assert not used                                            # no vector object per row
    monkeypatch.setattr(op, "COLUMNS", 3, raising=False)
    many = op.logistic_kkt(log, model).first()
    assert used and few.n == many.n == 400 and few.nonzero == many.nonzero
    assert abs(few.violation - many.violation) < 1e-12 and abs(few.intercept_violation - many.intercept_violation) < 1e-12


def test_kmeans_fixed_point(spark):
    df = _rows(spark)
    done = op.kmeans_fixed_point(df, mo.fit_kmeans(df, k=4, seed=2, max_iter=500, tol=0.0)).first()
    assert (done.n, done.misplaced) == (400, 0) and done.max_shift < 1e-9
    early = op.kmeans_fixed_point(df, mo.fit_kmeans(df, k=4, seed=2, max_iter=1, init_mode="random")).first()
    assert early.max_shift > 1e-3


def _ratings(spark):
    rng = np.random.default_rng(6)
    rows = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(40) for i in rng.choice(30, 9, replace=False)]
    return spark.createDataFrame(rows, "user int, item int, rating double")


def test_als_normal_equations(spark):
    r = _ratings(spark)
    model = rc.fit_als(r, "user", "item", "rating", rank=5, max_iter=3, reg=0.2)
    out = op.als_residuals(r, model, "user", "item", "rating", 0.2).collect()
    assert len(out) == 40 and all(x.n == 9 and x.residual < 1e-4 for x in out)
    wrong = op.als_residuals(r, model, "user", "item", "rating", 2.0).agg(F.min("residual")).first()[0]
    assert wrong > 1e-3                                        # not the minimum of another penalty


@pytest.mark.parametrize("cold", ["drop", "nan"])
def test_every_held_out_rating_is_accounted_for(spark, cold):
    r = _ratings(spark)
    train = r.filter("user >= 5 and item >= 3 and (user + item) % 4 <> 0")
    held = r.subtract(train).unionByName(spark.createDataFrame([(99, 1, 3.0), (7, None, 2.0)], r.schema))
    row = rc.score_holdout(rc.fit_als(train, "user", "item", "rating", rank=3, max_iter=4, cold_start=cold),
                           train, held, "user", "item", "rating").first()
    users, items = {x.user for x in train.collect()}, {x.item for x in train.collect()}
    rows = held.collect()
    assert row.n == len(rows) == row.scored + row.unknown_user + row.unknown_item + row.unknown_both
    assert row.scored == sum(x.user in users and x.item in items for x in rows)
    assert row.unknown_both == sum(x.user not in users and x.item not in items for x in rows) > 0
    assert row.unknown_user == sum(x.user not in users and x.item in items for x in rows) > 0
    assert 0 < row.mae <= row.rmse < 4
