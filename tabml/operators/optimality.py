"""Optimality of fitted models (F2-F4, F8, F9), each checked in one pass.

A fit is right if it satisfies the conditions of its own minimum, whatever
data it ran on: the subgradient of an elastic net is 0, every k-means row
sits at its nearest centre and every centre is its rows' mean, and every ALS
user solves its regularised normal equations.  Only sums of the model's size
reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dot, sq_dist
from .metrics import _as_array, cluster_means


def _violation(slope: np.ndarray, beta: np.ndarray, l1: float, l2: float) -> float:
    """Largest distance of 0 from the subgradient, over the coefficients."""
    g = slope + l2 * beta
    at = np.where(beta != 0, np.abs(g + l1 * np.sign(beta)), np.maximum(np.abs(g) - l1, 0.0))
    return float(at.max(initial=0.0))


#: Features up to which their sums are columns of one aggregate.
COLUMNS = 64


def _slopes(scored: DataFrame, residual, features: str, label: str, d: int):
    """Means of residual times feature, feature variances, and the label's:
    plain sums for up to ``COLUMNS`` features, which whole-stage codegen adds
    up without making an object a row, else Spark ML's summarizer."""
    x = vector_to_array(F.col(features))
    rows = scored.select(x.alias("x"), residual.alias("r"), F.col(label).cast("double").alias("y"))
    shared = [F.count(F.lit(1)).alias("n"), F.avg("r").alias("r"), F.var_pop("y").alias("vy")]
    if d <= COLUMNS:
        each = [F.get("x", F.lit(j)) for j in range(d)]
        return rows.agg(*shared, F.array(*[F.avg(v * F.col("r")) for v in each]).alias("rx"),
                        F.array(*[F.var_samp(v) for v in each]).alias("vx")).first()
    rows = rows.select("r", "y", array_to_vector("x").alias("x"), array_to_vector(F.transform("x", lambda v: v * F.col("r"))).alias("rx"))
    return rows.agg(*shared, vector_to_array(Summarizer.mean(F.col("rx"))).alias("rx"),
                    vector_to_array(Summarizer.variance(F.col("x"))).alias("vx")).first()


def _report(spark, n: int, violation: float, intercept: float, coef: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(n, violation, intercept, int((coef != 0).sum()))],
                                 "n long, violation double, intercept_violation double, nonzero int")


def linear_kkt(df: DataFrame, model, features: str = "features", label: str = "label") -> DataFrame:
    """``(n, violation, intercept_violation, nonzero)`` of a linear elastic
    net on its training rows: how far the subgradient in scaled units
    (features and label by their population deviations, the penalty by the
    label's) is from 0.  Needs standardised features and an intercept."""
    pred = model.getPredictionCol()
    r = _slopes(model.transform(df.select(features, label)), F.col(pred) - F.col(label).cast("double"), features, label,
                model.numFeatures)
    coef, sy = model.coefficients.toArray(), float(np.sqrt(r.vy))
    sx = np.sqrt(np.array(r.vx) * (r.n - 1) / r.n)
    live = sx > 0
    slope = np.array(r.rx)[live] / (sx[live] * sy)
    reg, alpha = model.getRegParam() / sy, model.getElasticNetParam()
    return _report(df.sparkSession, r.n, _violation(slope, coef[live] * sx[live] / sy, reg * alpha, reg * (1 - alpha)),
                   abs(r.r) / sy, coef)


def logistic_kkt(df: DataFrame, model, features: str = "features", label: str = "label") -> DataFrame:
    """The same for a binary logistic elastic net: features scaled by their
    sample deviations, the penalty as given."""
    p = vector_to_array(F.col(model.getProbabilityCol()))[1]
    r = _slopes(model.transform(df.select(features, label)), p - F.col(label).cast("double"), features, label, model.numFeatures)
    coef, sx = model.coefficients.toArray(), np.sqrt(np.array(r.vx))
    live = sx > 0
    reg, alpha = model.getRegParam(), model.getElasticNetParam()
    return _report(df.sparkSession, r.n,
                   _violation(np.array(r.rx)[live] / sx[live], coef[live] * sx[live], reg * alpha, reg * (1 - alpha)),
                   abs(r.r), coef)


def kmeans_fixed_point(df: DataFrame, model, features: str = "features") -> DataFrame:
    """``(n, misplaced, max_shift)``: rows not at their nearest centre (beyond
    rounding), and the largest distance of a centre from the mean of its
    rows.  Both are 0 at a fixed point of Lloyd's steps.  The centres are
    literals of the model's size; no vector is shuffled."""
    centres = [c.tolist() for c in model.clusterCenters()]
    x = _as_array(model.transform(df), features)
    every = F.array(*[sq_dist("_x", F.array(*[F.lit(v) for v in c])) for c in centres])
    own = F.get("_d", F.col(model.getPredictionCol()))
    placed = x.withColumn("_d", every).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(own > F.array_min("_d") * F.lit(1 + 1e-9) + F.lit(1e-12)).alias("misplaced"))
    means = cluster_means(model.transform(df), features, model.getPredictionCol())
    table = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres])
    shift = means.agg(F.max(F.sqrt(sq_dist("center", F.get(table, F.col("cluster"))))).alias("max_shift"))
    return placed.withColumn("max_shift", shift.scalar())


def als_residuals(ratings: DataFrame, model, user: str, item: str, rating: str, reg: float) -> DataFrame:
    """``(user, n, residual)`` for every user of an explicit ALS fit: after its
    last half step the user's vector u solves sum v (v.u - r) + reg n u = 0
    over the user's n rated items; ``residual`` is the largest component of the
    left side, relative to the largest of sum v r.  The components are plain
    sums, combined map-side, so a user with very many ratings is no single
    task's work.  Ratings without a vector on either side do not count."""
    rank = model.rank
    u = model.userFactors.select(F.col("id").alias("_u"), F.col("features").alias("_uf"))
    v = model.itemFactors.select(F.col("id").alias("_i"), F.col("features").alias("_vf"))
    # the vectors travel as the floats they are
    exact = u.withColumn("_uf", F.col("_uf").cast("array<double>"))
    rows = ratings.select(F.col(user).cast("int").alias("_u"), F.col(item).cast("int").alias("_i"),
                          F.col(rating).cast("float").alias("_r")) \
        .join(v, "_i").join(u, "_u").select("_u", F.col("_uf").cast("array<double>").alias("_uf"),
                                            F.col("_vf").cast("array<double>").alias("_vf"), F.col("_r").cast("double").alias("_r")) \
        .withColumn("_e", dot("_uf", "_vf") - F.col("_r"))
    sums = rows.groupBy("_u").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col("_e") * F.get("_vf", F.lit(j))).alias(f"_g{j}") for j in range(rank)],
        *[F.sum(F.col("_r") * F.get("_vf", F.lit(j))).alias(f"_b{j}") for j in range(rank)])
    left = F.array(*[F.abs(F.col(f"_g{j}") + F.lit(float(reg)) * F.col("n") * F.get("_uf", F.lit(j))) for j in range(rank)])
    right = F.array(*[F.abs(F.col(f"_b{j}")) for j in range(rank)])
    return sums.join(exact, "_u").select(F.col("_u").alias("user"), "n",
                                     (F.array_max(left) / F.greatest(F.array_max(right), F.lit(1e-300))).alias("residual"))
