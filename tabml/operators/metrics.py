"""Evaluation (A4, H1-H8) as single-pass aggregates.

The reference evaluates the same holdout three or more times (one job per
metric).  Here all regression metrics come from one aggregate, all class
rates from one confusion-count aggregate, and the clustering metrics from
per-cluster sums (O(n k), never O(n^2) pairs).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dot, sq_dist, sq_norm


def regression_metrics(df: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """H1 / H2 / H3: one row ``(n, r2, rmse, mse, mae)`` from one pass over the
    complete pairs; ``n`` counts those.  Rows without a label or a prediction
    are counted by :func:`incomplete_pairs`.

    R^2 = 1 - SSE / SST with SST = n * var_pop(y), Spark's definition when an
    intercept is fitted.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p                                   # NULL unless both are present
    agg = df.agg(F.count(e).alias("n"), F.sum(e * e).alias("_sse"),
                 F.sum(F.abs(e)).alias("_sae"), F.var_pop(F.when(p.isNotNull(), y)).alias("_vy"))
    return agg.select(
        "n",
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("n") * F.col("_vy"))).alias("r2"),
        F.sqrt(F.try_divide(F.col("_sse"), F.col("n"))).alias("rmse"),
        F.try_divide(F.col("_sse"), F.col("n")).alias("mse"),
        F.try_divide(F.col("_sae"), F.col("n")).alias("mae"))


def incomplete_pairs(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows that a regression metric cannot use, one row ``(incomplete)``."""
    return df.agg(F.count_if(F.col(label).isNull() | F.col(prediction).isNull()).alias("incomplete"))


def metrics_long(metrics_row: DataFrame, dataset: str) -> DataFrame:
    """A4: a one-row metrics table as ``(dataset, metric, value)`` rows."""
    cols = metrics_row.columns
    structs = [F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("metric"),
                        F.col(c).cast("double").alias("value")) for c in cols]
    return metrics_row.select(F.inline(F.array(*structs)))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion matrix in long form ``(label, prediction, n)``; absent
    cells are absent rows."""
    return (df.groupBy(F.col(label).cast("double").alias("label"),
                       F.col(prediction).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """H4-H6: per class ``(class, tp, fn, fp, tn, tpr, fpr, precision,
    specificity, accuracy)``.

    One pass over the data (the confusion counts); everything else runs on
    that table of at most classes^2 rows.  ``tpr`` is recall.  The reference
    printed the specificity of class 0 as "false positives"; here both are
    reported under their own names.  NULL is a class like any other: a NULL
    label guessed NULL is right, and every rate counts all rows.
    """
    # the five uses of ``cm`` sit in one plan, where Spark reuses the single
    # confusion-count exchange; nothing needs to be cached
    cm = confusion(df, label, prediction)
    total = cm.agg(F.sum("n"))
    correct = cm.filter(F.col("label").eqNullSafe(F.col("prediction"))).agg(F.sum("n"))
    actual = cm.groupBy(F.col("label").alias("class")).agg(F.sum("n").alias("_a"))
    predicted = cm.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("_p"))
    tp = (cm.filter(F.col("label").eqNullSafe(F.col("prediction")))
          .select(F.col("label").alias("class"), F.col("n").alias("tp")))
    a = actual.withColumnRenamed("class", "_ca")
    p = predicted.withColumnRenamed("class", "_cp")
    # NULL-safe keys: a NULL label / guess is one class of its own
    t = (a.join(p, a["_ca"].eqNullSafe(p["_cp"]), "full")
         .select(F.coalesce("_ca", "_cp").alias("class"), "_a", "_p")
         .join(tp.withColumnRenamed("class", "_ct"),
               F.col("class").eqNullSafe(F.col("_ct")), "left").drop("_ct")
         .na.fill(0, ["_a", "_p", "tp"])
         .withColumn("_t", total.scalar()))
    return t.select(
        "class", "tp",
        (F.col("_a") - F.col("tp")).alias("fn"),
        (F.col("_p") - F.col("tp")).alias("fp"),
        (F.col("_t") - F.col("_a") - F.col("_p") + F.col("tp")).alias("tn"),
        F.try_divide(F.col("tp"), F.col("_a")).alias("tpr"),
        F.try_divide(F.col("_p") - F.col("tp"), F.col("_t") - F.col("_a")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("_p")).alias("precision"),
        F.try_divide(F.col("_t") - F.col("_a") - F.col("_p") + F.col("tp"),
                     F.col("_t") - F.col("_a")).alias("specificity"),
        F.try_divide(F.coalesce(correct.scalar(), F.lit(0)), F.col("_t")).alias("accuracy"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """H4 / H6: one row ``(n, accuracy)`` over all rows.  As in
    :func:`class_rates`, NULL is a class: it is hit by NULL alone."""
    hit = F.col(label).cast("double").eqNullSafe(F.col(prediction).cast("double")).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def _as_array(df: DataFrame, features: str) -> DataFrame:
    t = df.schema[features].dataType
    if t.typeName() == "vector" or "Vector" in type(t).__name__:
        return df.withColumn("_x", vector_to_array(F.col(features)))
    return df.withColumn("_x", F.col(features).cast("array<double>"))


def cluster_means(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Mean vector per cluster ``(cluster, center array<double>)``: one
    vector summarizer per cluster, whose buffers are combined map-side, so a
    cluster holding most rows is still summed in parallel."""
    x = _as_vector(df, features)
    return x.groupBy(F.col(cluster).alias("cluster")).agg(
        vector_to_array(Summarizer.mean(F.col("_v"))).alias("center"))


def _as_vector(df: DataFrame, features: str) -> DataFrame:
    x = _as_array(df, features)
    return x.withColumn("_v", array_to_vector("_x"))


def sse(df: DataFrame, features: str, cluster: str, centers: DataFrame | None = None) -> DataFrame:
    """H8: within-cluster sum of squared distances per cluster
    ``(cluster, n, sse)``.  ``centers`` is ``(cluster, center)``; by default
    the mean of each cluster.  The k centres are carried as a scalar subquery,
    so no vector is shuffled."""
    if centers is None:
        centers = cluster_means(df, features, cluster)
    x = _as_array(df, features).select(F.col(cluster).alias("cluster"), "_x")
    table = centers.agg(F.collect_list(F.struct(
        F.col("cluster").alias("k"), F.col("center").cast("array<double>").alias("c"))))
    # NULL-safe: rows of a cluster missing from ``centers`` stay counted and
    # give a NULL sse, and a NULL cluster label meets its own centre
    own = F.try_element_at(F.filter("_cl", lambda c: c["k"].eqNullSafe(F.col("cluster"))), F.lit(1))
    return (x.withColumn("_cl", table.scalar()).withColumn("_own", own["c"])
            .groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(sq_dist("_x", F.col("_own"))).alias("sse")))


def silhouette(df: DataFrame, features: str = "features", cluster: str = "prediction") -> DataFrame:
    """H7: mean silhouette with squared Euclidean distance, Spark's
    definition, as one row ``(n, silhouette)``.

    For point x and cluster C the mean squared distance is
    ||x||^2 + S_C / n_C - 2 x . m_C with S_C = sum ||y||^2 and m_C the mean,
    so only per-cluster sums are needed (k rows, gathered once as a scalar
    subquery), never pairs of points.  The own-cluster mean is rescaled by
    n_C / (n_C - 1) to leave the point itself out; a singleton scores 0.  With
    fewer than two clusters the metric is undefined, and NULL.  The number of
    clusters must be that of a model (their sums are one row).
    """
    x = _as_vector(df, features).select(F.col(cluster).cast("double").alias("_k"), "_x", "_v")
    x = x.withColumn("_nx", sq_norm("_x"))
    clusters = x.groupBy("_k").agg(F.count(F.lit(1)).alias("n"), F.sum("_nx").alias("sq"),
                                   vector_to_array(Summarizer.sum(F.col("_v"))).alias("sum_vec"))
    table = clusters.agg(F.collect_list(F.struct("_k", "n", "sq", "sum_vec")).alias("cl"))
    scored = x.withColumn("cl", table.scalar())

    def mean_dist(c):
        return (F.col("_nx") + c["sq"] / c["n"]
                - F.lit(2.0) * dot("_x", c["sum_vec"]) / c["n"])

    own = F.try_element_at(F.filter("cl", lambda c: c["_k"].eqNullSafe(F.col("_k"))), F.lit(1))
    others = F.transform(F.filter("cl", lambda c: ~c["_k"].eqNullSafe(F.col("_k"))), mean_dist)
    a = F.when(own["n"] > 1, mean_dist(own) * own["n"] / (own["n"] - 1))
    b = F.array_min(others)
    s = (F.when(F.size("cl") < 2, F.lit(None).cast("double"))
         .when(own["n"] <= 1, F.lit(0.0))
         .when(a < b, F.lit(1.0) - a / b)
         .when(a > b, b / a - F.lit(1.0))
         .otherwise(F.lit(0.0)))
    return scored.select(s.alias("_s")).agg(F.count(F.lit(1)).alias("n"),
                                             F.avg("_s").alias("silhouette"))


def linear_scores(models, features: str = "features", probability: bool = False) -> Column:
    """All linear models' scores of a row as one array column: features times
    coefficients plus intercept, through the logistic function if
    ``probability``.  So many candidates are scored in one pass of a scan."""
    def one(m):
        x = vector_to_array(F.col(features))
        z = dot(x, F.array(*[F.lit(float(c)) for c in m.coefficients.toArray()])) + F.lit(float(m.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) if probability else z
    return F.array(*[one(m) for m in models])


def many_regression_metrics(df: DataFrame, scores: str, n_models: int, label: str = "label") -> DataFrame:
    """H2 / G2 for many models in one scan: ``(model, n, r2, rmse, mse, mae)``
    from an array column of predictions, one aggregate for all of them.  As in
    :func:`regression_metrics`, complete pairs count."""
    y, aggs = F.col(label).cast("double"), []
    for i in range(n_models):
        p = F.get(F.col(scores), F.lit(i)).cast("double")
        e = y - p
        aggs += [F.count(e).alias(f"n{i}"), F.sum(e * e).alias(f"sse{i}"), F.sum(F.abs(e)).alias(f"sae{i}"),
                 F.var_pop(F.when(p.isNotNull(), y)).alias(f"vy{i}")]
    row = df.agg(*aggs)
    out = [F.struct(F.lit(i).alias("model"), F.col(f"n{i}").alias("n"),
                    (F.lit(1.0) - F.try_divide(F.col(f"sse{i}"), F.col(f"n{i}") * F.col(f"vy{i}"))).alias("r2"),
                    F.sqrt(F.try_divide(F.col(f"sse{i}"), F.col(f"n{i}"))).alias("rmse"),
                    F.try_divide(F.col(f"sse{i}"), F.col(f"n{i}")).alias("mse"),
                    F.try_divide(F.col(f"sae{i}"), F.col(f"n{i}")).alias("mae")) for i in range(n_models)]
    return row.select(F.inline(F.array(*out)))


def many_auc(df: DataFrame, scores: str, label: str = "label", bins: int = 10_000) -> DataFrame:
    """H5 / G2 for many models in one scan: ``(model, n, auc, bound)`` from an
    array column of scores from 0 to 1 and a label (1 is positive, anything
    else not; rows without a label or score are left out).

    Each model's scores are counted in ``bins`` equal cells by class, combined
    map-side, and the area under the ROC curve follows from the merged
    histogram with pairs of one cell counted half.  Only those pairs can be
    ordered otherwise, so the exact area (ties half) is within ``bound``, half
    their share of all pairs.  NULL if a class is missing."""
    rows = df.select(F.col(label).cast("double").alias("y"), F.posexplode(F.col(scores)).alias("model", "s")) \
        .filter("y is not null and s is not null and not isnan(s)")
    cell = F.least(F.floor(F.col("s") * bins), F.lit(bins - 1).cast("long"))
    counts = rows.groupBy("model", cell.alias("cell")).agg(
        F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") != 1).alias("q"))
    below = Window.partitionBy("model").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)   # bins rows a model
    p, q = F.col("p").cast("double"), F.col("q").cast("double")
    sums = counts.withColumn("under", F.coalesce(F.sum(q).over(below), F.lit(0.0))).groupBy("model").agg(
        F.sum(p + q).cast("long").alias("n"), (F.sum(p) * F.sum(q)).alias("pairs"),
        F.sum(p * (F.col("under") + q / 2)).alias("won"), (F.sum(p * q) / 2).alias("tied"))
    return sums.select("model", "n", F.try_divide("won", "pairs").alias("auc"), F.try_divide("tied", "pairs").alias("bound"))
