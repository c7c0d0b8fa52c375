"""Models (F1-F8, F10) and model read-outs.

Estimators are Spark ML's distributed solvers: the normal-equation and
L-BFGS/OWL-QN fits are one tree-aggregate per iteration, trees are grown one
level per aggregate job, k-means is one aggregate per Lloyd step.  Fits read
only the columns they use, and Spark ML persists its own instance RDD for the
iterations; jobs that pass over one table several times pin it once with
:func:`pin` / :func:`prepared` (the reference re-read its CSV on every pass).
Every random step takes a seed.
"""

from __future__ import annotations

import contextlib

from pyspark import StorageLevel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .features import feature_names

#: Size, as shuffled, of the parts that :func:`pin` deals a table to.  Kept as
#: vectors, and weighted for a forest's trees, rows take several times as much.
PART = "16m"


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist ``df`` (by default in memory, spilling to disk) for the duration
    of an iterative fit, unless the caller already did."""
    mine = not df.is_cached
    if mine:
        df.persist(level)
    try:
        yield df
    finally:
        if mine:
            df.unpersist()


def pin(df: DataFrame, cols=None, partitions: int | None = None,
        level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Project, persist (by default in memory, spilling to disk) and materialise ``df``
    once; the caller unpersists it.  The scan's partitioning is kept unless
    the caller asks for at least ``partitions``, e.g. for a file of one row
    group that is read by one task; then every row is dealt round-robin before
    it is kept, into parts of about ``PART`` (Spark's rebalance), so no part
    grows with the table.  Only a table too small for ``partitions``
    such parts is dealt once more, into just so many."""
    data = df.select(*cols) if cols else df
    kept = _keep(data.hint("rebalance") if partitions else data, level)
    if partitions and kept.rdd.getNumPartitions() < partitions:
        few, kept = kept, _keep(kept.repartition(partitions), level)
        few.unpersist()
    return kept


def _keep(df: DataFrame, level: StorageLevel) -> DataFrame:
    """Persist and fill; a rebalanced table is kept in parts of ``PART``, which
    Spark by default does not let a kept table do."""
    conf = df.sparkSession.conf
    wanted = {"spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": PART}
    before = {name: conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            conf.set(name, value)
        data = df.persist(level)
        data.write.format("noop").mode("overwrite").save()      # fills the cache inside the JVM
    finally:
        for name, value in before.items():
            conf.set(name, value) if value is not None else conf.unset(name)
    return data


@contextlib.contextmanager
def prepared(df: DataFrame, cols=None, partitions: int | None = None,
             level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Pin a job's prepared input (see :func:`pin`) for its several passes
    (index fit, fits, evaluations) and release it when the job is done.
    Without this every pass re-runs the scan and the joins that produced
    the table."""
    data = pin(df, cols, partitions, level)
    try:
        yield data
    finally:
        data.unpersist()


def small(df: DataFrame) -> DataFrame:
    """Materialise a report table (metrics, class rates, confusion counts:
    its size follows from classes and metrics, not from rows) so it outlives
    the cached inputs it was computed from."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@contextlib.contextmanager
def fit_input(df: DataFrame, cols):
    """The input of a fit: only the columns the estimator reads.  Spark ML
    persists its own instance RDD for the iterations when the input is not
    cached, so no second copy is kept here; jobs that fit or evaluate several
    times on one table pin it once with :func:`prepared`."""
    yield df if df.is_cached else df.select(*cols)


def _cols(est) -> list[str]:
    cols = [est.getFeaturesCol()]
    if est.hasParam("labelCol"):
        cols.append(est.getLabelCol())
    if est.hasParam("weightCol") and est.isDefined("weightCol") and est.getWeightCol():
        cols.append(est.getWeightCol())
    return cols


def fit_linear(df: DataFrame, features: str = "features", label: str = "label",
               reg: float = 0.0, enet: float = 0.0, max_iter: int = 100,
               solver: str = "auto", tol: float = 1e-6, standardize: bool = True):
    """F1 (OLS: reg 0, normal equations) / F2-F3 (elastic net)."""
    est = LinearRegression(featuresCol=features, labelCol=label, regParam=reg,
                           elasticNetParam=enet, maxIter=max_iter, solver=solver,
                           tol=tol, standardization=standardize)
    with fit_input(df, _cols(est)) as d:
        return est.fit(d)


def fit_logistic(df: DataFrame, features: str = "features", label: str = "label",
                 reg: float = 0.0, enet: float = 0.0, max_iter: int = 100,
                 tol: float = 1e-6, family: str = "auto"):
    """elastic-net logistic regression."""
    est = LogisticRegression(featuresCol=features, labelCol=label, regParam=reg,
                             elasticNetParam=enet, maxIter=max_iter, tol=tol, family=family)
    with fit_input(df, _cols(est)) as d:
        return est.fit(d)


def check_bins(df: DataFrame, features: str, max_bins: int) -> None:
    """Trees need every categorical feature to have at most ``maxBins``
    values; say so before Spark fails deep inside the fit."""
    meta = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    for a in meta.get("nominal", []):
        n = len(a.get("vals", [])) or a.get("num_vals", 0)
        if n > max_bins:
            raise ValueError(f"feature {a.get('name')} has {n} categories > maxBins={max_bins}; "
                             "group the categories first")


def fit_tree(df: DataFrame, features: str = "features", label: str = "label",
             max_depth: int = 3, max_bins: int = 32, seed: int = 42):
    """decision tree classifier."""
    check_bins(df, features, max_bins)
    est = DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth,
                                 maxBins=max_bins, seed=seed)
    with fit_input(df, _cols(est)) as d:
        return est.fit(d)


def fit_forest(df: DataFrame, features: str = "features", label: str = "label",
               max_depth: int = 3, num_trees: int = 20, max_bins: int = 32, seed: int = 42):
    """random forest classifier (all trees of a level in one job)."""
    check_bins(df, features, max_bins)
    est = RandomForestClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth,
                                 numTrees=num_trees, maxBins=max_bins, seed=seed)
    with fit_input(df, _cols(est)) as d:
        return est.fit(d)


def fit_tree_regressor(df: DataFrame, features: str = "features", label: str = "label",
                       max_depth: int = 3, max_bins: int = 32, seed: int = 42):
    """decision tree regressor."""
    check_bins(df, features, max_bins)
    est = DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=max_depth,
                                maxBins=max_bins, seed=seed)
    with fit_input(df, _cols(est)) as d:
        return est.fit(d)


def fit_kmeans(df: DataFrame, k: int = 3, features: str = "features", seed: int = 1,
               max_iter: int = 20, init_mode: str = "k-means||", tol: float = 1e-4):
    """F8: k-means (k-means|| initialisation, distributed Lloyd steps until no
    centre moves by more than ``tol``)."""
    est = KMeans(k=k, featuresCol=features, seed=seed, maxIter=max_iter, initMode=init_mode, tol=tol)
    with fit_input(df, _cols(est)) as d:
        return est.fit(d)


def coefficients(model, df: DataFrame, features: str = "features") -> DataFrame:
    """``(feature, coefficient)`` rows plus an ``intercept`` row.  Names
    come from the assembled vector's attribute metadata."""
    names = feature_names(df, features)
    coefs = model.coefficients.toArray().tolist()
    if len(names) != len(coefs):
        names = [f"f{i}" for i in range(len(coefs))]
    rows = list(zip(names, [float(c) for c in coefs])) + [("intercept", float(model.intercept))]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def centers(model, spark) -> DataFrame:
    """H9: cluster centres in long form ``(cluster, dim, value)`` (k x dim
    values, bounded by the model)."""
    rows = [(i, d, float(v)) for i, c in enumerate(model.clusterCenters())
            for d, v in enumerate(c.tolist())]
    return spark.createDataFrame(rows, "cluster int, dim int, value double")


def tree_nodes(model, spark) -> DataFrame:
    """A tree (or every tree of a forest) as rows
    ``(tree, node, depth, feature, threshold, left_categories, left, right,
    prediction, impurity, gain, n)``.  A split on a number sends values up to
    ``threshold`` to the left, one on a category those of
    ``left_categories`` (category indices; the other of the two is NULL).

    The model is written with Spark ML's own writer below the shared
    checkpoint folder and its node table read back, so no text is parsed.
    A fitted tree already lives in driver memory and has at most
    2^(maxDepth+1) - 1 nodes, so depth is assigned by walking parent ->
    child links over that bounded table.
    """
    path = scratch_path(spark, "tree")
    model.write().overwrite().save(path)
    raw = spark.read.parquet(f"{path}/data")
    if "treeID" in raw.columns:
        nodes = raw.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        nodes = raw.select(F.lit(0).alias("tree"), "*")
    inner = F.col("leftChild") >= 0
    split = F.col("split")
    impurity = _impurity(model.getImpurity(), F.col("impurityStats"))
    flat = nodes.select(
        F.col("tree").cast("int").alias("tree"), F.col("id").alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & (split["numCategories"] < 0),
               split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & (split["numCategories"] >= 0),
               split["leftCategoriesOrThreshold"]).alias("left_categories"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        "prediction", impurity.alias("impurity"), F.when(inner, F.col("gain")).alias("gain"),
        F.col("rawCount").alias("n"))
    rows = flat.collect()                       # the model itself lives on the driver
    kids = {(r["tree"], r["node"]): (r["left"], r["right"]) for r in rows}
    depth, todo = {}, [(t, 0, 0) for t in {r["tree"] for r in rows}]
    while todo:
        t, nd, dp = todo.pop()
        depth[(t, nd)] = dp
        for c in kids.get((t, nd), (None, None)):
            if c is not None:
                todo.append((t, c, dp + 1))
    schema = ("tree int, node int, depth int, feature int, threshold double, "
              "left_categories array<double>, left int, "
              "right int, prediction double, impurity double, gain double, n long")
    out = [(r["tree"], r["node"], depth.get((r["tree"], r["node"])), r["feature"],
            r["threshold"], r["left_categories"], r["left"], r["right"], r["prediction"], r["impurity"],
            r["gain"], r["n"]) for r in rows]
    return spark.createDataFrame(out, schema)


def _impurity(kind: str, stats):
    """Node impurity from its stored statistics (class counts, or count /
    sum / sum of squares for regression).  Spark stores -1 as the impurity of
    a node it found no valid split for; the statistics are always there."""
    zero = F.lit(0.0).cast("double")
    if kind == "variance":
        n, sm, sq = stats[0], stats[1], stats[2]
        return F.when(n > 0, sq / n - (sm / n) * (sm / n))
    total = F.aggregate(stats, zero, lambda a, c: a + c)
    if kind == "gini":
        return F.when(total > 0, F.lit(1.0) - F.aggregate(
            stats, zero, lambda a, c: a + (c / total) * (c / total)))
    if kind == "entropy":
        return F.when(total > 0, -F.aggregate(
            stats, zero, lambda a, c: a + F.when(c > 0, (c / total) * F.log2(c / total))
            .otherwise(zero)))
    raise ValueError(f"unknown impurity {kind!r}")


def debug_string(model) -> str:
    """Spark's readable rendering of a tree or forest."""
    return model.toDebugString


def training_summary(model, spark) -> DataFrame:
    """H1: the fit's own training summary ``(metric, value)`` (R^2, RMSE,
    MAE, MSE for a linear model; accuracy and rates for a logistic one)."""
    sm = model.summary
    names = ("r2", "rootMeanSquaredError", "meanAbsoluteError", "meanSquaredError",
             "accuracy", "weightedTruePositiveRate", "weightedFalsePositiveRate",
             "weightedPrecision", "weightedRecall")
    rows = []
    for n in names:
        if hasattr(type(sm), n):
            rows.append((n, float(getattr(sm, n))))
    return spark.createDataFrame(rows, "metric string, value double")
