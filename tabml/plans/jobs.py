"""The seven analytic jobs, each composed from the operators and returning
its result table (A3: no console printing; the caller writes the table).

Inputs are DataFrames, so the jobs run on any table with the named columns;
``plans.catalog`` binds them to the driver's test tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (features as fe, metrics as me, models as mo, prep,
                         recommend as rc, split as sp, stats as st, tuning as tu)
from ..session import ensure_checkpoint_dir


def screen_fields(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Field screening: all-pairs correlation of the numeric fields left
    after dropping ``drop`` (one aggregate, not one job per pair)."""
    t = prep.drop_columns(df, *drop)
    return st.corr_matrix(t, prep.numeric_columns(t))


def in_sample_regression(df: DataFrame, label: str, numeric: Sequence[str],
                         categorical: Sequence[str], partitions: int | None = None) -> DataFrame:
    """OLS with one-hot categories, scored on its own training rows:
    ``(kind, name, value)`` = coefficients, intercept, R^2, RMSE."""
    t = prep.rename(df, {label: "label"}) if label != "label" else df
    stages = fe.feature_stages(categorical, numeric, handle_invalid="error")
    with mo.prepared(t, ["label", *numeric, *categorical], partitions) as base:
        data = Pipeline(stages=stages).fit(base).transform(base).select("label", "features")
        model = mo.fit_linear(data, solver="normal")
        coefs = mo.coefficients(model, data).select(
            F.lit("coefficient").alias("kind"), F.col("feature").alias("name"),
            F.col("coefficient").alias("value"))
        fit = mo.small(me.metrics_long(me.regression_metrics(model.transform(data)), "train")
                       .select(F.lit("metric").alias("kind"), F.col("metric").alias("name"),
                               "value"))
    return coefs.unionByName(fit)


def _search_stages(est, grid, metric, train_ratio, seed, parallelism, categorical, numeric,
                   whole_pipeline: bool, key: str) -> list:
    """Stages of a tuned model.  By default (as in the reference) the
    indexers and encoder are fitted once on all training rows and the search
    runs on the assembled features, so category frequencies of validation
    rows inform the encoding.  ``whole_pipeline`` runs the search around the
    whole pipeline instead: every candidate refits the feature stages on its
    own training split, with no such leakage (and one feature fit per
    candidate)."""
    feats = fe.feature_stages(categorical, numeric, handle_invalid="keep")
    if whole_pipeline:
        return [tu.tune(Pipeline(stages=feats + [est]), grid, metric, train_ratio, seed,
                        parallelism, key=key)]
    return feats + [tu.tune(est, grid, metric, train_ratio, seed, parallelism, key=key)]


def tuned_regression(df: DataFrame, label: str, numeric: Sequence[str],
                     categorical: Sequence[str], key: str, holdout: float = 0.2,
                     train_ratio: float = 0.8, seed: int = 42, parallelism: int = 4,
                     grid: Mapping[str, Sequence] = tu.DEFAULT_GRID, report: bool = True,
                     whole_pipeline: bool = False, partitions: int | None = None):
    """Elastic-net linear regression tuned on a 3 x 3 grid with a
    train/validation search (parts by key hash), checked on a key-hash holdout.  Returns
    ``(metrics, leaderboard)``; metrics are ``(dataset, metric, value)``:
    train and holdout R^2 / RMSE / MAE, the winning lambda and alpha, and the
    winner's coefficients and intercept by feature name.  ``report=False``
    skips the metrics and returns ``(None, leaderboard)``."""
    t = prep.rename(df, {label: "label"}) if label != "label" else df
    lr = LinearRegression()           # Spark defaults, as in the reference search
    stages = _search_stages(lr, tu.param_grid(lr, grid), "r2", train_ratio, seed, parallelism,
                            categorical, numeric, whole_pipeline, key)
    spark = df.sparkSession
    data = sp.with_split(t, key, [1 - holdout, holdout])
    with mo.prepared(data, list(dict.fromkeys(["part", "label", key, *numeric, *categorical])), partitions) as base:
        train = base.filter(F.col("part") == "train")
        hold = base.filter(F.col("part") == "test")
        pm = Pipeline(stages=stages).fit(train)
        if not report:                            # the leaderboard alone
            return None, tu.leaderboard(spark, pm)
        best = tu.best_model(pm)
        scored_train = pm.transform(train)
        coefs = mo.coefficients(best, scored_train).select(
            F.lit("coefficient").alias("dataset"), F.col("feature").alias("metric"),
            F.col("coefficient").alias("value"))
        metrics = mo.small(
            me.metrics_long(me.regression_metrics(scored_train), "train")
            .unionByName(me.metrics_long(me.regression_metrics(pm.transform(hold)), "holdout"))
            .unionByName(spark.createDataFrame(
                [("best", "regParam", float(best.getRegParam())),
                 ("best", "elasticNetParam", float(best.getElasticNetParam()))],
                "dataset string, metric string, value double")))
    return metrics.unionByName(coefs), tu.leaderboard(spark, pm)      # rows of the model's own state


def tuned_classifier(df: DataFrame, label: str, numeric: Sequence[str],
                     categorical: Sequence[str], key: str, holdout: float = 0.1,
                     train_ratio: float = 0.9, seed: int = 42, parallelism: int = 4,
                     metric: str = "areaUnderROC",
                     grid: Mapping[str, Sequence] = tu.DEFAULT_GRID,
                     whole_pipeline: bool = False, partitions: int | None = None):
    """Binary logistic regression tuned on the grid (by area under ROC, not
    the reference's regression R^2), checked on a key-hash holdout.
    Returns ``(metrics, class_rates, confusion)``."""
    t = prep.rename(df, {label: "label"}) if label != "label" else df
    lr = LogisticRegression()         # Spark defaults, as in the reference search
    stages = _search_stages(lr, tu.param_grid(lr, grid), metric, train_ratio, seed, parallelism,
                            categorical, numeric, whole_pipeline, key)
    data = sp.with_split(t, key, [1 - holdout, holdout])
    with mo.prepared(data, list(dict.fromkeys(["part", "label", key, *numeric, *categorical])), partitions) as base:
        train = base.filter(F.col("part") == "train")
        hold = base.filter(F.col("part") == "test")
        pm = Pipeline(stages=stages).fit(train)
        scored_hold = pm.transform(hold)
        acc = mo.small(me.metrics_long(me.accuracy(pm.transform(train)), "train")
                       .unionByName(me.metrics_long(me.accuracy(scored_hold), "holdout")))
        rates = mo.small(me.class_rates(scored_hold))
        cm = mo.small(me.confusion(scored_hold))
    return acc, rates, cm


def compare_trees(df: DataFrame, label: str, numeric: Sequence[str], category: str,
                  key: str, holdout: float = 0.2, seed: int = 42, max_depth: int = 3,
                  num_trees: int = 20, partitions: int | None = None):
    """Decision tree vs random forest on the same key-hash split.  Returns
    ``(accuracy (model, n, accuracy), fitted tree)``; the tree's rules as
    rows come from :func:`tabml.operators.models.tree_nodes`.

    The input is scanned once and pinned; the category index is fitted on
    it, the assembled ``(label, features, part)`` table is pinned in its
    place, and both fits and both evaluations read that."""
    t = prep.rename(df, {label: "label"}) if label != "label" else df
    raw = mo.pin(t, [key, "label", category, *numeric], partitions)     # the input is scanned once
    try:
        idx = fe.indexer([category], [f"{category}_idx"], handle_invalid="keep").fit(raw)
        asm = VectorAssembler(inputCols=[f"{category}_idx"] + list(numeric), outputCol="features")
        data = sp.with_split(asm.transform(idx.transform(raw)), key, [1 - holdout, holdout])
        assembled = mo.pin(data, ["label", "features", "part"])
    finally:
        raw.unpersist()
    try:
        train = assembled.filter(F.col("part") == "train")
        hold = assembled.filter(F.col("part") == "test")
        tree = mo.fit_tree(train, max_depth=max_depth, seed=seed)
        forest = mo.fit_forest(train, max_depth=max_depth, num_trees=num_trees, seed=seed)
        acc = mo.small(
            me.accuracy(tree.transform(hold)).withColumn("model", F.lit("tree"))
            .unionByName(me.accuracy(forest.transform(hold)).withColumn("model", F.lit("forest")))
            .select("model", "n", "accuracy"))
    finally:
        assembled.unpersist()
    return acc, tree


def segment(df: DataFrame, features: str, k: int = 3, seed: int = 1, partitions: int | None = None):
    """k-means segmentation: ``(sizes (cluster, n), quality (metric,
    value) = SSE and silhouette, centres (cluster, dim, value))``.  The
    input is pinned for the fit and the three scoring passes."""
    with mo.prepared(df, [features], partitions) as data:
        model = mo.fit_kmeans(data, k=k, features=features, seed=seed)
        scored = model.transform(data).withColumnRenamed("prediction", "cluster")
        sizes = mo.small(st.count_by(scored, "cluster"))
        cent = mo.centers(model, df.sparkSession)
        sil = me.silhouette(scored, features, "cluster")
        quality = mo.small(
            sil.select(F.lit("silhouette").alias("metric"), F.col("silhouette").alias("value"))) \
            .unionByName(df.sparkSession.createDataFrame(     # the fit's own sum
                [("sse", float(model.summary.trainingCost))], "metric string, value double"))
    return sizes, quality, cent


def segment_columns(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), k: int = 3,
                    seed: int = 1, partitions: int | None = None):
    """:func:`segment` from raw columns: categories are indexed and one-hot
    encoded (no slot dropped, so no category is nearer to the others), numbers
    taken as they are.  Centres carry the slots' ``name``.  Rows with a
    missing number fail the job, as the assembler does."""
    stages = fe.feature_stages(categorical, numeric, handle_invalid="error", drop_last=False)
    data = Pipeline(stages=stages).fit(df).transform(df)
    names = df.sparkSession.createDataFrame(list(enumerate(fe.feature_names(data))), "dim int, name string")
    sizes, quality, cent = segment(data, "features", k, seed, partitions)
    return sizes, quality, cent.join(names, "dim").select("cluster", "dim", "name", "value")


def recommend_courses(ratings: DataFrame, user: str, item: str, rating: str,
                      k: int = 5, scale: float = 100.0, seed: int = 42) -> DataFrame:
    """Recommender: scale the rating, fit ALS (10 iterations, lambda 0.1,
    cold start 'drop'), top k per user beside each user's history."""
    # the ratings (a join and an aggregate upstream) are read by the id check,
    # the fit and the history rows of the lazily returned result: write them
    # once to the shared checkpoint folder and cut the lineage there
    ensure_checkpoint_dir(ratings.sparkSession)
    r = prep.scale(ratings.select(user, item, rating), rating, scale).checkpoint(eager=True)
    if rc.fits_int(r, user, item):
        recs = rc.top_k(rc.fit_als(r, user, item, rating, seed=seed), k)
    else:                                         # wide ids: fit on dense ones, map back
        users, items = rc.id_map(r, user, "_u"), rc.id_map(r, item, "_i")
        dense = r.join(users, user).join(items, item).select("_u", "_i", rating)
        top = rc.top_k(rc.fit_als(dense, "_u", "_i", rating, seed=seed), k)
        recs = (top.join(users, top["user"] == users["_u"]).join(items, top["item"] == items["_i"])
                .select(F.col(user).alias("_user"), "rank", F.col(item).alias("_item"), "score")
                .toDF("user", "rank", "item", "score"))
    return rc.with_history(recs, r, user, item, rating)
