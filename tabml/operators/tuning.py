"""Model search (G1-G5): parameter grid, train/validation search run with
candidate parallelism, and the leaderboard as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import (ParamGridBuilder, TrainValidationSplit,
                               TrainValidationSplitModel)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import hash_bucket
from . import grams
from .features import vector_size
from .split import BUCKETS

# The candidates of the default search.
DEFAULT_GRID = {"regParam": (0.01, 0.1, 0.5), "elasticNetParam": (0.0, 0.5, 1.0)}


def param_grid(estimator, values: Mapping[str, Sequence] = DEFAULT_GRID) -> list:
    """G1: Cartesian grid over named estimator params."""
    b = ParamGridBuilder()
    for name, vals in values.items():
        b = b.addGrid(estimator.getParam(name), list(vals))
    return b.build()


def evaluator(metric: str = "r2", label: str = "label", prediction: str = "prediction"):
    """The evaluator for a metric name: regression (r2, rmse, mse, mae),
    binary (areaUnderROC, areaUnderPR) or multiclass (accuracy, f1, ...)."""
    if metric in ("r2", "rmse", "mse", "mae", "var"):
        return RegressionEvaluator(metricName=metric, labelCol=label, predictionCol=prediction)
    if metric in ("areaUnderROC", "areaUnderPR"):
        return BinaryClassificationEvaluator(metricName=metric, labelCol=label)
    return MulticlassClassificationEvaluator(metricName=metric, labelCol=label,
                                             predictionCol=prediction)


def is_validation(key: str, train_ratio: float, seed: int):
    """Whether a row is in a search's validation part: by the hash of its key
    and the seed, so the part does not follow the partition layout."""
    return hash_bucket([key, F.lit(seed)]) >= round(train_ratio * BUCKETS)


class KeyedSearch(TrainValidationSplit):
    """A train/validation search whose parts come from a key column.  Ties go
    to the earlier candidate; the winner is refitted on all rows.

    Elastic nets are searched on sufficient statistics: two passes give the
    moments of both parts, from which every candidate's fit and validation
    metric follow (:mod:`tabml.operators.grams`).  Any other estimator, metric
    or grid, or more than ``grams.MAX_FEATURES`` features, is fitted candidate
    by candidate on the label, the features and the part, which are kept for
    the search (memory, spilling to disk), so that nothing upstream runs again."""

    key: str

    def _fit(self, dataset):
        est, maps = self.getEstimator(), self.getEstimatorParamMaps()
        held = is_validation(self.key, self.getTrainRatio(), self.getSeed()).alias("_held")
        columns = _read_columns(est)
        if columns is None:                        # a pipeline of its own: it reads raw columns
            data = dataset.withColumn("_held", held)
        else:
            data = dataset.select(*columns, held).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if _by_moments(est, maps, self.getEvaluator(), dataset):
                metrics = self._moments(data, est, maps)
            else:
                metrics = self._candidates(data, est, maps)
            best = metrics.index(max(metrics) if self.getEvaluator().isLargerBetter() else min(metrics))
            return self._copyValues(TrainValidationSplitModel(est.fit(data, maps[best]), metrics))
        finally:
            if columns is not None:
                data.unpersist()

    def _moments(self, data, est, maps) -> list[float]:
        parts = grams.moments(data, F.col("_held"), est.getFeaturesCol(), est.getLabelCol())
        if set(parts) != {"true", "false"}:
            raise ValueError("a search needs rows on both sides of its split")
        metrics = []
        for m in maps:
            one = est.copy(m)
            coef, intercept = grams.solve(parts["false"], one.getRegParam(), one.getElasticNetParam(), one.getStandardization())
            metrics.append(grams.evaluate(parts["true"], coef, intercept, self.getEvaluator().getMetricName()))
        return metrics

    def _candidates(self, data, est, maps) -> list[float]:
        ev, validation = self.getEvaluator(), data.filter("_held")
        candidates = est.fitMultiple(data.filter("not _held"), maps)

        def one(_):
            i, model = next(candidates)
            return i, ev.evaluate(model.transform(validation, maps[i]))

        metrics = [0.0] * len(maps)
        with ThreadPool(min(self.getParallelism(), len(maps))) as pool:
            run = inheritable_thread_target(data.sparkSession)(one)
            for i, value in pool.imap_unordered(run, range(len(maps))):
                metrics[i] = value
        return metrics


def _read_columns(est) -> list[str] | None:
    """The columns that a single estimator reads; None for a pipeline."""
    if not est.hasParam("featuresCol"):
        return None
    cols = [est.getOrDefault(p) for p in ("featuresCol", "labelCol", "weightCol") if est.hasParam(p) and est.isDefined(p)]
    return list(dict.fromkeys(c for c in cols if c))


def _by_moments(est, maps, ev, dataset) -> bool:
    """Whether moments decide the whole search."""
    return (isinstance(est, LinearRegression) and isinstance(ev, RegressionEvaluator)
            and ev.getMetricName() in ("r2", "mse", "rmse") and not ev.getThroughOrigin()
            and ev.getLabelCol() == est.getLabelCol() and ev.getPredictionCol() == est.getPredictionCol()
            and not (ev.isDefined("weightCol") and ev.getWeightCol())
            and {p.name for m in maps for p in m} <= {"regParam", "elasticNetParam", "standardization"}
            and est.getFitIntercept() and est.getLoss() == "squaredError" and est.getSolver() in ("auto", "normal")
            and not (est.isDefined("weightCol") and est.getWeightCol())
            and 0 < vector_size(dataset, est.getFeaturesCol()) <= grams.MAX_FEATURES)


def tune(estimator, grid: list, metric: str = "r2", train_ratio: float = 0.8,
         seed: int = 42, parallelism: int = 4, label: str = "label",
         key: str | None = None) -> TrainValidationSplit:
    """Split once, fit every candidate (``parallelism`` at a time, each
    fit itself distributed), keep the best validation metric and refit it on
    all rows given.  With ``key`` the split is by key hash, the same on any
    partition count; without, Spark's seeded ``rand``, which is not."""
    kind = KeyedSearch if key else TrainValidationSplit
    search = kind(estimator=estimator, estimatorParamMaps=grid,
                  evaluator=evaluator(metric, label=label), trainRatio=train_ratio, seed=seed,
                  parallelism=parallelism, collectSubModels=False)
    if key:
        search.key = key
    return search


def search_model(model) -> TrainValidationSplitModel:
    """The search stage of a fitted pipeline, found by type (not by
    position)."""
    if isinstance(model, TrainValidationSplitModel):
        return model
    if isinstance(model, PipelineModel):
        for st in reversed(model.stages):
            if isinstance(st, TrainValidationSplitModel):
                return st
    raise ValueError("no TrainValidationSplitModel in this model")


def best_model(model):
    """The winning fitted estimator (the last stage when the search was
    run around a whole pipeline)."""
    best = search_model(model).bestModel
    return best.stages[-1] if isinstance(best, PipelineModel) else best


def leaderboard(spark: SparkSession, model) -> DataFrame:
    """One row per candidate: its params, the validation metric, its
    rank (1 = best under the evaluator's direction) and ``is_best``."""
    tvs = search_model(model)
    maps = tvs.getEstimatorParamMaps()
    metrics = list(tvs.validationMetrics)
    larger = tvs.getEvaluator().isLargerBetter()
    names = sorted({p.name for m in maps for p in m})
    rows = []
    for i, (m, v) in enumerate(zip(maps, metrics)):
        vals = {p.name: float(x) if isinstance(x, (int, float)) else x for p, x in m.items()}
        rows.append(tuple([i] + [vals.get(n) for n in names] + [float(v)]))
    schema = ", ".join(["candidate int"] + [f"{n} double" for n in names] + ["metric double"])
    df = spark.createDataFrame(rows, schema)
    order = F.col("metric").desc() if larger else F.col("metric").asc()
    w = Window.orderBy(order, F.col("candidate"))  # one row per candidate
    return (df.withColumn("rank", F.row_number().over(w))
            .withColumn("is_best", F.col("rank") == 1))
