"""Elastic-net searches from sufficient statistics.

A linear fit needs of its rows only their number, the means, and the matrix of
second moments of features and label; so does R^2 of any linear model on other
rows.  One pass over the assembled table gives both for every part of a split;
all candidates of a search are then solved and evaluated on d x d numbers.

The solver minimises what Spark ML's normal-equation solver minimises:
features and label scaled by their population standard deviations, ``regParam``
divided by the label's, and the penalty ``alpha |b|_1 + (1 - alpha) / 2 |b|^2``
on the scaled coefficients; an intercept is never penalised.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Features up to which moments are gathered (a matrix of 512 is 2 MB).
MAX_FEATURES = 512
#: Rows turned into a dense matrix at once inside a task.
ROWS_AT_ONCE = 4096
#: Partial sums that reach the driver for each part.
PARTIALS = 8


@dataclass
class Moments:
    """Sums over rows of z = (features, label), taken after subtracting ``shift``."""

    n: float
    shift: np.ndarray
    first: np.ndarray       # sum of z
    second: np.ndarray      # sum of z z'

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.shift, self.first + other.first, self.second + other.second)

    def centred(self) -> tuple[np.ndarray, np.ndarray]:
        """(means, population covariance) of features and label."""
        m = self.first / self.n
        return self.shift + m, self.second / self.n - np.outer(m, m)


def moments(df: DataFrame, part: Column, features: str = "features", label: str = "label") -> dict:
    """:class:`Moments` of the rows of each value of ``part`` (a few values,
    such as train / validation).  The first pass takes the means, so that the
    sums of the second lose no digits; each task then adds up its rows' outer
    products, and two rounds of partial sums leave ``PARTIALS`` matrices a part
    for the driver, whatever the number of tasks.  An empty table gives {};
    a row without a label is refused, as Spark's fits do."""
    x = df.select(part.cast("string").alias("part"), F.col(features).alias("v"), F.col(label).cast("double").alias("y"))
    if x.isEmpty():
        return {}
    means = x.agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("v"), F.avg("y").alias("y"),
                  F.count_if(F.col("y").isNull() | F.isnan("y")).alias("bad")).first()
    if means.bad:
        raise ValueError(f"{means.bad} rows have no label")
    shift = np.array([*means.v, means.y])
    d = len(shift)

    def gram(batches):
        sums: dict = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(lo, ROWS_AT_ONCE)
                z = np.empty((some.num_rows, d))
                z[:, :-1] = some.column(1).flatten().to_numpy().reshape(some.num_rows, d - 1)
                z[:, -1] = some.column(2).to_numpy(zero_copy_only=False)
                z -= shift
                names = np.array(some.column(0).to_pylist(), object)
                for name in set(names.tolist()):
                    mine = z[names == name]
                    s = sums.setdefault(name, [0.0, np.zeros(d), np.zeros((d, d))])
                    s[0] += len(mine)
                    s[1] += mine.sum(axis=0)
                    s[2] += mine.T @ mine
        yield from rows_of(sums)

    def add_up(batches):
        sums: dict = {}
        for batch in batches:
            for name, n, first, second in zip(*[c.to_pylist() for c in batch.columns]):
                s = sums.setdefault(name, [0.0, np.zeros(d), np.zeros((d, d))])
                s[0] += n
                s[1] += np.frombuffer(first)
                s[2] += np.frombuffer(second).reshape(d, d)
        yield from rows_of(sums)

    def rows_of(sums):
        for name, (n, first, second) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.array([n]), pa.array([first.tobytes()]), pa.array([second.tobytes()])],
                names=["part", "n", "first", "second"])

    schema = "part string, n double, first binary, second binary"
    slots = df.sparkSession.sparkContext.defaultParallelism
    sums = x.select("part", vector_to_array("v").alias("v"), "y").mapInArrow(gram, schema)
    for partials in (slots, PARTIALS) if slots > PARTIALS else (PARTIALS,):
        sums = sums.repartition(partials).mapInArrow(add_up, schema)
    out: dict = {}
    for r in sums.collect():
        m = Moments(r.n, shift, np.frombuffer(r.first), np.frombuffer(r.second).reshape(d, d))
        out[r.part] = out[r.part] + m if r.part in out else m
    return out


def solve(m: Moments, reg: float, alpha: float, standardize: bool = True, tol: float = 1e-10,
          max_iter: int = 100_000) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of the elastic net with these moments, by
    coordinate descent with soft thresholds.  Constant features get 0; a
    constant label is its mean."""
    mean, cov = m.centred()
    d = len(mean) - 1
    var = np.maximum(np.diag(cov), 0.0)
    scale = np.sqrt(np.where(var > 1e-18 * np.maximum(mean * mean, 1.0), var, 0.0))
    sy = scale[-1]
    if sy == 0:
        return np.zeros(d), float(mean[-1])
    live = np.flatnonzero(scale[:-1] > 0)
    s = scale[live]
    a = cov[np.ix_(live, live)] / np.outer(s, s)
    b = cov[live, -1] / (s * sy)
    one = np.ones(len(live)) if standardize else 1.0 / s          # penalty on the unscaled coefficient
    l1, l2 = reg / sy * alpha * one, reg / sy * (1 - alpha) * one * one
    if alpha == 0 or reg == 0:
        beta = np.linalg.lstsq(a + np.diag(l2), b, rcond=None)[0]
    else:
        beta, slope = np.zeros(len(live)), -b                     # slope: a @ beta - b
        for _ in range(max_iter):
            moved = 0.0
            for j in range(len(live)):
                raw = a[j, j] * beta[j] - slope[j]
                new = math.copysign(max(abs(raw) - l1[j], 0.0), raw) / (a[j, j] + l2[j])
                step = new - beta[j]
                if step:
                    slope += step * a[:, j]
                    beta[j] = new
                    moved = max(moved, abs(step))
            if moved < tol:
                break
    coef = np.zeros(d)
    coef[live] = beta * sy / s
    return coef, float(mean[-1] - coef @ mean[:-1])


def evaluate(m: Moments, coef: np.ndarray, intercept: float, metric: str = "r2") -> float:
    """``r2``, ``mse`` or ``rmse`` of a linear model on rows with these moments."""
    w = np.r_[-coef, 1.0]
    off = float(w @ m.shift) - intercept                          # residual = w . z + off
    sse = float(w @ m.second @ w + 2 * off * (w @ m.first) + m.n * off * off)
    if metric == "r2":
        total = float(m.second[-1, -1] - m.first[-1] ** 2 / m.n)
        return 1 - sse / total if total > 0 else float("nan")
    return sse / m.n if metric == "mse" else math.sqrt(max(sse, 0.0) / m.n)
