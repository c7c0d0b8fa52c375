"""Quality classifier: Naive Bayes support vectors (operator 6).

Features are indicators of n-grams: of words (one and two, lower-cased), and
of token shapes (one to three), where a shape tells the cases, digits and
other signs of a token, its length, and whether it repeats the token before.
A shape n-gram has an indicator for each share of the text it reaches (any,
1/64, 1/16, 1/4).  Each indicator is scaled by its class log-count ratio, and
a linear hinge-loss model is fitted to the scaled indicators by dual
coordinate descent, class by class weighted alike.  The margin becomes a score
through a logistic curve fitted to the sample's margins.

Learnt from at most ``max_rows`` labelled rows.  Null and tokenless texts have
no features: they are scored by the intercept.  Without both labels in the
sample every score is the share of label 1 (0.5 if none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear
from .common import Powers, blank_table, mix, ship, slices, stored, word_table, words

BITS = 18
MAX_ROWS = 20_000
THRESHOLD = 0.3
#: Bits kept of a token's shape, and the shares that have an indicator.
SHAPE_BITS, SHARES = 8, (0.0, 1 / 64, 1 / 16, 1 / 4)
_KEY = np.uint64(0x9E3779B97F4A7C15)


def _classes() -> np.ndarray:
    """Byte classes: 1 lower-case or beyond ASCII, 2 upper-case, 4 digit, 8
    sentence signs, 16 other signs."""
    t = np.full(256, 16, np.uint8)
    t[0x61:0x7B] = t[0x80:] = 1
    t[0x41:0x5B] = 2
    t[0x30:0x3A] = 4
    t[[ord(c) for c in ".,;:?'\"-()"]] = 8
    return t


def shapes(data, h, doc, starts, ends, classes) -> np.ndarray:
    """Shape of each blank-separated token, as a number below 2**SHAPE_BITS."""
    if not len(h):
        return np.zeros(0, np.int64)
    seen = np.bitwise_or.reduceat(classes[data], starts).astype(np.int64)   # blanks are class 16 ...
    signs = np.r_[0, np.cumsum(classes[data] == 16)]
    other = signs[ends] - signs[starts]                                     # ... so count within the token
    size = ends - starts
    again = np.r_[False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])]
    return (seen & 15) | (np.minimum(other, 3) << 4) | (again.astype(np.int64) << 6) | ((size > 20).astype(np.int64) << 7)


def hashed(data, off, tables, powers):
    """(text, feature) of every indicator that is on; may hold repeats."""
    plain, blank, classes = tables
    shift = np.uint64(64 - BITS)
    h, doc, _, _ = words(data, off, plain, powers)
    pair = doc[1:] == doc[:-1] if len(doc) > 1 else np.zeros(0, bool)
    docs = [doc, doc[1:][pair]]
    feats = [(mix(h + np.uint64(1)) >> shift), mix(h[:-1][pair] * _KEY + h[1:][pair]) >> shift if len(pair) else h[:0]]
    h, doc, starts, ends = words(data, off, blank, powers)
    shape = shapes(data, h, doc, starts, ends, classes)
    tokens = np.maximum(np.bincount(doc, minlength=len(off) - 1), 1)
    code = np.zeros(len(shape), np.int64)
    for n in (1, 2, 3):
        m = len(shape) - n + 1
        if m <= 0:
            break
        code = code[:m] << SHAPE_BITS | shape[n - 1:]
        ok = doc[:m] == doc[n - 1:]
        keys, counts = np.unique(doc[:m][ok].astype(np.int64) << (SHAPE_BITS * 3 + 2) | code[ok] | n << SHAPE_BITS * 3,
                                 return_counts=True)
        at = keys >> (SHAPE_BITS * 3 + 2)
        for level, share in enumerate(SHARES):
            on = counts >= share * tokens[at]
            gram = (keys[on] & ((1 << SHAPE_BITS * 3 + 2) - 1)).astype(np.uint64)
            docs.append(at[on])
            feats.append(mix(gram * _KEY + np.uint64(level + 2)) >> shift)
    return np.concatenate(docs).astype(np.int64), np.concatenate(feats).astype(np.int64)


def _tables():
    return word_table(), blank_table(), _classes()


def log_count_ratios(sample: DataFrame) -> np.ndarray:
    """Per feature, the log of its (smoothed) share among the indicators of
    class 1 over that of class 0.  Counts are summed by Spark."""
    def run(batches):
        tables, powers, total = _tables(), Powers(), np.zeros((2, 1 << BITS), np.int64)
        for whole in batches:
            for batch, data, off in slices(whole, "text"):
                label = np.array(batch.column(0).to_pylist(), np.int64)
                idx, starts, _ = linear.unique_per_text(*hashed(data, off, tables, powers), len(off) - 1, BITS)
                np.add.at(total, (label[np.repeat(np.arange(len(label)), np.diff(starts))], idx), 1)
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])],
                                         names=["i", "n0", "n1"])

    n = np.ones((2, 1 << BITS))
    for r in sample.select("label", "text").mapInArrow(run, "i long, n0 long, n1 long") \
            .groupBy("i").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect():
        n[0, r.i] += r.n0
        n[1, r.i] += r.n1
    return np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())


class Model:
    """Scaled weights (ratio times weight), intercept and score curve."""

    def __init__(self, weights: np.ndarray, intercept: float, slope: float, offset: float):
        self.weights, self.intercept, self.slope, self.offset = weights, intercept, slope, offset

    def margins(self, data, off, tables, powers):
        doc, idx = hashed(data, off, tables, powers)
        keys = np.unique(doc << BITS | idx)
        doc, idx = keys >> BITS, keys & ((1 << BITS) - 1)
        size = np.sqrt(np.maximum(np.bincount(doc, minlength=len(off) - 1), 1))
        return np.bincount(doc, self.weights[idx], len(off) - 1) / size + self.intercept


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", max_rows: int = MAX_ROWS,
        c: float = 1.0, epochs: int = 12) -> Model:
    """Fit on labelled rows for whose id ``learn`` holds."""
    sample, shards = linear.labelled_sample(docs, labels, label, learn, max_rows)
    sample = stored(sample.withColumn("label", (F.col("label") > 0).cast("int")), "quality-sample")
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        p = n.get(1, 0.5) / max(1, sum(n.values())) if n else 0.5
        p = min(max(p, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(p / (1 - p))))
    ratio = log_count_ratios(sample)
    shipped = sample.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))

    def features():
        tables, powers = _tables(), Powers()

        def extract(data, off):
            idx, starts, _ = linear.unique_per_text(*hashed(data, off, tables, powers), len(off) - 1, BITS)
            size = np.sqrt(np.maximum(np.diff(starts), 1))
            return idx, shipped.value[idx] / np.repeat(size, np.diff(starts)), starts

        return extract

    weight = {k: c * (n[0] + n[1]) / (2 * v) for k, v in n.items()}

    def one(x, y):
        return {"w": linear.dual_hinge(x, y, 1 << BITS, weight[1], weight[0], epochs)}

    w = linear.dense(linear.fit_shards(sample, shards, features, one).get("w", {}), (1 << BITS) + 1)
    model = Model(w[:-1] * ratio, float(w[-1]), 1.0, 0.0)
    margins = score(sample, model, ["label"], raw=True).select("label", "score")
    # Logistic curve over the margins, classes weighted alike: Newton steps on
    # sums that Spark computes (the margins are of the bounded sample).
    m = np.array([(r.score, r.label) for r in margins.collect()])
    cost = np.where(m[:, 1] > 0, 0.5 / n[1], 0.5 / n[0])
    a, b = 1.0, 0.0
    for _ in range(50):
        p = linear.sigmoid(a * m[:, 0] + b)
        g, q = cost * (p - m[:, 1]), cost * p * (1 - p)
        grad = np.array([(g * m[:, 0]).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(q * m[:, 0] ** 2).sum() + 1e-3, (q * m[:, 0]).sum()], [(q * m[:, 0]).sum(), q.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if abs(step).max() < 1e-6:
            break
    return Model(model.weights, model.intercept, a, b)


def score(docs: DataFrame, model: Model, keep: list[str], threshold: float = THRESHOLD, raw: bool = False) -> DataFrame:
    """``score`` and ``predicted`` (1 from ``threshold`` on) of every text;
    ``raw`` gives the margin as the score."""
    shipped = ship(docs.sparkSession, model)

    def scorer():
        model, tables, powers = shipped(), _tables(), Powers()

        def run(_, data, off):
            m = model.margins(data, off, tables, powers)
            p = m if raw else linear.sigmoid(model.slope * m + model.offset)
            return pa.array(p), pa.array((p >= threshold).astype(np.int32))

        return run

    return linear.score_texts(docs, scorer, "score double, predicted int", keep)
