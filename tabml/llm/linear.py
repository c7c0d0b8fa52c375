"""Linear text models trained in shards: labelled samples of bounded size,
sparse hashed features, and weights averaged over the shards by Spark."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Labelled rows one shard fits on.
SHARD_ROWS = 10_000
#: Features of a chunk of texts: (feature index, value, start of each text).
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32(doc_id as text) modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")), F.lit(divisor))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int,
                    doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """About ``max_rows`` labelled documents at most (``key``, ``label``,
    ``text``), and the number of shards to fit them in.  They are chosen by hash among the labels for whose id ``learn`` holds.
    The chosen ids are broadcast: their number is what ``max_rows`` bounds.
    Null ids and labels are left out; of repeated rows of an id, the largest
    label and the smallest text count."""
    have = labels.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")) \
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).filter(learn)
    n = have.count()
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 0.97 * max_rows / max(n, 1)))
    ids = (have.filter(chance) if n > max_rows else have).groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")) \
        .select(F.col("doc_id").alias("key"), "label", "text"), max(1, min(n, max_rows) // SHARD_ROWS)


def fit_shards(sample: DataFrame, shards: int, features: Callable[[], Features],
               fit: Callable[[list, list], dict]) -> dict[str, dict[int, float]]:
    """Fit each shard of the sample (rows dealt by hash, in hash order; ranges
    of shard numbers, more of them than shards, put no two into one task) and
    average the shards' weights: {model: {feature: weight}}.  ``fit`` takes
    [(indices, values)] and labels, and returns {model: dense weights}.  What
    reaches the driver is bounded by the number of features."""
    rows = sample.withColumn("h", F.xxhash64("key")).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")) \
        .repartitionByRange(4 * shards, "shard").sortWithinPartitions("shard", "h", "text").select("shard", "label", "text")

    def run(batches):
        extract, held = features(), {}

        def done(shard):
            x, y = held.pop(shard)
            for name, w in fit(x, y).items():
                at = np.flatnonzero(w)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()),
                                                  pa.array(w[at], pa.float64())], names=["model", "i", "w"])

        for whole in batches:
            for batch, data, off in slices(whole, "text"):
                idx, val, start = extract(data, off)
                idx, val = idx.astype(np.int32), val.astype(np.float32)
                for r, (shard, label) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    if shard not in held:
                        for old in list(held):
                            yield from done(old)
                        held[shard] = [], []
                    held[shard][0].append((idx[start[r]:start[r + 1]], val[start[r]:start[r + 1]]))
                    held[shard][1].append(label)
        for old in list(held):
            yield from done(old)

    out: dict[str, dict[int, float]] = {}
    for r in rows.mapInArrow(run, "model string, i long, w double").groupBy("model", "i") \
            .agg((F.sum("w") / shards).alias("w")).collect():
        out.setdefault(r.model, {})[r.i] = r.w
    return out


def unique_per_text(doc: np.ndarray, index: np.ndarray, n_docs: int, bits: int):
    """Distinct feature indices of each text: (indices, starts, counts)."""
    keys, counts = np.unique(doc.astype(np.int64) << bits | index, return_counts=True)
    starts = np.searchsorted(keys >> bits, np.arange(n_docs + 1))
    return keys & ((1 << bits) - 1), starts, counts


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def ftrl(x: list, y: list, size: int, alpha: float, beta: float, l1: float, l2: float, epochs: int) -> np.ndarray:
    """FTRL-proximal logistic regression, one example at a time: a learning
    rate per coordinate from its summed squared gradients, and weights that are
    exactly 0 until the coordinate's ``z`` exceeds ``l1``.  The last weight is
    the intercept, which has no L1 term."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    bias = np.array([size])
    penalty = np.full(size + 1, l1)
    penalty[size] = 0.0

    def weight(i):
        zi = z[i]
        over = np.abs(zi) - penalty[i]
        return np.where(over > 0, -np.sign(zi) * over / ((beta + np.sqrt(n[i])) / alpha + l2), 0.0)

    for _ in range(epochs):
        for (idx, val), label in zip(x, y):
            i, v = np.append(idx, bias), np.append(val, 1.0)
            w = weight(i)
            g = (sigmoid((w * v).sum()) - label) * v
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / alpha * w
    return weight(np.arange(size + 1))


def dual_hinge(x: list, y: list, size: int, c_pos: float, c_neg: float, epochs: int, seed: int = 0) -> np.ndarray:
    """Linear support vector machine by dual coordinate descent on the hinge
    loss: one multiplier per example, clipped to [0, C] of its class.  Labels
    are 0/1; the last weight is the intercept."""
    w = np.zeros(size + 1)
    sign = np.where(np.asarray(y) > 0, 1.0, -1.0)
    cost = np.where(sign > 0, c_pos, c_neg)
    norm = np.array([(v * v).sum() + 1.0 for _, v in x])
    a = np.zeros(len(x))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for k in rng.permutation(len(x)):
            idx, v = x[k]
            s = sign[k]
            g = s * ((w[idx] * v).sum() + w[size]) - 1.0
            new = min(max(a[k] - g / norm[k], 0.0), cost[k])
            if new != a[k]:
                d = (new - a[k]) * s
                moved = max(moved, abs(d))
                a[k] = new
                w[idx] += d * v
                w[size] += d
        if moved < 1e-4:
            break
    return w


def dense(weights: dict[int, float], size: int) -> np.ndarray:
    out = np.zeros(size)
    for i, w in weights.items():
        out[i] = w
    return out


def score_texts(docs: DataFrame, scorer: Callable[[], Callable], columns: str, keep: list[str],
                text: str = "text") -> DataFrame:
    """Map ``scorer()(slice, bytes, offsets)``, which returns Arrow arrays of
    the new ``columns``, over the whole text of every row (null: empty)."""
    src = docs.select(*[F.col(f"`{c}`") for c in keep],
                      F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    names = [c.split()[0] for c in columns.split(", ")]
    if set(names) & set(keep):
        raise ValueError(f"columns {sorted(set(names) & set(keep))} exist already")

    def run(batches):
        score = scorer()
        for whole in batches:
            for batch, data, off in slices(whole, "__text"):
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *score(batch, data, off)], names=[*keep, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text"] + [columns])
    return src.mapInArrow(run, schema)
