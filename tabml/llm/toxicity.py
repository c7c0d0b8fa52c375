"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams (operator 5).

Features are the presence of words, of pairs of neighbours and of pairs one
word apart (lower-cased words, hashed to 2**BITS).  L1 sparsity leaves few
weights, which are broadcast (at most 2**BITS of them) to score every text.

Learnt from at most ``max_rows`` labelled rows, in shards whose weights are
averaged.  Null and wordless texts are scored by the intercept alone; without
any labelled row every score is 0.5.  Repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from . import linear
from .common import Powers, mix, word_table, words

BITS = 20
MAX_ROWS = 40_000
THRESHOLD = 0.7
_NEXT, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(64 - BITS)


def hashed(data: np.ndarray, off: np.ndarray, table: np.ndarray, powers: Powers):
    """(text, feature) of every word, pair and skip-pair occurrence."""
    h, doc, _, _ = words(data, off, table, powers)
    parts, docs = [h], [doc]
    for gap, key in ((1, _NEXT), (2, _SKIP)):
        ok = doc[gap:] == doc[:-gap] if len(doc) > gap else np.zeros(0, bool)
        parts.append(mix(h[:-gap][ok] * key + h[gap:][ok]) if len(ok) else h[:0])
        docs.append(doc[gap:][ok] if len(ok) else doc[:0])
    return np.concatenate(docs), (np.concatenate(parts) >> _SHIFT).astype(np.int64)


def features():
    table, powers = word_table(), Powers()

    def extract(data, off):
        idx, starts, _ = linear.unique_per_text(*hashed(data, off, table, powers), len(off) - 1, BITS)
        return idx, np.ones(len(idx)), starts

    return extract


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", max_rows: int = MAX_ROWS,
        alpha: float = 3.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.0, epochs: int = 3) -> dict[int, float]:
    """Weights {feature: weight} (feature 2**BITS is the intercept)."""
    sample, shards = linear.labelled_sample(docs, labels, label, learn, max_rows)

    def one(x, y):
        return {"toxic": linear.ftrl(x, y, 1 << BITS, alpha, beta, l1, l2, epochs)}

    return linear.fit_shards(sample, shards, features, one).get("toxic", {})


def score(docs: DataFrame, weights: dict[int, float], keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``score`` and ``predicted`` (1 from ``threshold`` on) of every text."""
    small = docs.sparkSession.sparkContext.broadcast(weights)

    def scorer():
        w = linear.dense(small.value, (1 << BITS) + 1)
        table, powers = word_table(), Powers()

        def run(_, data, off):
            doc, idx = hashed(data, off, table, powers)
            some = w[idx] != 0
            keys = np.unique(doc[some].astype(np.int64) << BITS | idx[some])
            total = np.bincount(keys >> BITS, w[keys & ((1 << BITS) - 1)], len(off) - 1) + w[1 << BITS]
            p = linear.sigmoid(total)
            return pa.array(p), pa.array((p >= threshold).astype(np.int32))

        return run

    return linear.score_texts(docs, scorer, "score double, predicted int", keep)
