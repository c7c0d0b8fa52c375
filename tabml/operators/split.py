"""Splits (S2, S3).

``random_split`` is Spark's Bernoulli split; like the reference's it depends
on the input partitioning unless the input order is fixed.  ``hash_split`` is
the reproducible form: a row's part is a function of its key alone, so it is
the same on any cluster size, after any task retry and in any SQL engine.

A key split keeps all rows of a key on one side (no group straddles train
and test).  If one key holds a large share of the rows the part sizes follow
it; pass several columns (a row-unique key) as ``key`` when the proportions
matter more than keeping groups together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_bucket

BUCKETS = 10000


def _bounds(weights: Sequence[float], buckets: int) -> list[tuple[int, int]]:
    tot = float(sum(weights))
    if tot <= 0 or any(w < 0 for w in weights):
        raise ValueError(f"bad split weights {weights!r}")
    cuts, acc = [0], 0.0
    for w in weights:
        acc += w
        cuts.append(int(round(buckets * acc / tot)))
    cuts[-1] = buckets
    return list(zip(cuts[:-1], cuts[1:]))


def split_column(key: str, weights: Sequence[float], names: Sequence[str] | None = None,
                 buckets: int = BUCKETS):
    """A Column naming each row's part, e.g. 'train' / 'test'."""
    names = list(names or [f"part{i}" for i in range(len(weights))])
    b = hash_bucket(key, buckets)
    expr = None
    for (lo, hi), name in zip(_bounds(weights, buckets), names):
        cond = (b >= lo) & (b < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def with_split(df: DataFrame, key: str, weights: Sequence[float],
               names: Sequence[str] = ("train", "test"), out: str = "part",
               buckets: int = BUCKETS) -> DataFrame:
    """S3 as a column: tag each row with its part once (e.g. before a table
    is cached), so later passes filter on a stored value instead of hashing
    the key again."""
    return df.withColumn(out, split_column(key, weights, names, buckets))


def hash_split(df: DataFrame, key: str, weights: Sequence[float],
               buckets: int = BUCKETS) -> list[DataFrame]:
    """S3: disjoint, complete parts by key hash.  Map-only (no shuffle); each
    part is a filter over the same scan."""
    b = hash_bucket(key, buckets)
    return [df.filter((b >= lo) & (b < hi)) for lo, hi in _bounds(weights, buckets)]


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Spark's weighted random split, always seeded."""
    return df.randomSplit(list(weights), seed=seed)
