"""Hard negatives against brute force, the bounds of zone maps, and edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tabml.llm import hard_negatives as hn
from tabml.llm import queries


def brute(rows, positives=5, negatives=3, low=50, high=95):
    """(anchor, positive, rank, negative, scores) of rows (id, label, integer vector, anchor)."""
    out = []
    for a, (ida, la, va, asks) in enumerate(rows):
        if not asks:
            continue
        s = sorted((-sum(int(x) * int(y) for x, y in zip(va, r[2])), r[0], i) for i, r in enumerate(rows) if i != a)
        pos = [t for t in s if rows[t[2]][1] == la][:positives]
        for ps, pid, _ in pos:
            neg = [t for t in s if rows[t[2]][1] != la and low * -ps <= 100 * -t[0] <= high * -ps][:negatives]
            out += [(ida, pid, k + 1, nid, -ps, -ns) for k, (ns, nid, _) in enumerate(neg)]
    return sorted(out)


def test_whole_table(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet").toPandas()
    rows = [(int(i), int((lab + 1) % 10 if i % 7 == 0 else lab), np.floor(256 * np.asarray(v, float)).astype(int), i % 50 == 0)
            for i, v, lab in zip(e.vec_id, e.embedding, e.label)]
    got = queries.op13_hilbert_zone_negatives(spark, SF001)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("seed,scale", [(0, 1.0), (1, 1e6)])
def test_clusters_copies_and_bad_rows(spark, monkeypatch, seed, scale):
    """Clusters, copies, repeated ids, ties, negative scores; large components take the integer path."""
    monkeypatch.setattr(hn, "ZONE", 3)
    monkeypatch.setattr(hn, "DECK", 5)
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, 4))
    x = centre[rng.integers(0, 6, 300)] + 0.2 * rng.normal(size=(300, 4))
    x[:60] = x[0]
    x[60] = -x[0]
    x[61] = 0
    x *= scale
    ids = np.r_[np.arange(297), 10, 50, 50]
    label = rng.integers(0, 4, 300)
    label[299] = 77                                            # the only row of its label: no positives
    data = [(int(i), v.tolist(), int(lab)) for i, v, lab in zip(ids, x, label)]
    bad = [(1000, None, 1), (1050, [1.0, None, 1.0, 1.0], 1), (1100, [float("nan")] * 4, 1), (1150, [1.0] * 4, None),
           (1200, [float("-inf")] * 4, 1), (None, [1.0] * 4, 1)]
    t = spark.createDataFrame(data + bad, "vec_id long, embedding array<double>, label int") \
        .withColumn("block", F.lit("x")).withColumn("uid", F.lit(1)).repartition(5)
    got = sorted(tuple(r) for r in hn.mine(t, F.col("vec_id") % 10 == 0, block=16).collect())
    rows = [(i, lab, [int(np.floor(256 * c)) for c in v], i % 10 == 0) for i, v, lab in data]
    assert got == brute(rows)
    assert any(r[4] > 0 for r in got)


def test_bounds_hold_and_spare_blocks(spark):
    rng = np.random.default_rng(5)
    centre = 5 * rng.normal(size=(12, 8))
    which = rng.integers(0, 12, 4000)
    x = np.floor(256 * (centre[which] + 0.1 * rng.normal(size=(4000, 8))))
    place = hn.hilbert(np.clip((x @ hn.curve(x)[0] - hn.curve(x)[1]) / hn.curve(x)[2], 0, 63).astype(int))
    y = x[np.argsort(place)]
    low = np.stack([y[i:i + 50].min(axis=0) for i in range(0, 4000, 50)])
    high = np.stack([y[i:i + 50].max(axis=0) for i in range(0, 4000, 50)])
    lower, upper = hn.bounds(x[:20], low, high)
    s = (x[:20] @ y.T).reshape(20, 80, 50)
    assert (lower <= s.min(axis=2)).all() and (s.max(axis=2) <= upper).all()
    best = np.sort(x[:20] @ x.T, axis=1)[:, -6]
    assert (upper >= best[:, None]).mean() < 0.5               # most blocks need not be read


def test_hilbert_is_a_curve():
    """Every cell once, and cells that follow are neighbours."""
    n = 1 << 3
    cells = np.stack(np.meshgrid(*[np.arange(n)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    place = hn.hilbert(cells, 3)
    assert sorted(place.tolist()) == list(range(n ** 3))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hn.mine(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1), (1, [], 1), (2, [0.5], 2)], schema)
    assert hn.mine(one, F.col("vec_id") % 50 == 0).count() == 0     # the positive scores 0, the negative more
    none = spark.createDataFrame([(1, [1.0], 1)], schema)
    assert hn.mine(none, F.col("vec_id") % 50 == 0).count() == 0
    with pytest.raises(ValueError, match="long"):
        hn.mine(spark.createDataFrame([(0, [1e30], 1)], schema), F.col("vec_id") % 50 == 0)
