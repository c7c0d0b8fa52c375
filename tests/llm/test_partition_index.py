"""Learned-partition search: exact scores and ties against brute force, recall on whole tables, edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tabml.llm import partition_index as pi
from tabml.llm import queries


def truth(ids, x, asks, k):
    """Per query position: [(id, score)] by a plain loop over components."""
    out = {}
    for q in np.flatnonzero(asks):
        score = np.zeros(len(x))
        for j in range(x.shape[1]):
            score += x[q, j] * x[:, j]
        order = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-score[i], ids[i]))[:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


@pytest.mark.parametrize("sf", [SF001, SF01, "/root/testdata/sf0.1"])
def test_recall_on_the_table(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, x = e.vec_id.to_numpy(), np.stack(e.embedding.to_numpy()).astype(float)
    want = truth(ids, x, ids % 20 == 0, 20)
    got = {}
    for r in queries.op12_learned_partitions(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    hit, exact = 0, {int(ids[q]): dict(zip(ids.tolist(), pi.exact(np.repeat(x[q][None], len(x), 0), x).tolist())) for q in want}
    for q, rows in want.items():
        mine = sorted(got[int(ids[q])], key=lambda r: r[2])
        assert [r[2] for r in mine] == list(range(1, 21))
        assert mine == sorted(mine, key=lambda r: (-r[1], r[0]))
        assert all(r[1] == exact[int(ids[q])][r[0]] and r[0] != ids[q] for r in mine)
        hit += len({r[0] for r in mine} & {i for i, _ in rows})
    assert hit / (20 * len(want)) >= 0.9


def test_copies_ties_and_edges(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(pi, "PART_ROWS", 32)
    monkeypatch.setattr(pi, "CELL_ROWS", 50)                   # a part of copies is dealt to several cells
    monkeypatch.setattr(pi, "CELL_QUERIES", 7)
    x = rng.normal(size=(600, 5))
    x[:250] = x[0]                                             # copies
    x[250:300] = x[250] + 1e-3 * rng.normal(size=(50, 5))
    ids = np.r_[np.arange(598), 5, 40]                         # repeated ids
    bad = [(900, None), (901, [0.0] * 5), (920, [1.0, None, 0.0, 0.0, 0.0]), (940, [float("nan")] * 5),
           (960, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 5), (980, [])]
    docs = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)] + bad, "vec_id long, embedding array<double>") \
        .withColumn("part", F.lit("x")).withColumn("uid", F.lit(None).cast("int")).repartition(4)
    out = pi.search(docs, F.col("vec_id") % 20 == 0, k=30, target=1.0)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = truth(ids, x, ids % 20 == 0, 30)
    hits = 0
    for q, rows in want.items():
        mine = sorted(got[int(ids[q])])
        if list(ids).count(ids[q]) == 1:
            hits += sum((a[1], a[2]) == b for a, b in zip(mine, rows))
    assert hits >= 0.9 * 30 * (len(want) - 2)
    some = got[100]
    assert len(got[40]) == 60                                  # two rows of one id: each searched for itself
    assert [r[1] for r in sorted(some)] == sorted(r[1] for r in some)   # all ties: ascending id


def test_few_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pi.search(empty, F.col("vec_id") % 20 == 0).count() == 0
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0]), (2, [0.5, 1.0]), (20, None)], "vec_id long, embedding array<float>")
    rows = pi.search(three, F.col("vec_id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in rows) == [(0, 1, 1, 2.0), (0, 2, 2, 0.5)]
    assert pi.search(three, F.col("vec_id") > 100).count() == 0


def test_balanced_parts_cut_less():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1600, 12)) + 3 * rng.normal(size=(8, 12))[rng.integers(0, 8, 1600)]
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    near = np.argsort(-s, axis=1)[:, :10].astype(np.int32)
    before = pi.halved(x, 16)
    after = pi.balanced(near, before, 16)
    assert np.bincount(before, minlength=16).max() <= 101
    assert np.bincount(after, minlength=16).max() <= 111

    def cut(part):
        return (part[near] != part[:, None]).mean()

    assert cut(after) < cut(before)
