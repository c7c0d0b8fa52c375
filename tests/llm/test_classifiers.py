"""Toxicity, quality and language: held-out accuracy, edge cases, and the
optimisers against plain definitions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tabml.llm import language, linear, quality, queries, toxicity


def test_ftrl_learns_few_weights():
    rng = np.random.default_rng(3)
    x, y = [], []
    for _ in range(600):
        idx = rng.choice(200, 12, replace=False) + 2
        label = int(rng.random() < 0.3)
        x.append((np.append(idx, label), np.ones(13)))      # feature 1 tells the label, 0 its absence
        y.append(label)
    w = linear.ftrl(x, y, 300, 1.0, 1.0, 4.0, 0.0, 5)
    assert w[1] > 1.5 and (w[2:300] != 0).mean() < 0.1


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 5))
    y = (m @ np.array([1.0, -2, 0.5, 0, 0]) + 0.3 * rng.normal(size=60) > 0).astype(int)
    w = linear.dual_hinge([(np.arange(5), r) for r in m], y.tolist(), 5, 1.0, 1.0, 500)
    s = np.where(y > 0, 1, -1)

    def primal(v):
        return 0.5 * v @ v + np.maximum(0, 1 - s * (m @ v[:5] + v[5])).sum()

    best = primal(w)
    for _ in range(300):
        assert primal(w + rng.normal(size=6) * 0.05) >= best - 1e-3


def test_ftrl_against_a_plain_loop():
    """The published update, coordinate by coordinate, on Python floats."""
    rng = random.Random(4)
    rows = [(sorted(rng.sample(range(12), 4)), rng.randrange(2)) for _ in range(40)]
    alpha, beta, l1, l2, epochs = 0.7, 1.0, 1.5, 0.1, 3
    z, n = [0.0] * 13, [0.0] * 13

    def weight(i):
        limit = 0.0 if i == 12 else l1
        if abs(z[i]) <= limit:
            return 0.0
        return -(z[i] - math.copysign(limit, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for on, label in rows:
            on = [*on, 12]
            w = {i: weight(i) for i in on}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in on:
                rate = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - rate * w[i]
                n[i] += g * g
    got = linear.ftrl([(np.array(on), np.ones(4)) for on, _ in rows], [y for _, y in rows], 12, alpha, beta, l1, l2, epochs)
    want = [weight(i) for i in range(13)]
    assert np.allclose(got, want, atol=1e-12) and 0 < sum(w == 0 for w in want) < 12


def test_shards_share_no_task(spark):
    """Each of several shards is fitted by itself, in a task of its own."""
    rows = [(i, i % 2, f"t{i}") for i in range(400)]
    sample = spark.createDataFrame(rows, "key long, label int, text string")

    def features():
        return lambda data, off: (np.zeros(len(off) - 1, np.int64), np.ones(len(off) - 1), np.arange(len(off)))

    def one(x, y):
        from pyspark import TaskContext
        w = np.zeros(1000)
        w[TaskContext.get().partitionId()] = len(x)
        return {"rows": w}

    got = linear.fit_shards(sample, 4, features, one)["rows"]
    shard = spark.range(400).selectExpr("pmod(xxhash64(id), 4) s").groupBy("s").count().collect()
    assert sorted(v * 4 for v in got.values()) == sorted(r["count"] for r in shard) and len(got) == 4


def edge_docs(spark):
    rows = [(1, None), (2, ""), (3, "123 !!"), (None, "a null id"), (4, "x " * 400_000), (5, "idiot"), (5, "idiot")]
    return spark.createDataFrame([(a, b, "k", 0.5) for a, b in rows], "doc_id long, text string, label string, h double")


def test_toxicity_held_out(spark):
    out = queries.op5_ftrl_toxicity(spark, SF01)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 1000
    rows = out.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").filter("held_out").collect()
    wrong = sum(r.predicted for r in rows if not r.toxic)
    assert wrong == 0 and sum(r.predicted for r in rows if r.toxic) >= 6
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([a > b for a in pos for b in neg]) > 0.9      # 286 rows to learn from


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    out = toxicity.score(docs, {1 << toxicity.BITS: -1.0}, ["doc_id", "label", "h"]).collect()
    assert len(out) == 7 and all(abs(r.score - 0.2689) < 1e-3 and r.predicted == 0 for r in out)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, none, F.lit(True)) == {}
    some = spark.createDataFrame([(1, 1), (5, None), (None, 1), (5, 1), (5, 0), (99, 1)], "doc_id long, toxic int")
    sample, shards = linear.labelled_sample(docs, some, "toxic", F.lit(True), 100)
    assert sorted((r.key, r.label, r.text) for r in sample.collect()) == [(1, 1, ""), (5, 1, "idiot")] and shards == 1
    assert toxicity.score(docs.limit(0), {}, ["doc_id"]).count() == 0


def test_quality_held_out(spark):
    out = queries.op6_nbsvm_quality(spark, SF01)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 1000
    rows = out.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted != r.quality for r in rows) <= 1


def test_quality_edges(spark):
    docs = edge_docs(spark)
    one = spark.createDataFrame([(1, 1), (5, 1)], "doc_id long, quality int")
    model = quality.fit(docs, one, F.lit(True))
    rows = quality.score(docs, model, ["doc_id", "label", "h"]).collect()
    assert len(rows) == 7 and all(r.score > 0.99 for r in rows)
    none = quality.fit(docs, one.limit(0), F.lit(True))
    assert {r.score for r in quality.score(docs, none, ["doc_id"]).collect()} == {0.5}


def test_quality_ratios_against_counts(spark):
    rows = [(1, 1, "good fine good"), (2, 0, "bad bad"), (3, 1, "")]
    ratio = quality.log_count_ratios(spark.createDataFrame(rows, "key long, label int, text string"))
    on = [set(), set()]
    n = np.ones((2, 1 << quality.BITS))
    for _, label, text in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        _, f = quality.hashed(raw, np.array([0, len(raw)]), quality._tables(), quality.Powers())
        on[label] |= set(f.tolist())
        for i in set(f.tolist()):
            n[label, i] += 1
    want = np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())
    assert np.allclose(ratio, want) and on[0] and on[1]


def test_language_held_out(spark):
    out = queries.op7_language_hierarchy(spark, SF01)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == 1000
    rows = out.join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang != r.lang_pred for r in rows if r.held_out) <= 4


def test_language_edges_and_many_families(spark):
    rng = random.Random(2)
    sounds = {"en": "the of ing", "nl": "het van ij", "de": "der und sch", "es": "el de cion", "xx": "zz qq ww"}
    rows = [(i, " ".join(rng.choice(sounds[k].split()) for _ in range(30)), k) for i, k in enumerate(list(sounds) * 20)]
    rows += [(1000, None, "en"), (1001, "12 ...", "en"), (1002, "the the", None), (None, "der und", "de"), (1003, "é", "es")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, `idx 2` int")
    model = language.fit(docs, F.lit(True))
    assert sorted(model.groups) == ["germanic", "romance", "xx"] and sum(k.startswith("pair") for k in model.weights) == 3
    got = {r.doc_id: r for r in language.predict(docs, model, ["doc_id", "idx 2"]).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:100]) and got[1002].lang_pred == "en"
    assert got[1000].lang_pred == got[1001].lang_pred == "und" and got[1000].score == 0 and got[1003].lang_pred != "und"
    none = language.fit(docs.filter("lang is null"), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, none, ["doc_id"]).collect()} == {"und"}
    long = spark.createDataFrame([(1, "der und " * 700_000)], "doc_id long, text string")
    assert language.predict(long, model, ["doc_id"]).first().lang_pred == "de"


def test_language_votes_against_direct_products(spark):
    """Family by the largest product, then one vote of each pair within it."""
    rng = random.Random(6)
    sounds = {"en": "the of ing", "nl": "het van ij", "de": "der und sch", "es": "el de cion", "fr": "le des eau"}
    rows = [(i, " ".join(rng.choice(sounds[k].split()) for _ in range(12)), k) for i, k in enumerate(list(sounds) * 12)]
    mixed = [(500 + i, " ".join(rng.choice(" ".join(sounds.values()).split()) for _ in range(7))) for i in range(80)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))

    def dot(name, text):
        raw = np.frombuffer(text.encode(), np.uint8)
        idx, _ = language.hashed(raw, np.array([0, len(raw)]), language._gram_tables())
        w = model.weights[name]
        return language.SCALE * sum(float(w[i]) for i in idx) / max(len(idx), 1) + float(w[-1])

    def direct(text):
        family = max(model.groups, key=lambda f: dot(f"family {f}", text)) if len(model.groups) > 1 else next(iter(model.groups))
        votes = {i: 0.0 for i in model.groups[family]}
        for a, b in itertools.combinations(model.groups[family], 2):
            m = dot(f"pair {a} {b}", text)
            votes[a if m > 0 else b] += 1
            votes[a] += 1e-3 * math.tanh(m)
            votes[b] -= 1e-3 * math.tanh(m)
        return model.languages[max(votes, key=votes.get)]

    docs = spark.createDataFrame(mixed, "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model, ["doc_id"]).collect()}
    assert got == {i: direct(t) for i, t in mixed} and len(set(got.values())) >= 4


def test_queries_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF01}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for query in (queries.op5_ftrl_toxicity, queries.op6_nbsvm_quality, queries.op7_language_hierarchy):
        out = query(spark, str(tmp_path))
        assert out.columns[:2] == ["doc_id", "held_out"] and out.count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_weights_do_not_depend_on_partitions(spark, parts):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").limit(200).repartition(parts)
    labels = spark.read.parquet(f"{SF01}/labels.parquet").repartition(parts)
    w = toxicity.fit(docs.filter("doc_id < 300"), labels, F.lit(True))
    want = toxicity.fit(docs.filter("doc_id < 300").coalesce(1), labels.coalesce(1), F.lit(True))
    assert w == want
