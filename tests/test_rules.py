"""Rules on raw columns route rows as the model does: unknown and NULL categories, missing numbers, forests."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabml.operators import features as fe, models as mo, rules as ru


def _fit(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = [("abcdef"[int(k)], float(x), float(y), float((k in (1, 4)) ^ (x > 0.3) or y > 2))
            for k, x, y in zip(rng.integers(0, 6, 500), rng.normal(size=500), rng.normal(size=500))]
    raw = spark.createDataFrame(rows, "kind string, x double, y double, label double")
    pm = Pipeline(stages=[fe.indexer(["kind"], handle_invalid="keep"),
                          VectorAssembler(inputCols=["kind_idx", "x", "y"], outputCol="features", handleInvalid="keep")]).fit(raw)
    return raw, pm, pm.transform(raw)


def test_leaves_as_the_model(spark):
    raw, pm, data = _fit(spark)
    odd = spark.createDataFrame([("zzz", 0.1, 0.0, 0.0), (None, -1.0, 3.0, 1.0), ("a", float("nan"), 1.0, 0.0)], raw.schema)
    rows = pm.transform(raw.unionByName(odd))
    for model in (mo.fit_tree(data, max_depth=5), mo.fit_tree_regressor(data, label="y", max_depth=4)):
        leaf = ru.leaf_column(model, data)
        assert model.setLeafCol("_leaf").transform(rows).filter(leaf != F.col("_leaf")).count() == 0
        table = {r.leaf: r for r in ru.leaf_rules(model, data).collect()}
        assert sorted(table) == list(range(len(table)))
        mean = {r.leaf: r for r in ru.leaf_summary(raw, leaf, model.getLabelCol()).collect()}
        for k, r in table.items():
            assert mean[k].n == r.n
            if model.getLabelCol() == "y":
                assert abs(mean[k].mean - r.prediction) < 1e-9
    text = " ".join(r.rule for r in table.values())
    assert "kind in [" in text or "x <= " in text
    assert "kind in ['" in " ".join(r.rule for r in ru.leaf_rules(mo.fit_tree(data, max_depth=5), data).collect())


def test_forest_trees(spark):
    raw, _, data = _fit(spark, 1)
    model = mo.fit_forest(data, num_trees=3, max_depth=4).setLeafCol("_leaf")
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(data).withColumn("_l", vector_to_array("_leaf"))
    for t in range(3):
        assert scored.filter(ru.leaf_column(model, data, tree=t) != F.get("_l", F.lit(t))).count() == 0
    assert ru.leaf_rules(model, data).select("tree").distinct().count() == 3


def test_one_node_and_bare_vectors(spark):
    _, _, data = _fit(spark)
    flat = data.withColumn("label", F.lit(1.0))
    assert [r.rule for r in ru.leaf_rules(mo.fit_tree(flat), flat).collect()] == ["true"]
    assert "Predict: 1.0" in mo.debug_string(mo.fit_tree(flat))
    from pyspark.ml.linalg import Vectors
    bare = spark.createDataFrame([(Vectors.dense([1.0]), 1.0), (Vectors.dense([2.0]), 0.0)], ["features", "label"])
    with pytest.raises(ValueError, match="no complete ML attributes"):
        ru.leaf_rules(mo.fit_tree(bare), bare)


def test_joined_index_and_slots_as_sparks(spark):
    raw, _, _ = _fit(spark)
    raw = raw.unionByName(spark.createDataFrame([(None, 0.0, 1.0, 0.0)], raw.schema))
    cmap = fe.category_map(raw, "kind")
    spark_idx = fe.indexer(["kind"], ["i"], handle_invalid="keep").fit(raw).transform(raw)
    mine = fe.index_by_map(spark_idx, "kind", cmap, "j", "keep")
    assert mine.count() == 501 and mine.filter("i <> j").count() == 0
    assert fe.index_by_map(raw, "kind", cmap, handle_invalid="skip").count() == 500
    with pytest.raises(Exception, match="unknown value of kind: NULL"):
        fe.index_by_map(raw, "kind", cmap).collect()
    from pyspark.ml.functions import vector_to_array
    stages = fe.feature_stages(["kind"], ["x"], handle_invalid="keep")
    dense = Pipeline(stages=stages).fit(raw).transform(raw).select("kind", "x", vector_to_array("features").alias("v"))
    s = fe.sparse_slots(fe.index_by_map(dense, "kind", cmap, handle_invalid="keep"), [("kind_idx", cmap)], ["x"], keep=True)
    for r in s.collect():
        assert {t.slot: t.value for t in r.slots} == {i: v for i, v in enumerate(r.v) if v}


def test_category_per_row(spark):
    """50,000 categories; the plan stays as small as for two."""
    many = spark.range(50_000).select((F.col("id") * 7919 % 100_003).alias("k"))
    out = fe.index_by_map(many, "k", fe.category_map(many, "k"))
    row = out.agg(F.count_distinct("k_idx").alias("n"), F.min("k_idx").alias("lo"), F.max("k_idx").alias("hi")).first()
    assert tuple(row) == (50_000, 0.0, 49_999.0)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000
