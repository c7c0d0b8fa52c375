import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabml.operators import metrics as me, models as mo


def _blobs(spark, seed=3):
    rng = np.random.default_rng(seed)
    pts = []
    for cx, cy, n in [(0, 0, 40), (10, 10, 25), (-10, 8, 15)]:
        for x, y in rng.normal([cx, cy], 0.5, size=(n, 2)):
            pts.append((float(x), float(y)))
    df = spark.createDataFrame(pts, "x double, y double")
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)


def test_kmeans_blobs_sizes_sse_silhouette(spark):
    df = _blobs(spark)
    model = mo.fit_kmeans(df, k=3, seed=1)
    scored = model.transform(df)
    sizes = sorted(r["n"] for r in scored.groupBy("prediction").agg(F.count("*").alias("n")).collect())
    assert sizes == [15, 25, 40]
    one = me.sse(df.withColumn("c", F.lit(0)), "features", "c").head()["sse"]  # k = 1: the mean
    sse = [one] + [mo.fit_kmeans(df, k=k, seed=1).summary.trainingCost for k in (2, 3)]
    assert sse[0] > sse[1] > sse[2]
    # our SSE and silhouette agree with Spark's
    cen = mo.centers(model, spark).groupBy("cluster").agg(
        F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("s")).select(
        "cluster", F.col("s.value").alias("center"))
    ours = me.sse(scored.withColumnRenamed("prediction", "cluster"), "features", "cluster", cen)
    assert abs(ours.agg(F.sum("sse")).head()[0] - model.summary.trainingCost) < 1e-6
    from pyspark.ml.evaluation import ClusteringEvaluator
    ref = ClusteringEvaluator().evaluate(scored)
    got = me.silhouette(scored, "features", "prediction").head()["silhouette"]
    assert abs(ref - got) < 1e-9


def test_trees_beat_majority(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    df = li.select(F.when(F.col("l_quantity") >= 25, 1.0).otherwise(0.0).alias("label"),
                   "l_quantity", "l_discount")
    data = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features").transform(df)
    majority = max(data.agg(F.avg("label")).head()[0], 1 - data.agg(F.avg("label")).head()[0])
    for fit in (mo.fit_tree, mo.fit_forest):
        m = fit(data, max_depth=3, seed=5)
        acc = me.accuracy(m.transform(data)).head()["accuracy"]
        assert acc > majority + 0.1


def test_tree_nodes_rows(spark):
    df = spark.createDataFrame([(float(i % 2), float(i)) for i in range(40)], "label double, x double")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        df.withColumn("label", (F.col("x") >= 20).cast("double")))
    m = mo.fit_tree(data, max_depth=2)
    nodes = mo.tree_nodes(m, spark).collect()
    root = [n for n in nodes if n.node == 0][0]
    assert root.depth == 0 and root.feature == 0 and 19 <= root.threshold <= 20
    leaves = [n for n in nodes if n.left is None]
    assert {n.prediction for n in leaves} == {0.0, 1.0}
    assert all(n.depth <= 2 for n in nodes)


def test_check_bins(spark):
    from tabml.operators import features as fe
    from pyspark.ml import Pipeline
    df = spark.createDataFrame([(str(i), float(i % 2)) for i in range(40)], "k string, label double")
    stages = [fe.indexer(["k"], ["ki"]), VectorAssembler(inputCols=["ki"], outputCol="features")]
    data = Pipeline(stages=stages).fit(df).transform(df)
    try:
        mo.fit_tree(data, max_bins=32)
        raised = False
    except ValueError as e:
        raised = "maxBins" in str(e)
    assert raised


def test_ols_matches_closed_form(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        li.withColumnRenamed("l_extendedprice", "label"))
    m = mo.fit_linear(data, solver="normal")
    assert abs(m.coefficients[0] - 7.161722084) < 1e-6
    assert abs(m.intercept - 52872.347339) < 1e-4
    coefs = {r.feature: r.coefficient for r in mo.coefficients(m, data).collect()}
    assert set(coefs) == {"l_quantity", "intercept"}
    met = me.regression_metrics(m.transform(data)).head()
    assert abs(met["r2"] - m.summary.r2) < 1e-9
    assert abs(met["rmse"] - m.summary.rootMeanSquaredError) < 1e-6


def test_tree_nodes_impurity_from_stats(spark):
    df = spark.createDataFrame([(float(x), float(x * x % 7)) for x in range(50)], "x double, label double")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    m = mo.fit_tree_regressor(data, max_depth=2)
    nodes = {n.node: n for n in mo.tree_nodes(m, spark).collect()}
    var = df.agg(F.var_pop("label")).head()[0]
    assert abs(nodes[0].impurity - var) < 1e-9
    assert all(n.impurity >= 0 for n in nodes.values())
    assert sum(n.n for n in nodes.values() if n.left is None) == 50


def test_sse_keeps_rows_without_a_centre(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (0, [2.0, 0.0]), (1, [5.0, 5.0])],
                               "c int, x array<double>")
    cen = spark.createDataFrame([(0, [1.0, 0.0])], "cluster int, center array<double>")
    out = {r.cluster: (r.n, r.sse) for r in me.sse(df, "x", "c", cen).collect()}
    assert out == {0: (2, 2.0), 1: (1, None)}


def test_silhouette_null_cluster_is_a_cluster(spark):
    rows = [(None, [0.0, 0.0]), (None, [0.1, 0.0]), (1, [5.0, 5.0]), (1, [5.1, 5.0])]
    df = spark.createDataFrame(rows, "c int, x array<double>")
    got = me.silhouette(df, "x", "c").head()
    filled = me.silhouette(df.fillna(0, ["c"]), "x", "c").head()
    assert got["n"] == 4 and abs(got["silhouette"] - filled["silhouette"]) < 1e-12


def test_sse_null_cluster_meets_its_centre(spark):
    df = spark.createDataFrame([(None, [0.0]), (None, [2.0]), (1, [5.0])], "c int, x array<double>")
    out = {r.cluster: (r.n, r.sse) for r in me.sse(df, "x", "c").collect()}
    assert out == {None: (2, 2.0), 1: (1, 0.0)}


def test_pinned_parts_do_not_grow_with_the_table(spark, monkeypatch):
    """At least as many parts as asked for, and more where these would be larger than ``PART``."""
    monkeypatch.setattr(mo, "PART", "1m", raising=False)
    advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for n in (10000, 4000000):
        data = mo.pin(spark.range(0, n, 1, 4).select("id", F.rand(1).alias("x")), partitions=3)
        sizes = data.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 250000
        assert data.agg(F.count_distinct("id")).first()[0] == n
        data.unpersist()
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == advised
