"""Registered queries: one per operator group of the survey's inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver's whole test
tables.  ``ORACLE_SQL`` holds, for every query with a closed form, the same
result in DuckDB SQL over the same parquet tables; queries that come from an
iterative fit (trees, forests, k-means, ALS, tuning) have none and are
checked by invariants in ``tests/``.  Computed columns carry the same alias
on both sides and doubles are rounded to 4 decimals on both sides.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_bucket
from ..operators import (features as fe, metrics as me, models as mo, optimality as op, prep,
                         recommend as rc, rules as ru, split as sp, stats as st, tuning as tu)
from ..session import ensure_checkpoint_dir, ensure_utc
from ..sources import table
from ..streaming import logstream as ls
from . import jobs

R = 4  # decimals kept for doubles on both sides of the check

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def reg(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return reg


def _r(c, d: int = R):
    """Round to ``d`` decimals as round(x * 10^d) / 10^d: both engines then
    round the same IEEE double (HALF_UP on the decimal text of an unscaled
    double can differ from it at exact ties such as 1499.04075)."""
    x = F.col(c) if isinstance(c, str) else c
    m = float(10 ** d)
    return F.round(x * F.lit(m)) / F.lit(m)


LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# The category lists of the grouping query (parameters of
# B13 chosen for the stand-in nation names).
KEEP_NATIONS = ["NATION_0", "NATION_1", "NATION_2", "NATION_3"]
GROUPED_NATIONS = ["NATION_5", "NATION_6", "NATION_7", "NATION_8",
                   "NATION_9", "NATION_10", "NATION_11", "NATION_12"]
# The test tables are files of one row group, read by one task: multi-pass
# jobs are asked to deal them to this many partitions.
SPREAD = 8


# --------------------------------------------------------------- flagship
def regression_holdout(spark: SparkSession, d: str) -> DataFrame:
    """Minimum slice: scan -> ratio -> key-hash split -> index/encode/assemble
    -> OLS -> metrics on both parts, ``(dataset, metric, value)``."""
    li = table(spark, d, "lineitem")
    li = prep.ratio(li, "unit_price", "l_extendedprice", "l_quantity")
    li = prep.rename(li, {"l_extendedprice": "label"})
    cat, num = ["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount", "l_tax", "unit_price"]
    stages = fe.feature_stages(cat, num, handle_invalid="keep")
    data = sp.with_split(li, "l_orderkey", [0.8, 0.2])
    with mo.prepared(data, ["part", "label", *cat, *num], SPREAD) as base:
        train = base.filter(F.col("part") == "train")
        hold = base.filter(F.col("part") == "test")
        pm = Pipeline(stages=stages).fit(train)
        tr = pm.transform(train).select("label", "features")
        model = mo.fit_linear(tr, solver="normal")
        out = (me.metrics_long(me.regression_metrics(model.transform(tr)), "train")
               .unionByName(me.metrics_long(
                   me.regression_metrics(model.transform(pm.transform(hold))), "holdout")))
        return mo.small(out.select("dataset", "metric", _r("value").alias("value")))


query("regression_holdout")(regression_holdout)


# ------------------------------------------------------------ prep (B, S)
@query("filter_fill_rename", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       nullif(o_orderpriority, '1-URGENT') AS prio,
       coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END, 0) AS label
FROM orders WHERE o_orderstatus <> 'P'
""")
def filter_fill_rename(spark, d):
    o = table(spark, d, "orders")
    o = o.withColumn("views", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")))
    o = o.withColumn("prio", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")))
    o = prep.filter_expr(o, "o_orderstatus <> 'P'")
    o = prep.drop_columns(o, "o_orderdate", "no_such_column")
    o = prep.fill_zero(o, ["views", "prio"])        # the string column is left alone
    o = prep.rename(o, {"views": "label"})
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "prio", "label")


@query("ratio_scale", f"""
SELECT l_orderkey, l_linenumber,
       round(l_extendedprice / nullif(l_quantity, 0), {R}) AS unit_price,
       round(l_tax / nullif(l_discount, 0), {R}) AS tax_per_discount,
       l_quantity * 100 AS l_quantity, 1 AS one
FROM lineitem
""")
def ratio_scale(spark, d):
    li = table(spark, d, "lineitem")
    li = prep.ratio(li, "unit_price", "l_extendedprice", "l_quantity")
    li = prep.ratio(li, "tax_per_discount", "l_tax", "l_discount")   # discount 0 -> NULL
    li = prep.scale(li, "l_quantity", 100)
    li = li.withColumn("one", F.lit(1))
    return li.select("l_orderkey", "l_linenumber", _r("unit_price").alias("unit_price"),
                     _r("tax_per_discount").alias("tax_per_discount"), "l_quantity", "one")


@query("threshold_labels", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS big_qty,
       CASE WHEN l_discount > 0 THEN 0 ELSE 1 END AS no_discount
FROM lineitem
""")
def threshold_labels(spark, d):
    li = table(spark, d, "lineitem")
    li = prep.threshold_label(li, "big_qty", "l_quantity", 25)
    li = prep.inverted_label(li, "no_discount", "l_discount", 0)
    return li.select("l_orderkey", "l_linenumber", "big_qty", "no_discount")


def _in(vals):
    return ", ".join(f"'{v}'" for v in vals)


@query("group_categories", f"""
SELECT CASE WHEN n_name IN ({_in(KEEP_NATIONS)}) THEN n_name
            WHEN n_name IN ({_in(GROUPED_NATIONS)}) THEN 'EUROPE'
            ELSE 'OTHER' END AS nation_group,
       count(*) AS n
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1
""")
def group_categories(spark, d):
    # count per nation key first (map-side partial aggregation), so the join
    # and the grouping run on one row per nation, not one per customer
    per = st.count_by(table(spark, d, "customer"), "c_nationkey")
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = per.join(nat, per.c_nationkey == nat.n_nationkey, "left")
    g = prep.group_categories(j, "n_name", KEEP_NATIONS, {"EUROPE": GROUPED_NATIONS},
                              out="nation_group")
    return g.groupBy("nation_group").agg(F.sum("n").cast("bigint").alias("n"))


@query("group_categories_table", """
SELECT coalesce(r_name, 'OTHER') AS nation_group, count(*) AS n
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
              LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY 1
""")
def group_categories_table(spark, d):
    """B13 with a mapping table (value -> group) instead of IN lists."""
    per = st.count_by(table(spark, d, "customer"), "c_nationkey")
    mapping = (table(spark, d, "nation").join(table(spark, d, "region"),
                                             F.col("n_regionkey") == F.col("r_regionkey"))
               .select("n_nationkey", "r_name"))
    g = prep.group_categories(per, "c_nationkey", mapping=mapping, out="nation_group")
    return g.groupBy("nation_group").agg(F.sum("n").cast("bigint").alias("n"))


@query("distinct_index_values", """
SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS brand_index,
       p_brand AS value
FROM part GROUP BY p_brand
""")
def distinct_index_values(spark, d):
    p = table(spark, d, "part").select("p_brand")
    idx = StringIndexer(inputCol="p_brand", outputCol="brand_index").fit(p).transform(p)
    dist = prep.distinct_values(idx, "brand_index")
    return fe.index_to_value(dist, "brand_index", "value").select("brand_index", "value")


@query("hash_split_counts", """
SELECT CASE WHEN b < 8000 THEN 'train' ELSE 'test' END AS part,
       count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM (SELECT o_orderkey,
             ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 10000 AS b
      FROM orders)
GROUP BY 1
""")
def hash_split_counts(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    o = o.withColumn("part", sp.split_column("o_orderkey", [0.8, 0.2], ["train", "test"]))
    return o.groupBy("part").agg(F.count(F.lit(1)).alias("n"),
                                 F.sum("o_orderkey").cast("bigint").alias("key_sum"))


@query("random_split_sizes")
def random_split_sizes(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    a, b = sp.random_split(o, [0.8, 0.2], seed=42)
    return (a.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("train"))
            .unionByName(b.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("test"))))


@query("key_filter_limit", """
SELECT o_orderkey, o_custkey, o_totalprice
FROM orders WHERE o_orderstatus = 'F'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def key_filter_limit(spark, d):
    o = prep.filter_key(table(spark, d, "orders"), "o_orderstatus", "F")
    return (o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey"))
            .limit(5).select("o_orderkey", "o_custkey", "o_totalprice"))


# ----------------------------------------------------------- stats (C)
def _corr_sql(cols):
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), {R}) AS corr FROM lineitem"
             for a in cols for b in cols]
    return "\nUNION ALL\n".join(parts)


@query("corr_matrix", _corr_sql(LINE_NUMERIC))
def corr_matrix(spark, d):
    li = prep.drop_columns(table(spark, d, "lineitem"), "l_orderkey", "l_partkey",
                           "l_suppkey", "l_linenumber")
    cols = prep.numeric_columns(li)          # B14: reflect on the remaining fields
    return st.corr_matrix(li, cols).select("col_a", "col_b", _r("corr").alias("corr"))


def _summary_sql(cols):
    parts = [f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), {R}) AS mean, "
             f"round(stddev_samp({c}), {R}) AS stddev, round(min({c}), {R}) AS min, "
             f"round(max({c}), {R}) AS max FROM lineitem" for c in cols]
    return "\nUNION ALL\n".join(parts)


@query("summarize", _summary_sql(LINE_NUMERIC))
def summarize(spark, d):
    s = st.summarize(table(spark, d, "lineitem"), LINE_NUMERIC)
    return s.select("column", "count", *[_r(c).alias(c) for c in ("mean", "stddev", "min", "max")])


# The event types of the test tables, which are the pivot's columns.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("pivot_sum", "SELECT user_id, " + ", ".join(
    f"round(sum(value) FILTER (WHERE event_type = '{t}'), {R}) AS {t}" for t in EVENT_TYPES) + " FROM events GROUP BY user_id")
def pivot_sum(spark, d):
    p = st.pivot_sum(table(spark, d, "events"), "user_id", "event_type", "value")
    return p.select("user_id", *[_r(c).alias(c) for c in p.columns if c != "user_id"])


@query("count_by_pair", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def count_by_pair(spark, d):
    return st.count_by(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


# -------------------------------------------------------- features (E)
@query("category_map", """
SELECT p_brand AS value, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS index,
       count(*) AS n
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
""")
def category_map(spark, d):
    return fe.category_map(table(spark, d, "part"), "p_brand")


@query("category_map_numeric", """
SELECT CAST(p_size AS VARCHAR) AS value,
       row_number() OVER (ORDER BY count(*) DESC, CAST(p_size AS VARCHAR)) - 1 AS index,
       count(*) AS n
FROM part WHERE p_size IS NOT NULL GROUP BY p_size
""")
def category_map_numeric(spark, d):
    return fe.category_map(table(spark, d, "part"), "p_size")


@query("one_hot_assemble", """
WITH rf AS (SELECT l_returnflag AS v,
                   row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS i
            FROM lineitem GROUP BY 1),
     ls AS (SELECT l_linestatus AS v,
                   row_number() OVER (ORDER BY count(*) DESC, l_linestatus) - 1 AS i
            FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1,
       CAST(CASE WHEN rf.i = 0 THEN 1 ELSE 0 END AS DOUBLE) AS f2,
       CAST(CASE WHEN rf.i = 1 THEN 1 ELSE 0 END AS DOUBLE) AS f3,
       CAST(CASE WHEN ls.i = 0 THEN 1 ELSE 0 END AS DOUBLE) AS f4
FROM lineitem JOIN rf ON l_returnflag = rf.v JOIN ls ON l_linestatus = ls.v
""")
def one_hot_assemble(spark, d):
    li = table(spark, d, "lineitem")
    stages = fe.feature_stages(["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount"],
                               handle_invalid="error")
    out = Pipeline(stages=stages).fit(li).transform(li)
    return fe.vector_columns(out, "features", keep=("l_orderkey", "l_linenumber"))


# ---------------------------------------------------------- models (F)
@query("linear_ols", """
SELECT 'l_quantity' AS feature, round(regr_slope(l_extendedprice, l_quantity), 4) AS coefficient
FROM lineitem
UNION ALL
SELECT 'intercept', round(regr_intercept(l_extendedprice, l_quantity), 4) FROM lineitem
""")
def linear_ols(spark, d):
    li = table(spark, d, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    model = mo.fit_linear(data, solver="normal")
    return mo.coefficients(model, data).select("feature", _r("coefficient").alias("coefficient"))


@query("linear_fixed_enet")
def linear_fixed_enet(spark, d):
    li = table(spark, d, "lineitem")
    data = VectorAssembler(inputCols=["l_extendedprice", "l_discount", "l_tax"],
                           outputCol="features").transform(
        li.withColumn("label", F.col("l_extendedprice") * (1 - F.col("l_discount"))))
    model = mo.fit_linear(data, reg=0.3, enet=0.8, max_iter=10)
    return mo.coefficients(model, data)


@query("logistic_binary_feature", """
WITH p AS (SELECT avg(CASE WHEN toxic = 1 THEN quality END) AS p1,
                  avg(CASE WHEN toxic = 0 THEN quality END) AS p0 FROM labels)
SELECT 'toxic' AS feature, round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 3) AS coefficient FROM p
UNION ALL
SELECT 'intercept', round(ln(p0 / (1 - p0)), 3) FROM p
""")
def logistic_binary_feature(spark, d):
    lab = table(spark, d, "labels").select(F.col("quality").cast("double").alias("label"),
                                           F.col("toxic").cast("double").alias("toxic"))
    data = VectorAssembler(inputCols=["toxic"], outputCol="features").transform(lab)
    model = mo.fit_logistic(data, tol=1e-10, max_iter=200)
    return mo.coefficients(model, data).select("feature", _r("coefficient", 3).alias("coefficient"))


def _stump_data(spark, d):
    li = table(spark, d, "lineitem")
    li = prep.threshold_label(li, "label", "l_quantity", 25)
    li = prep.threshold_label(li, "x", "l_quantity", 20)
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(
        li.withColumn("x", F.col("x").cast("double"))).select("label", "features")


@query("tree_stump", """
WITH t AS (SELECT CASE WHEN l_quantity >= 20 THEN 1 ELSE 0 END AS x,
                  CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS y FROM lineitem),
     m AS (SELECT x, CASE WHEN avg(y) > 0.5 THEN 1.0 ELSE 0.0 END AS pred, count(*) AS n
           FROM t GROUP BY x)
SELECT CAST(pred AS DOUBLE) AS prediction, CAST(sum(n) AS BIGINT) AS n FROM m GROUP BY pred
""")
def tree_stump(spark, d):
    data = _stump_data(spark, d)
    model = mo.fit_tree(data, max_depth=1)
    return st.count_by(model.transform(data), "prediction")


@query("tree_rules", f"""
WITH t AS (SELECT CASE WHEN l_quantity >= 20 THEN 1 ELSE 0 END AS x,
                  CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS y FROM lineitem),
     r AS (SELECT count(*) AS n, avg(y) AS p FROM t),
     c AS (SELECT x, count(*) AS n, avg(y) AS p FROM t GROUP BY x),
     g AS (SELECT 1 - p * p - (1 - p) * (1 - p) AS imp, n, p, x FROM c),
     root AS (SELECT r.n, r.p, 1 - r.p * r.p - (1 - r.p) * (1 - r.p) AS imp,
                     (1 - r.p * r.p - (1 - r.p) * (1 - r.p))
                     - sum(g.n * g.imp) / r.n AS gain
              FROM r, g GROUP BY r.n, r.p)
SELECT 0 AS tree, 0 AS node, 0 AS depth, 0 AS feature, CAST(0.5 AS DOUBLE) AS threshold,
       1 AS "left", 2 AS "right", CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
       round(imp, {R}) AS impurity, round(gain, {R}) AS gain, n
FROM root
UNION ALL
SELECT 0, CAST(1 + x AS INTEGER), 1, CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE),
       CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
       CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS DOUBLE), round(imp, {R}), CAST(NULL AS DOUBLE), n
FROM g
""")
def tree_rules(spark, d):
    """A depth-3 tree on one 0/1 feature has one split (at the
    midpoint 0.5) and two leaves, so its node table has a closed form."""
    data = _stump_data(spark, d)
    nodes = mo.tree_nodes(mo.fit_tree(data, max_depth=3), spark)
    return nodes.select("tree", "node", "depth", "feature", "threshold", "left", "right",
                        "prediction", _r("impurity").alias("impurity"),
                        _r("gain").alias("gain"), "n")


def _tree_data(spark, d):
    """Free-trial stand-in: lineitem + part, brand grouped to few values,
    label quantity >= 25."""
    li = table(spark, d, "lineitem")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey, "left")
    j = prep.group_categories(j, "p_brand", ["Brand#1", "Brand#2", "Brand#3"],
                              {"GROUP_A": ["Brand#4", "Brand#5", "Brand#6", "Brand#7"]},
                              out="brand_group")
    return prep.threshold_label(j, "label", "l_quantity", 25)


@query("forest_accuracy")
def forest_accuracy(spark, d):
    acc, _ = jobs.compare_trees(_tree_data(spark, d), "label",
                                ["l_discount", "l_tax", "l_extendedprice"], "brand_group",
                                key="l_orderkey", partitions=SPREAD)
    return acc


@query("tree_regressor")
def tree_regressor(spark, d):
    li = table(spark, d, "lineitem").withColumn("label", F.col("l_extendedprice"))
    data = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"],
                           outputCol="features").transform(li)
    model = mo.fit_tree_regressor(data, max_depth=3)
    return me.metrics_long(me.regression_metrics(model.transform(data)), "train")


def _embeddings(spark, d):
    from pyspark.ml.functions import array_to_vector
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label",
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query("kmeans_sizes")
def kmeans_sizes(spark, d):
    """F8 + C1: fit k-means, score, rows per cluster."""
    emb = _embeddings(spark, d)
    model = mo.fit_kmeans(emb, k=3, seed=1)
    return st.count_by(model.transform(emb).withColumnRenamed("prediction", "cluster"), "cluster")


@query("kmeans_centers")
def kmeans_centers(spark, d):
    model = mo.fit_kmeans(_embeddings(spark, d), k=3, seed=1)
    return mo.centers(model, spark)


# --------------------------------------------------------- metrics (H)
@query("regression_metrics", f"""
SELECT count(*) AS n,
       round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), {R}) AS r2,
       round(sqrt(avg((y - p) * (y - p))), {R}) AS rmse,
       round(avg((y - p) * (y - p)), {R}) AS mse,
       round(avg(abs(y - p)), {R}) AS mae
FROM (SELECT l_extendedprice AS y, l_quantity * 1500.0 AS p FROM lineitem)
""")
def regression_metrics(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("label"),
                                            (F.col("l_quantity") * 1500.0).alias("prediction"))
    m = me.regression_metrics(li)
    return m.select("n", *[_r(c).alias(c) for c in ("r2", "rmse", "mse", "mae")])


@query("confusion", """
SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction, count(*) AS n
FROM labels GROUP BY 1, 2
""")
def confusion(spark, d):
    return me.confusion(table(spark, d, "labels"), "quality", "toxic")


@query("class_rates", f"""
WITH c AS (SELECT CAST(quality AS DOUBLE) AS l, CAST(toxic AS DOUBLE) AS p FROM labels),
     k AS (SELECT l AS class FROM c UNION SELECT p FROM c),
     s AS (SELECT class,
                  CAST(sum(CASE WHEN l = class AND p = class THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                  CAST(sum(CASE WHEN l = class THEN 1 ELSE 0 END) AS BIGINT) AS a,
                  CAST(sum(CASE WHEN p = class THEN 1 ELSE 0 END) AS BIGINT) AS pr,
                  CAST(count(*) AS BIGINT) AS t,
                  CAST(sum(CASE WHEN l = p THEN 1 ELSE 0 END) AS BIGINT) AS ok
           FROM k, c GROUP BY class)
SELECT class, tp, a - tp AS fn, pr - tp AS fp, t - a - pr + tp AS tn,
       round(tp / a, {R}) AS tpr, round((pr - tp) / (t - a), {R}) AS fpr,
       round(tp / pr, {R}) AS precision, round((t - a - pr + tp) / (t - a), {R}) AS specificity,
       round(ok / t, {R}) AS accuracy
FROM s
""")
def class_rates(spark, d):
    r = me.class_rates(table(spark, d, "labels"), "quality", "toxic")
    rates = ("tpr", "fpr", "precision", "specificity", "accuracy")
    return r.select("class", "tp", "fn", "fp", "tn", *[_r(c).alias(c) for c in rates])


@query("accuracy", f"""
SELECT count(*) AS n, round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), {R}) AS accuracy
FROM labels
""")
def accuracy(spark, d):
    a = me.accuracy(table(spark, d, "labels"), "quality", "toxic")
    return a.select("n", _r("accuracy").alias("accuracy"))


_EMB = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"""


@query("sse_by_label", f"""
WITH {_EMB},
     u AS (SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS dim FROM e),
     c AS (SELECT label, dim, avg(v) AS m FROM u GROUP BY label, dim)
SELECT u.label AS cluster, CAST(count(DISTINCT u.vec_id) AS BIGINT) AS n,
       round(sum((u.v - c.m) * (u.v - c.m)), {R}) AS sse
FROM u JOIN c ON u.label = c.label AND u.dim = c.dim
GROUP BY u.label
""")
def sse_by_label(spark, d):
    e = table(spark, d, "embeddings")
    s = me.sse(e, "embedding", "label")
    return s.select("cluster", "n", _r("sse").alias("sse"))


@query("silhouette_by_label", f"""
WITH {_EMB},
     dd AS (SELECT a.vec_id, a.label AS la, b.label AS lb,
                   list_inner_product(a.x, a.x) + list_inner_product(b.x, b.x)
                   - 2 * list_inner_product(a.x, b.x) AS dist
            FROM e a JOIN e b ON a.vec_id <> b.vec_id),
     per AS (SELECT vec_id, la, lb, avg(dist) AS md FROM dd GROUP BY 1, 2, 3),
     own AS (SELECT vec_id, md AS a FROM per WHERE la = lb),
     oth AS (SELECT vec_id, min(md) AS b FROM per WHERE la <> lb GROUP BY vec_id),
     pts AS (SELECT e.vec_id, own.a, oth.b FROM e LEFT JOIN own USING (vec_id)
                                                LEFT JOIN oth USING (vec_id))
SELECT count(*) AS n,
       round(avg(CASE WHEN a IS NULL THEN 0 WHEN a < b THEN 1 - a / b
                      WHEN a > b THEN b / a - 1 ELSE 0 END), {R}) AS silhouette
FROM pts
""")
def silhouette_by_label(spark, d):
    s = me.silhouette(table(spark, d, "embeddings"), "embedding", "label")
    return s.select("n", _r("silhouette").alias("silhouette"))


@query("score_and_rescore", f"""
WITH t AS (SELECT l_extendedprice AS x, l_extendedprice * (1 - l_discount) AS y FROM lineitem),
     f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t),
     p AS (SELECT y, a + b * x AS p FROM t, f),
     m AS (SELECT count(*) AS n,
                  1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) AS r2,
                  sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae FROM p),
     k AS (SELECT * FROM (VALUES ('scored'), ('rescored')) v(dataset))
SELECT dataset, metric, round(value, {R}) AS value FROM k, (
    SELECT 'n' AS metric, CAST(n AS DOUBLE) AS value FROM m UNION ALL
    SELECT 'r2', r2 FROM m UNION ALL SELECT 'rmse', rmse FROM m UNION ALL
    SELECT 'mae', mae FROM m)
""")
def score_and_rescore(spark, d):
    li = table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("x"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("label"))
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(li)
    model = mo.fit_linear(data, solver="normal")
    scored = model.transform(data)
    rescored = model.transform(prep.drop_outputs(scored))    # B4: outputs dropped first
    pick = ("n", "r2", "rmse", "mae")
    out = (me.metrics_long(me.regression_metrics(scored).select(*pick), "scored")
           .unionByName(me.metrics_long(me.regression_metrics(rescored).select(*pick), "rescored")))
    return out.select("dataset", "metric", _r("value").alias("value"))


# ---------------------------------------------------------- tuning (G)
@query("tune_leaderboard")
def tune_leaderboard(spark, d):
    li = table(spark, d, "lineitem").withColumn(
        "net", F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
    _, board = jobs.tuned_regression(li, "net", ["l_extendedprice", "l_discount", "l_tax"],
                                     ["l_returnflag", "l_linestatus"], key="l_orderkey",
                                     report=False, partitions=SPREAD)
    return board


# ------------------------------------------------------ recommend (F9, I)
def _ratings(spark, d):
    """Course-view stand-in: customer x part, rating = mean quantity."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(
        (F.avg("l_quantity") / 50.0).alias("rating"))


@query("als_top_k")
def als_top_k(spark, d):
    r = _ratings(spark, d)
    model = rc.fit_als(prep.scale(r, "rating", 100.0), "user", "item", "rating")
    return rc.top_k(model, 5)


@query("recs_with_history")
def recs_with_history(spark, d):
    return jobs.recommend_courses(_ratings(spark, d), "user", "item", "rating", k=5)


@query("top_k_from_factors", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
     s AS (SELECT u.vec_id AS "user", i.vec_id AS item, list_inner_product(u.x, i.x) AS score
           FROM e u, e i),
     r AS (SELECT "user", item, score,
                  row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank
           FROM s)
SELECT "user", CAST(rank AS INTEGER) AS rank, item, round(score, {R}) AS score
FROM r WHERE rank <= 5
""")
def top_k_from_factors(spark, d):
    e = table(spark, d, "embeddings")
    t = rc.top_k_from_factors(e, e, 5, "vec_id", "embedding", "vec_id", "embedding")
    return t.select("user", "rank", "item", _r("score").alias("score"))


# -------------------------------------------------------- log lines (L)
@query("parse_lines", """
SELECT event_id, upper(event_type) AS level, date_trunc('second', ts) AS ts FROM events
""")
def parse_lines(spark, d):
    ensure_utc(spark)
    ev = table(spark, d, "events")
    lines = ls.render_lines(ev, "event_type", "ts", keep=("event_id",))
    good, _bad = ls.parse_lines(lines)
    return good.select("event_id", "level", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("level_counts", """
SELECT date_trunc('day', ts) AS window_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type AS level, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def level_counts(spark, d):
    ensure_utc(spark)
    ev = table(spark, d, "events")
    return ls.level_counts(ev, "ts", "event_type", window="1 day", watermark="1 hour")


@query("level_share", f"""
SELECT event_type AS level, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (), {R}) AS share
FROM events GROUP BY 1
""")
def level_share(spark, d):
    s = ls.level_share(table(spark, d, "events"), "event_type")
    return s.select("level", "n", _r("share").alias("share"))


# ------------------------------------------------------------ jobs
@query("job_screen_fields", _corr_sql(LINE_NUMERIC))
def job_screen_fields(spark, d):
    out = jobs.screen_fields(table(spark, d, "lineitem"),
                             drop=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return out.select("col_a", "col_b", _r("corr").alias("corr"))


@query("job_in_sample_regression")
def job_in_sample_regression(spark, d):
    return jobs.in_sample_regression(table(spark, d, "lineitem"), "l_extendedprice",
                                     ["l_quantity", "l_discount", "l_tax"], ["l_linestatus"], SPREAD)


@query("job_tuned_regression")
def job_tuned_regression(spark, d):
    li = table(spark, d, "lineitem")
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey, "left")
    j = prep.ratio(j, "price_ratio", "l_extendedprice", "p_retailprice")
    j = prep.fill_zero(j, ["price_ratio"])
    metrics, _ = jobs.tuned_regression(j, "l_extendedprice", ["l_quantity", "price_ratio"],
                                       ["l_returnflag", "l_linestatus", "p_brand"],
                                       key="l_orderkey", partitions=SPREAD)
    return metrics


def _subscribers(spark, d):
    """Subscriber stand-in: orders + customer; NULLs made with nullif then
    filled; label 1 = "nothing" (inverted threshold on the price)."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    j = prep.filter_expr(j, "o_orderstatus <> 'P'")
    j = j.withColumn("acctbal", F.nullif(F.col("c_acctbal"), F.lit(0.0)))
    j = prep.fill_zero(j, ["acctbal"])
    j = prep.inverted_label(j, "label", "o_totalprice", 150000)
    return j


def _classifier_reports(spark, d):
    """The tuned classifier job's three reports: accuracy, class rates,
    confusion."""
    return jobs.tuned_classifier(
        _subscribers(spark, d), "label", ["acctbal"], ["o_orderpriority", "c_mktsegment"],
        key="o_orderkey", partitions=SPREAD)


@query("job_tuned_classifier")
def job_tuned_classifier(spark, d):
    return _classifier_reports(spark, d)[0]


@query("job_classifier_rates")
def job_classifier_rates(spark, d):
    return _classifier_reports(spark, d)[1]


@query("job_classifier_confusion")
def job_classifier_confusion(spark, d):
    return _classifier_reports(spark, d)[2]


@query("job_compare_trees")
def job_compare_trees(spark, d):
    _, tree = jobs.compare_trees(_tree_data(spark, d), "label",
                                 ["l_discount", "l_tax", "l_extendedprice"], "brand_group",
                                 key="l_orderkey", partitions=SPREAD)
    return mo.tree_nodes(tree, spark)


@query("job_segment")
def job_segment(spark, d):
    _, quality, _ = jobs.segment(_embeddings(spark, d), "features", k=3, seed=1, partitions=SPREAD)
    return quality


# ------------------------------------------------ Spark's own ML read-outs
@query("ols_training_summary", f"""
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b,
                  regr_intercept(l_extendedprice, l_quantity) AS a,
                  regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem),
     e AS (SELECT l_extendedprice - (a + b * l_quantity) AS err, r2 FROM lineitem, f)
SELECT 'r2' AS metric, round(max(r2), 8) AS value FROM e
UNION ALL SELECT 'rootMeanSquaredError', round(sqrt(avg(err * err)), {R}) FROM e
UNION ALL SELECT 'meanAbsoluteError', round(avg(abs(err)), {R}) FROM e
""")
def ols_training_summary(spark, d):
    """H1: R^2 / RMSE / MAE from the fitted model's training summary."""
    li = table(spark, d, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    s = mo.training_summary(mo.fit_linear(data, solver="normal"), spark)
    s = s.filter(F.col("metric").isin("r2", "rootMeanSquaredError", "meanAbsoluteError"))
    return s.select("metric", F.when(F.col("metric") == "r2", _r("value", 8))
                    .otherwise(_r("value")).alias("value"))


@query("evaluator_accuracy", f"""
SELECT 'accuracy' AS metric, round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), {R}) AS value
FROM labels
UNION ALL
SELECT 'weightedRecall', round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), {R}) FROM labels
""")
def evaluator_accuracy(spark, d):
    """H6: Spark's MulticlassClassificationEvaluator on stored guesses."""
    lab = table(spark, d, "labels").select(F.col("quality").cast("double").alias("label"),
                                           F.col("toxic").cast("double").alias("prediction"))
    rows = [(m, float(tu.evaluator(m).evaluate(lab))) for m in ("accuracy", "weightedRecall")]
    return spark.createDataFrame(rows, "metric string, value double").select(
        "metric", _r("value").alias("value"))


@query("indexer_numeric", """
SELECT p_size, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(p_size AS VARCHAR)) - 1 AS DOUBLE)
       AS size_index
FROM part GROUP BY p_size
""")
def indexer_numeric(spark, d):
    """E1b with Spark's StringIndexer: a numeric column indexed by its text."""
    p = table(spark, d, "part").select("p_size")
    idx = fe.indexer(["p_size"], ["size_index"]).fit(p).transform(p)
    return prep.distinct_values(idx, "p_size", "size_index")


@query("stream_level_counts", """
SELECT date_trunc('day', ts) AS window_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type AS level, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def stream_level_counts(spark, d):
    """L2 as a Structured Streaming query: the events file read as a stream,
    windowed counts with a 1-hour watermark in complete mode, run to the end
    of the available input (availableNow) into the per-epoch parquet sink
    below the shared checkpoint folder, then read back."""
    res = _streamed(spark, d, "complete")
    last = res.agg(F.max("epoch"))                # complete mode: the last epoch has it all
    return res.filter(F.col("epoch") == last.scalar()).drop("epoch")


@query("stream_closed_windows", """
SELECT date_trunc('day', ts) AS window_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type AS level, count(*) AS n
FROM events GROUP BY 1, 2, 3
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
""")
def stream_closed_windows(spark, d):
    """L2 in append mode: each window once, as soon as the watermark passes
    its end; the windows still open are withheld."""
    return _streamed(spark, d, "append").drop("epoch")


def _streamed(spark, d, mode):
    from ..session import scratch_path
    ensure_utc(spark)
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    out = scratch_path(spark, "stream-out")
    q = ls.start_level_counts(spark, stream, scratch_path(spark, "stream-ckpt"), sink="parquet",
                              path=out, level="event_type", mode=mode)
    q.awaitTermination()
    return spark.read.parquet(out)


@query("id_map_users", """
SELECT o_custkey, CAST(row_number() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS id
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
""")
def id_map_users(spark, d):
    """F9 prerequisite: dense 32-bit ids for (possibly 64-bit) user keys,
    numbered by a distributed sort, not one task."""
    return rc.id_map(table(spark, d, "orders"), "o_custkey", "id")


@query("centers_by_label", f"""
WITH e AS (SELECT label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
     u AS (SELECT label, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS dim FROM e)
SELECT label AS cluster, CAST(dim AS INTEGER) AS dim, round(avg(v), {R}) AS value
FROM u GROUP BY label, dim
""")
def centers_by_label(spark, d):
    """H9 long form for clusters given by a label: the mean vector per
    cluster as ``(cluster, dim, value)`` rows."""
    c = me.cluster_means(table(spark, d, "embeddings"), "embedding", "label")
    return c.select("cluster", F.posexplode("center").alias("dim", "value")).select(
        "cluster", "dim", _r("value").alias("value"))


# ------------------------------------------- the same statistics on NULLs
# NULLs made by rule on both sides: discount 0 and the highest tax are absent.
_NULLS = ("SELECT l_orderkey, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, "
          "CASE WHEN l_tax < 0.08 THEN l_tax END AS l_tax FROM lineitem")


def _with_nulls(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_quantity", "l_extendedprice",
                     F.nullif(F.col("l_discount"), F.lit(0)).alias("l_discount"),
                     F.when(F.col("l_tax") < 0.08, F.col("l_tax")).alias("l_tax"))


@query("corr_matrix_nulls", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), {R}) AS corr FROM ({_NULLS})"
    for a in LINE_NUMERIC for b in LINE_NUMERIC))
def corr_matrix_nulls(spark, d):
    m = st.corr_matrix(_with_nulls(spark, d), LINE_NUMERIC)
    return m.select("col_a", "col_b", _r("corr").alias("corr"))


WIDE = 45


@query("corr_matrix_wide", f"""
WITH t AS ({_NULLS})
SELECT 'c' || i AS col_a, 'l_discount' AS col_b,
       round(corr(CASE WHEN l_orderkey % 47 <> i THEN l_quantity * (i + 1) + l_extendedprice / 1000 END, l_discount), {R}) AS corr
FROM t, (SELECT unnest(range({WIDE})) AS i) GROUP BY i
""")
def corr_matrix_wide(spark, d):
    """45 more columns with NULLs of their own: no pair changes with the
    number of columns."""
    t = _with_nulls(spark, d)
    t = t.select("l_discount", *[F.when(F.col("l_orderkey") % 47 != i, F.col("l_quantity") * (i + 1) + F.col("l_extendedprice") / 1000)
                                 .alias(f"c{i}") for i in range(WIDE)])
    m = st.corr_matrix(t).filter("col_b = 'l_discount' AND col_a <> 'l_discount'")
    return m.select("col_a", "col_b", _r("corr").alias("corr"))


@query("regression_metrics_nulls", f"""
WITH t AS (SELECT l_extendedprice AS y, l_quantity * 1500.0 + 0 * l_discount AS p FROM ({_NULLS})),
     c AS (SELECT * FROM t WHERE y IS NOT NULL AND p IS NOT NULL)
SELECT count(*) AS n, round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), {R}) AS r2,
       round(sqrt(avg((y - p) * (y - p))), {R}) AS rmse, round(avg((y - p) * (y - p)), {R}) AS mse,
       round(avg(abs(y - p)), {R}) AS mae, (SELECT count(*) FROM t) - count(*) AS incomplete
FROM c
""")
def regression_metrics_nulls(spark, d):
    t = _with_nulls(spark, d).select(F.col("l_extendedprice").alias("label"),
                                     (F.col("l_quantity") * 1500.0 + F.col("l_discount") * 0).alias("prediction"))
    return me.regression_metrics(t).select("n", *[_r(c).alias(c) for c in ("r2", "rmse", "mse", "mae")]) \
        .crossJoin(me.incomplete_pairs(t))          # one row each


_LABEL_NULLS = ("SELECT CAST(nullif(quality, 0) AS DOUBLE) AS l, "
                "CAST(CASE WHEN doc_id % 3 > 0 THEN nullif(toxic, 0) END AS DOUBLE) AS p FROM labels")


def _labels_with_nulls(spark, d):
    return table(spark, d, "labels").select(
        F.nullif(F.col("quality"), F.lit(0)).alias("quality"),
        F.when(F.col("doc_id") % 3 > 0, F.nullif(F.col("toxic"), F.lit(0))).alias("toxic"))


@query("accuracy_nulls", f"""
SELECT count(*) AS n, round(avg(CASE WHEN l IS NOT DISTINCT FROM p THEN 1.0 ELSE 0.0 END), {R}) AS accuracy
FROM ({_LABEL_NULLS})
""")
def accuracy_nulls(spark, d):
    return me.accuracy(_labels_with_nulls(spark, d), "quality", "toxic").select("n", _r("accuracy").alias("accuracy"))


@query("class_rates_nulls", f"""
WITH c AS ({_LABEL_NULLS}), k AS (SELECT l AS class FROM c UNION SELECT p FROM c),
     s AS (SELECT class,
                  count(*) FILTER (WHERE l IS NOT DISTINCT FROM class AND p IS NOT DISTINCT FROM class) AS tp,
                  count(*) FILTER (WHERE l IS NOT DISTINCT FROM class) AS a,
                  count(*) FILTER (WHERE p IS NOT DISTINCT FROM class) AS pr,
                  count(*) AS t, count(*) FILTER (WHERE l IS NOT DISTINCT FROM p) AS ok
           FROM k, c GROUP BY class)
SELECT class, tp, a - tp AS fn, pr - tp AS fp, t - a - pr + tp AS tn,
       round(tp / a, {R}) AS tpr, round((pr - tp) / (t - a), {R}) AS fpr, round(tp / pr, {R}) AS precision,
       round((t - a - pr + tp) / (t - a), {R}) AS specificity, round(ok / t, {R}) AS accuracy
FROM s
""")
def class_rates_nulls(spark, d):
    r = me.class_rates(_labels_with_nulls(spark, d), "quality", "toxic")
    rates = ("tpr", "fpr", "precision", "specificity", "accuracy")
    return r.select("class", "tp", "fn", "fp", "tn", *[_r(c).alias(c) for c in rates])


@query("hash_split_null_key", """
SELECT CASE WHEN ('0x' || substr(md5(coalesce(nullif(o_orderpriority, '5-LOW'), chr(30) || 'NULL')), 1, 8))::BIGINT % 10000 < 8000
            THEN 'train' ELSE 'test' END AS part, count(*) AS n
FROM orders GROUP BY 1
""")
def hash_split_null_key(spark, d):
    """S3 on a key with NULLs: the parts hold every row."""
    o = table(spark, d, "orders").select(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("key"))
    return sp.with_split(o, "key", [0.8, 0.2]).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("random_split_report", """
SELECT (SELECT count(*) FROM orders) AS total, CAST(0 AS BIGINT) AS shared, CAST(0 AS BIGINT) AS missing
""")
def random_split_report(spark, d):
    """The parts of a random split share no row and miss none."""
    o = table(spark, d, "orders").select("o_orderkey")
    a, b = (x.withColumn("n", F.lit(1)) for x in sp.random_split(o, [0.8, 0.2], seed=42))
    per = o.withColumn("n", F.lit(0)).unionByName(a).unionByName(b).groupBy("o_orderkey").agg(F.sum("n").alias("n"))
    return per.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("n") > 1).alias("shared"),
                   F.count_if(F.col("n") < 1).alias("missing"))


# ------------------------------------------------ closed forms of the fits
_ENET = [(lam, a) for lam in (0.3, 2000.0, 20000.0) for a in (0.0, 0.5, 0.8, 1.0)]


@query("linear_enet_closed_form", f"""
WITH s AS (SELECT stddev_pop(l_quantity) AS sx, stddev_pop(l_extendedprice) AS sy, corr(l_quantity, l_extendedprice) AS r,
                  avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem),
     g AS (SELECT * FROM (VALUES {", ".join(f"({lam}, {a})" for lam, a in _ENET)}) v(lam, a)),
     b AS (SELECT lam, a, sign(r) * greatest(abs(r) - lam / sy * a, 0) / (1 + lam / sy * (1 - a)) * sy / sx AS b, mx, my FROM s, g)
SELECT CAST(lam AS DOUBLE) AS lam, CAST(a AS DOUBLE) AS alpha, round(b, 3) AS slope, round(my - b * mx, 2) AS intercept FROM b
""")
def linear_enet_closed_form(spark, d):
    """Elastic net on one feature over several penalties."""
    li = table(spark, d, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    rows = []
    for lam, a in _ENET:
        m = mo.fit_linear(data, reg=lam, enet=a, tol=1e-12, max_iter=500)
        rows.append((lam, a, float(m.coefficients[0]), float(m.intercept)))
    out = spark.createDataFrame(rows, "lam double, alpha double, slope double, intercept double")
    return out.select("lam", "alpha", _r("slope", 3).alias("slope"), _r("intercept", 2).alias("intercept"))


_GRID = [(lam, a) for a in (0.0, 0.5, 1.0) for lam in (500.0, 2000.0, 8000.0)]


@query("tune_leaderboard_keyed", f"""
WITH t AS (SELECT l_quantity AS x, l_extendedprice + 1000 * l_quantity AS y,
                  ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || chr(31) || '42'), 1, 8))::BIGINT % 10000 >= 8000 AS held
           FROM lineitem),
     s AS (SELECT stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS r, avg(x) AS mx, avg(y) AS my FROM t WHERE NOT held),
     g AS (SELECT * FROM (VALUES {", ".join(f"({lam}, {a})" for lam, a in _GRID)}) v(lam, a)),
     b AS (SELECT lam, a, mx, my,
                  sign(r) * greatest(abs(r) - lam / sy * a, 0) / (1 + lam / sy * (1 - a)) * sy / sx AS b FROM s, g),
     e AS (SELECT lam, a, 1 - sum((y - my - b * (x - mx)) ** 2) / (var_pop(y) * count(*)) AS r2
           FROM b, t WHERE held GROUP BY lam, a)
SELECT CAST(lam AS DOUBLE) AS lam, CAST(a AS DOUBLE) AS alpha, round(r2, {R}) AS r2,
       CAST(row_number() OVER (ORDER BY r2 DESC) AS INTEGER) AS "rank", row_number() OVER (ORDER BY r2 DESC) = 1 AS is_best
FROM e
""")
def tune_leaderboard_keyed(spark, d):
    """Nine elastic nets on one feature, validation rows by key hash."""
    from pyspark.ml.regression import LinearRegression
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_extendedprice") + 1000 * F.col("l_quantity")).alias("label"))
    lr = LinearRegression(tol=1e-12, maxIter=500)
    grid = tu.param_grid(lr, {"regParam": sorted({lam for lam, _ in _GRID}), "elasticNetParam": sorted({a for _, a in _GRID})})
    search = tu.tune(lr, grid, "r2", 0.8, key="l_orderkey")
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    board = tu.leaderboard(spark, search.fit(data))
    return board.select(F.col("regParam").alias("lam"), F.col("elasticNetParam").alias("alpha"), _r("metric").alias("r2"),
                        "rank", "is_best")


@query("forest_stump", ORACLE_SQL["tree_stump"])
def forest_stump(spark, d):
    """trees on one 0/1 feature all split there, so they vote as one."""
    data = _stump_data(spark, d)
    return st.count_by(mo.fit_forest(data, max_depth=1).transform(data), "prediction")


@query("tree_regressor_stump", f"""
SELECT CAST(CASE WHEN l_quantity >= 20 THEN 1 ELSE 0 END AS DOUBLE) AS x, round(avg(l_extendedprice), {R}) AS prediction,
       count(*) AS n
FROM lineitem GROUP BY 1
""")
def tree_regressor_stump(spark, d):
    """a depth-1 regression tree on a 0/1 feature gives the two means."""
    li = prep.threshold_label(table(spark, d, "lineitem"), "x", "l_quantity", 20)
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        li.select(F.col("x").cast("double").alias("x"), F.col("l_extendedprice").alias("label")))
    t = mo.fit_tree_regressor(data, max_depth=1).transform(data)
    return t.groupBy("x", _r("prediction").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("kmeans_two_points", """
SELECT CASE WHEN l_quantity >= 20 THEN 10.0 ELSE -10.0 END::DOUBLE AS center, count(*) AS n, CAST(0 AS DOUBLE) AS sse
FROM lineitem GROUP BY 1
""")
def kmeans_two_points(spark, d):
    """F8 / H9: two distinct points are the two centres, at no cost."""
    li = table(spark, d, "lineitem").select(F.when(F.col("l_quantity") >= 20, 10.0).otherwise(-10.0).alias("x"))
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(li)
    model = mo.fit_kmeans(data, k=2, seed=1)
    s = me.sse(model.transform(data), "features", "prediction")
    c = mo.centers(model, spark).select("cluster", F.col("value").alias("center"))
    return s.join(c, "cluster").select(_r("center").alias("center"), "n", _r("sse").alias("sse"))


@query("tree_rules_categorical", """
SELECT 0 AS node, [0.0, 2.0]::DOUBLE[] AS left_categories, count(*) AS n FROM lineitem
UNION ALL SELECT 1, NULL, count(*) FROM lineitem WHERE l_orderkey % 4 IN (0, 2)
UNION ALL SELECT 2, NULL, count(*) FROM lineitem WHERE l_orderkey % 4 IN (1, 3)
""")
def tree_rules_categorical(spark, d):
    """A category decides the label; its split names the left set."""
    from pyspark.ml.feature import VectorIndexer
    li = table(spark, d, "lineitem").select((F.col("l_orderkey") % 4).cast("double").alias("c"))
    data = VectorAssembler(inputCols=["c"], outputCol="raw").transform(li) \
        .withColumn("label", (F.col("c").isin(1.0, 3.0)).cast("double"))
    data = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(data).transform(data)
    nodes = mo.tree_nodes(mo.fit_tree(data, max_depth=2), spark)
    return nodes.select("node", F.array_sort("left_categories").alias("left_categories"), "n")


@query("als_shape", """
WITH r AS (SELECT DISTINCT o_custkey AS u FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT count(*) AS users, CAST(5 AS BIGINT) AS least, CAST(5 AS BIGINT) AS most, CAST(0 AS BIGINT) AS odd FROM r
""")
def als_shape(spark, d):
    """I2 on ALS: five distinct items of ranks 1 to 5 for each user."""
    per = als_top_k(spark, d).groupBy("user").agg(
        F.count_distinct("item").alias("n"), F.sort_array(F.collect_list("rank")).alias("ranks"))
    return per.agg(F.count(F.lit(1)).alias("users"), F.min("n").alias("least"), F.max("n").alias("most"),
                   F.count_if(F.col("ranks").cast("array<int>") != F.array(*[F.lit(i) for i in range(1, 6)])).alias("odd"))


@query("recs_history_side", f"""
SELECT o_custkey AS "user", l_partkey AS item, round(avg(l_quantity) / 50.0 * 100, {R}) AS score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
""")
def recs_history_side(spark, d):
    """The history rows beside the recommendations."""
    out = jobs.recommend_courses(_ratings(spark, d), "user", "item", "rating", k=5)
    return out.filter("source = 'history'").select("user", "item", _r("score").alias("score"))


@query("csv_parts", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_parts(spark, d):
    """A1 / A2: a table written as several CSV files below the shared folder
    and read back by a glob with a schema."""
    from ..session import scratch_path
    from ..sources import read_csv
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "csv")
    c.repartition(4, "c_custkey").write.option("header", True).csv(path)
    return read_csv(spark, f"{path}/part-*.csv", schema=c.schema)


@query("bad_lines", """
SELECT CASE event_id % 5 WHEN 1 THEN 'no separator' WHEN 2 THEN 'bad level' ELSE 'bad date' END AS reason, count(*) AS n
FROM events WHERE event_id % 5 IN (1, 2, 3) GROUP BY 1
""")
def bad_lines(spark, d):
    """L1: lines spoilt by rule, and the reasons they are refused for."""
    ensure_utc(spark)
    _, bad = ls.parse_lines(_spoilt_lines(spark, d))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _spoilt_lines(spark, d):
    """The events as text lines, three of five spoilt by rule."""
    lines = ls.render_lines(table(spark, d, "events"), "event_type", "ts", keep=("event_id",))
    k = F.col("event_id") % 5
    return lines.withColumn("line", F.when(k == 1, F.regexp_replace("line", ",", " "))
                            .when(k == 2, F.concat(F.lit("9"), "line"))
                            .when(k == 3, F.regexp_replace("line", ",[A-Z][a-z]{2} ", ",XYZ ")).otherwise(F.col("line")))


# ------------------------------- searches, holdouts, optimality, rules, wide categories
@query("corr_matrix_nan", f"""
WITH t AS (SELECT l_quantity, l_extendedprice,
                  CASE WHEN l_orderkey % 100 = 0 THEN 'nan'::DOUBLE WHEN l_orderkey % 100 = 1 THEN NULL ELSE l_discount END AS l_discount
           FROM lineitem)
SELECT a AS col_a, b AS col_b, CASE WHEN a = 'l_discount' OR b = 'l_discount' THEN 'NaN' ELSE CAST(round(r, 3) AS VARCHAR) END AS corr
FROM (SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, corr(l_quantity, l_extendedprice) AS r FROM t
      UNION ALL SELECT 'l_extendedprice', 'l_quantity', corr(l_quantity, l_extendedprice) FROM t
      UNION ALL SELECT c, c, 1.0 FROM (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS c)
      UNION ALL SELECT c, 'l_discount', 0 FROM (SELECT unnest(['l_quantity', 'l_extendedprice']) AS c)
      UNION ALL SELECT 'l_discount', c, 0 FROM (SELECT unnest(['l_quantity', 'l_extendedprice']) AS c))
""")
def corr_matrix_nan(spark, d):
    """A NaN makes its pairs NaN, a NULL is left out; results as text,
    so that NaN compares."""
    li = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice", F.expr(
        "CASE WHEN l_orderkey % 100 = 0 THEN double('NaN') WHEN l_orderkey % 100 = 1 THEN NULL ELSE l_discount END AS l_discount"))
    m = st.corr_matrix(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return m.select("col_a", "col_b", _r("corr", 3).cast("string").alias("corr"))


@query("pivot_cells", f"""
SELECT l_partkey, CAST(l_suppkey AS VARCHAR) AS key, round(sum(l_quantity), {R}) AS sum FROM lineitem GROUP BY 1, 2
""")
def pivot_cells(spark, d):
    """C6 with any number of values, in long form."""
    c = st.pivot_cells(table(spark, d, "lineitem"), "l_partkey", "l_suppkey", "l_quantity")
    return c.select("l_partkey", "key", _r("sum").alias("sum"))


@query("pivot_sparse", f"""
SELECT "user", count(*) AS n_keys, min(k) AS first_key, max(k) AS last_key, round(sum(v), {R}) AS total
FROM (SELECT o_custkey AS "user", CAST(l_partkey AS VARCHAR) AS k, sum(l_quantity) AS v
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1
""")
def pivot_sparse(spark, d):
    """Users by items, far more items than a dense pivot takes."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = st.pivot_sparse(li.join(o, li.l_orderkey == o.o_orderkey), "user", "l_partkey", "l_quantity")
    total = F.aggregate(F.map_values("sums"), F.lit(0.0), lambda a, v: a + v)
    return p.select("user", F.size("sums").cast("bigint").alias("n_keys"), F.array_min(F.map_keys("sums")).alias("first_key"),
                    F.array_max(F.map_keys("sums")).alias("last_key"), _r(total).alias("total"))


_BOARD = ORACLE_SQL["tune_leaderboard_keyed"]


@query("tune_pipeline_best", f"""
WITH board AS ({_BOARD}),
     s AS (SELECT stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS r, avg(x) AS mx, avg(y) AS my
           FROM (SELECT l_quantity AS x, l_extendedprice + 1000 * l_quantity AS y FROM lineitem)),
     b AS (SELECT lam, alpha, mx, my,
                  sign(r) * greatest(abs(r) - lam / sy * alpha, 0) / (1 + lam / sy * (1 - alpha)) * sy / sx AS b
           FROM board, s WHERE is_best)
SELECT lam, alpha, 'l_quantity' AS name, round(b, 2) AS value FROM b
UNION ALL SELECT lam, alpha, 'intercept', round(my - b * mx, 2) FROM b
""")
def tune_pipeline_best(spark, d):
    """G3 + G4: the search as the last stage of a pipeline; its winner, found by
    type in the fitted pipeline and refitted on all rows."""
    from pyspark.ml.regression import LinearRegression
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_extendedprice") + 1000 * F.col("l_quantity")).alias("label"))
    lr = LinearRegression(tol=1e-12, maxIter=500)
    grid = tu.param_grid(lr, {"regParam": sorted({lam for lam, _ in _GRID}), "elasticNetParam": sorted({a for _, a in _GRID})})
    stages = [VectorAssembler(inputCols=["l_quantity"], outputCol="features"), tu.tune(lr, grid, "r2", 0.8, key="l_orderkey")]
    pm = Pipeline(stages=stages).fit(li)
    best = tu.best_model(pm)
    rows = mo.coefficients(best, pm.transform(li))
    return rows.select(F.lit(best.getRegParam()).alias("lam"), F.lit(best.getElasticNetParam()).alias("alpha"),
                       F.col("feature").alias("name"), _r("coefficient", 2).alias("value"))


def _md5_bucket(*cols: str) -> str:
    text = " || chr(31) || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % 10000)"


_RATINGS_SQL = """SELECT o_custkey AS u, l_partkey AS i, avg(l_quantity) / 50.0 AS r
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""


@contextlib.contextmanager
def _held_ratings(r):
    """(training, held-out) ratings: one in five pairs is held out, and all of
    some users and items, who are then unknown to the fit.  The rule hashes three
    times a row and both sides are read several times, so it is applied once."""
    train = (hash_bucket(["user", "item"]) < 8000) & (hash_bucket(["user"]) < 9500) & (hash_bucket(["item"]) < 9700)
    with mo.cached(r.withColumn("train", train), rc.KEPT) as parted:
        yield parted.filter("train").drop("train"), parted.filter("not train").drop("train")


@query("rating_holdout_account", f"""
WITH r AS ({_RATINGS_SQL}),
     s AS (SELECT u, i, {_md5_bucket("u", "i")} < 8000 AND {_md5_bucket("u")} < 9500 AND {_md5_bucket("i")} < 9700 AS train FROM r),
     h AS (SELECT u NOT IN (SELECT u FROM s WHERE train) AS nu, i NOT IN (SELECT i FROM s WHERE train) AS ni FROM s WHERE NOT train)
SELECT cold_start, count(*) AS n, count(*) FILTER (NOT nu AND NOT ni) AS scored, count(*) FILTER (nu AND NOT ni) AS unknown_user,
       count(*) FILTER (ni AND NOT nu) AS unknown_item, count(*) FILTER (nu AND ni) AS unknown_both, true AS better_than_mean
FROM h, (SELECT unnest(['drop', 'nan']) AS cold_start) GROUP BY cold_start
""")
def rating_holdout_account(spark, d):
    """Every held-out rating is scored or counted by what the fit does not
    know, under both cold-start rules.  ``better_than_mean``: the errors are
    finite, and under those of no knowledge at all (a prediction of 0)."""
    # read by both fits and their scores
    with mo.prepared(_ratings(spark, d), None, None, rc.KEPT) as ratings, _held_ratings(ratings) as (train, held):
        out = None
        for cold in ("drop", "nan"):
            model = rc.fit_als(train, "user", "item", "rating", max_iter=3, cold_start=cold)
            row = rc.score_holdout(model, train, held, "user", "item", "rating").withColumn("cold_start", F.lit(cold))
            out = row if out is None else out.unionByName(row)
        zero = held.agg(F.sqrt(F.avg(F.col("rating") * F.col("rating"))).alias("z")).first().z
        return mo.small(out.select("cold_start", "n", "scored", "unknown_user", "unknown_item", "unknown_both",
                                   (F.col("rmse") < zero).alias("better_than_mean")))


@query("rating_holdout")
def rating_holdout(spark, d):
    """Errors of an ALS fit on held-out ratings."""
    # read by the fit and its score
    with mo.prepared(_ratings(spark, d), None, None, rc.KEPT) as ratings, _held_ratings(ratings) as (train, held):
        return mo.small(rc.score_holdout(rc.fit_als(train, "user", "item", "rating"), train, held, "user", "item", "rating"))


@query("als_normal_equations", f"""
SELECT u AS "user", count(*) AS n, 0.0::DOUBLE AS residual FROM ({_RATINGS_SQL}) GROUP BY u
""")
def als_normal_equations(spark, d):
    """after its last half step each ALS user solves its regularised
    normal equations (residual rounded to 3 decimals)."""
    ensure_checkpoint_dir(spark)
    r = prep.scale(_ratings(spark, d), "rating", 100.0).checkpoint(eager=True)   # read by the fit and the lazy residuals
    model = rc.fit_als(r, "user", "item", "rating", max_iter=5, reg=0.1)
    out = op.als_residuals(r, model, "user", "item", "rating", 0.1)
    return out.select(F.col("user").cast("bigint").alias("user"), "n", _r("residual", 3).alias("residual"))


def _kkt_rows(spark, fits):
    """(reg, alpha, n, violation, intercept_violation) of each fit, rounded to 3 decimals."""
    out = None
    for (reg, alpha), row in fits:
        row = row.select(F.lit(float(reg)).alias("reg"), F.lit(float(alpha)).alias("alpha"), "n",
                         _r("violation", 3).alias("violation"), _r("intercept_violation", 3).alias("intercept_violation"))
        out = row if out is None else out.unionByName(row)
    return out


@contextlib.contextmanager
def _assembled(df: DataFrame, cols, stages):
    """``(label, features)`` of a table that is fitted and scored many times:
    indexed, encoded and assembled once, and kept in place of the raw columns."""
    raw = mo.pin(df, cols, SPREAD)
    try:
        data = mo.pin(Pipeline(stages=stages).fit(raw).transform(raw), ["label", "features"])
    finally:
        raw.unpersist()
    try:
        yield data
    finally:
        data.unpersist()


_KKT_GRID = [(0.0, 0.0), (0.05, 0.0), (0.05, 0.5), (0.05, 1.0)]


def _kkt_sql(source: str, scale: float = 1.0) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT CAST({reg * scale} AS DOUBLE) AS reg, CAST({a} AS DOUBLE) AS alpha, count(*) AS n, CAST(0 AS DOUBLE) AS violation, "
        f"CAST(0 AS DOUBLE) AS intercept_violation FROM {source}" for reg, a in _KKT_GRID)


@query("enet_kkt", _kkt_sql("lineitem", 10000.0))
def enet_kkt(spark, d):
    """Elastic nets with six features satisfy their optimality conditions."""
    li = table(spark, d, "lineitem")
    stages = fe.feature_stages(["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount", "l_tax"], handle_invalid="error")
    t = li.withColumn("label", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    with _assembled(t, ["label", "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"], stages) as data:
        return mo.small(_kkt_rows(spark, [
            ((reg * 10000.0, a), op.linear_kkt(data, mo.fit_linear(data, reg=reg * 10000.0, enet=a, max_iter=1000, tol=1e-12)))
            for reg, a in _KKT_GRID]))


@query("logistic_kkt", _kkt_sql("lineitem"))
def logistic_kkt(spark, d):
    """logistic elastic nets, with and without penalties, satisfy theirs."""
    li = table(spark, d, "lineitem")
    stages = fe.feature_stages(["l_returnflag"], ["l_extendedprice", "l_discount", "l_tax"], handle_invalid="error")
    t = li.withColumn("label", (F.col("l_quantity") + 40 * F.col("l_tax") + 10 * (F.col("l_returnflag") == "R").cast("int") >= 28)
                      .cast("double"))
    with _assembled(t, ["label", "l_returnflag", "l_extendedprice", "l_discount", "l_tax"], stages) as data:
        return mo.small(_kkt_rows(spark, [
            ((reg, a), op.logistic_kkt(data, mo.fit_logistic(data, reg=reg, enet=a, max_iter=1000, tol=1e-12)))
            for reg, a in _KKT_GRID]))


@query("kmeans_fixed_point", """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS misplaced, CAST(0 AS DOUBLE) AS max_shift FROM embeddings
""")
def kmeans_fixed_point(spark, d):
    """F8: k-means on real vectors ends at a fixed point of its own steps."""
    with mo.prepared(_embeddings(spark, d), ["features"]) as emb:
        model = mo.fit_kmeans(emb, k=3, seed=1, max_iter=500, tol=0.0)
        return mo.small(op.kmeans_fixed_point(emb, model).select("n", "misplaced", _r("max_shift").alias("max_shift")))


@query("category_index_joined", """
WITH m AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS i FROM part GROUP BY p_brand)
SELECT p_partkey, CAST(i AS DOUBLE) AS p_brand_idx FROM part JOIN m USING (p_brand)
""")
def category_index_joined(spark, d):
    """The indexer's index by a join with the category map."""
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    return fe.index_by_map(p, "p_brand", fe.category_map(p, "p_brand")).select("p_partkey", "p_brand_idx")


@query("category_index_wide", """
WITH m AS (SELECT k, row_number() OVER (ORDER BY count(*) DESC, k) - 1 AS i
           FROM (SELECT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem) GROUP BY k)
SELECT o_orderkey, CAST(coalesce(i, (SELECT count(*) FROM m)) AS DOUBLE) AS o_orderkey_idx
FROM orders LEFT JOIN m ON CAST(o_orderkey AS VARCHAR) = k
""")
def category_index_wide(spark, d):
    """As many categories as keys, none of them collected; keys that the
    map does not know get the index after the last."""
    cmap = fe.category_map(table(spark, d, "lineitem"), "l_orderkey")
    return fe.index_by_map(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", cmap, handle_invalid="keep")


@query("one_hot_slots", """
WITH b AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS i FROM part GROUP BY 1),
     t AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS i FROM part GROUP BY 1),
     n AS (SELECT (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM t) AS nt)
SELECT p_partkey, CAST(0 AS BIGINT) AS slot, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size <> 0
UNION ALL SELECT p_partkey, 1 + i, 1.0 FROM part JOIN b USING (p_brand), n WHERE i < nb - 1
UNION ALL SELECT p_partkey, nb + i, 1.0 FROM part JOIN t USING (p_type), n WHERE i < nt - 1
""")
def one_hot_slots(spark, d):
    """E3 + E4: sparse one-hot slots of joined indices, a row per slot in use."""
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_brand", "p_type")
    maps = {c: fe.category_map(p, c) for c in ("p_brand", "p_type")}
    for c, m in maps.items():
        p = fe.index_by_map(p, c, m)
    s = fe.sparse_slots(p, [(f"{c}_idx", m) for c, m in maps.items()], ["p_size"])
    return s.select("p_partkey", F.inline("slots"))


@query("tree_rule_texts", """
WITH t AS (SELECT CASE WHEN l_quantity >= 20 THEN 1 ELSE 0 END AS x, CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS y FROM lineitem)
SELECT CAST(x AS INTEGER) AS leaf, CASE WHEN x = 0 THEN 'x <= 0.5' ELSE 'x > 0.5' END AS rule,
       CAST(CASE WHEN avg(y) > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, count(*) AS n
FROM t GROUP BY x
""")
def tree_rule_texts(spark, d):
    """A tree's leaves as readable rules with feature names."""
    data = _stump_data(spark, d)
    return ru.leaf_rules(mo.fit_tree(data, max_depth=3), data).select("leaf", "rule", "prediction", "n")


@query("tree_rules_route", """
SELECT kind, count(*) AS n, count(*) AS same_leaf FROM lineitem, (SELECT unnest(['classifier', 'regressor']) AS kind) GROUP BY kind
""")
def tree_rules_route(spark, d):
    """The rules, run on raw columns with category names, send
    every row to the leaf that the model sends it to."""
    raw = _tree_data(spark, d).select("label", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "brand_group")
    with mo.prepared(raw, None, SPREAD) as base:
        stages = [fe.indexer(["brand_group"], handle_invalid="keep"),
                  VectorAssembler(inputCols=["brand_group_idx", "l_discount", "l_tax", "l_extendedprice"], outputCol="features")]
        data = Pipeline(stages=stages).fit(base).transform(base)
        out = None
        for kind, model in (("classifier", mo.fit_tree(data, max_depth=4)),
                            ("regressor", mo.fit_tree_regressor(data, label="l_quantity", max_depth=4))):
            leaf = ru.leaf_column(model, data)
            row = model.setLeafCol("_leaf").transform(data).agg(
                F.count(F.lit(1)).alias("n"), F.count_if(leaf == F.col("_leaf")).alias("same_leaf")).withColumn("kind", F.lit(kind))
            out = row if out is None else out.unionByName(row)
        return mo.small(out.select("kind", "n", "same_leaf"))


@query("job_tree_rules")
def job_tree_rules(spark, d):
    """The rules of the job's tree, with category values, beside the
    holdout-free counts and means of the rows they cover."""
    raw = _tree_data(spark, d).select("label", "l_discount", "l_tax", "l_extendedprice", "brand_group")
    with mo.prepared(raw, None, SPREAD) as base:
        stages = [fe.indexer(["brand_group"], handle_invalid="keep"),
                  VectorAssembler(inputCols=["brand_group_idx", "l_discount", "l_tax", "l_extendedprice"], outputCol="features")]
        data = Pipeline(stages=stages).fit(base).transform(base)
        model = mo.fit_tree(data, max_depth=3)
        found = ru.leaf_summary(base, ru.leaf_column(model, data))
        return mo.small(ru.leaf_rules(model, data).join(found.withColumnRenamed("n", "rows"), "leaf")
                        .select("leaf", "rule", "prediction", "n", "rows", _r("mean").alias("mean")))


@query("recs_both_sides", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
     s AS (SELECT u.vec_id AS "user", i.vec_id AS item, list_inner_product(u.x, i.x) AS score FROM e u, e i),
     k AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM s),
     h AS (SELECT user_id AS "user", event_id % 500 AS item, sum(value) AS score FROM events GROUP BY 1, 2)
SELECT k."user", k.item, 'recommended' AS source, CAST(rank AS INTEGER) AS rank, round(k.score, {R}) AS score, h.item IS NOT NULL AS seen
FROM k LEFT JOIN h ON k."user" = h."user" AND k.item = h.item WHERE rank <= 5
UNION ALL SELECT "user", item, 'history', NULL, round(score, {R}), true FROM h
""")
def recs_both_sides(spark, d):
    """Recommendations from factors, marked where the user's history has
    them, beside that history (made of the events: user, item, value)."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    hist = table(spark, d, "events").select(F.col("user_id").alias("user"), (F.col("event_id") % 500).alias("item"), "value") \
        .groupBy("user", "item").agg(F.sum("value").alias("value"))
    out = rc.with_history(rc.top_k_from_factors(e, e, 5), hist, "user", "item", "value")
    return out.select("user", "item", "source", "rank", _r("score").alias("score"), "seen")


@query("many_models_metrics", "\nUNION ALL\n".join(
    f"SELECT {i} AS model, count(*) AS n, round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), {R}) AS r2, "
    f"round(sqrt(avg((y - p) * (y - p))), {R}) AS rmse, round(avg(abs(y - p)), {R}) AS mae "
    f"FROM (SELECT l_extendedprice AS y, l_quantity * {700 + 100 * i}.0 + {i} * l_tax AS p FROM lineitem)" for i in range(9)))
def many_models_metrics(spark, d):
    """Nine candidates evaluated in one scan."""
    li = table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("label"), F.array(
        *[F.col("l_quantity") * (700.0 + 100 * i) + F.lit(i) * F.col("l_tax") for i in range(9)]).alias("scores"))
    m = me.many_regression_metrics(li, "scores", 9)
    return m.select("model", "n", *[_r(c).alias(c) for c in ("r2", "rmse", "mae")])


@query("many_models_auc", f"""
WITH t AS (SELECT l_quantity AS s, CASE WHEN l_extendedprice > 40000 THEN 1 ELSE 0 END AS y FROM lineitem),
     c AS (SELECT s, count(*) FILTER (y = 1)::DOUBLE AS p, count(*) FILTER (y = 0)::DOUBLE AS q FROM t GROUP BY s),
     u AS (SELECT *, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under FROM c),
     a AS (SELECT sum(p * (under + q / 2)) / (sum(p) * sum(q)) AS auc, sum(p * q) / 2 / (sum(p) * sum(q)) AS bound, CAST(sum(p + q) AS BIGINT) AS n FROM u)
SELECT 0 AS model, n, round(auc, {R}) AS auc, round(bound, {R}) AS bound FROM a
UNION ALL SELECT 1, n, round(1 - auc, {R}), round(bound, {R}) FROM a
UNION ALL SELECT 2, n, 0.5, 0.5 FROM a
""")
def many_models_auc(spark, d):
    """Areas under ROC of three scores in one scan, with error bounds."""
    q = F.col("l_quantity") / 64
    li = table(spark, d, "lineitem").select((F.col("l_extendedprice") > 40000).cast("int").alias("label"),
                                            F.array(q, 1 - q, F.lit(0.3)).alias("scores"))
    return me.many_auc(li, "scores").select("model", "n", _r("auc").alias("auc"), _r("bound").alias("bound"))


@query("stream_text_lines", """
SELECT 'count' AS kind, date_trunc('day', ts) AS window_start, upper(event_type) AS name, count(*) AS n
FROM events WHERE event_id % 5 IN (0, 4) GROUP BY 2, 3
UNION ALL
SELECT 'bad', NULL, CASE event_id % 5 WHEN 1 THEN 'no separator' WHEN 2 THEN 'bad level' ELSE 'bad date' END, count(*)
FROM events WHERE event_id % 5 IN (1, 2, 3) GROUP BY 3
""")
def stream_text_lines(spark, d):
    """L1 + L2: text files of good and spoilt lines below the shared folder, read
    as a stream in several micro-batches into both outputs."""
    from ..session import scratch_path
    ensure_utc(spark)
    base = scratch_path(spark, "lines")
    _spoilt_lines(spark, d).repartition(4, "event_id").select("line").write.text(f"{base}/in")
    ls.start_line_job(spark, f"{base}/in", f"{base}/out", f"{base}/ck", watermark="36500 days", files_per_batch=2).awaitTermination()
    counts = ls.line_counts(spark, f"{base}/out").select(F.lit("count").alias("kind"), "window_start", F.col("level").alias("name"), "n")
    bad = ls.bad_lines(spark, f"{base}/out").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(bad.select(F.lit("bad").alias("kind"), F.lit(None).cast("timestamp_ntz").alias("window_start"),
                                         F.col("reason").alias("name"), "n"))


@query("csv_linear_ols", ORACLE_SQL["linear_ols"])
def csv_linear_ols(spark, d):
    """A1 + A2 + F1: a whole job on several CSV files instead of the table."""
    from ..session import scratch_path
    from ..sources import using
    li = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    path = scratch_path(spark, "csv")
    li.repartition(4, "l_orderkey").write.option("header", True).csv(path)
    with using({"lineitem": (f"{path}/part-*.csv", "l_orderkey long, l_quantity double, l_extendedprice double")}):
        return linear_ols(spark, d)
