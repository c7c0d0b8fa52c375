import duckdb
from pyspark.sql import functions as F

from tabml.functions.columns import hash_bucket
from tabml.operators import split as sp
from conftest import SF01


def test_hash_number_matches_duckdb(spark):
    got = spark.range(1).select(hash_bucket(F.lit(42), 2 ** 40).alias("h")).head()["h"]
    want = duckdb.connect().execute("SELECT ('0x' || substr(md5('42'), 1, 8))::BIGINT").fetchone()[0]
    assert got == want == 2714814184


def test_hash_split_disjoint_complete_reproducible(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    a, b, c = sp.hash_split(o, "o_orderkey", [0.7, 0.2, 0.1])
    ka = {r[0] for r in a.collect()}
    kb = {r[0] for r in b.collect()}
    kc = {r[0] for r in c.collect()}
    assert not (ka & kb or ka & kc or kb & kc)
    assert len(ka | kb | kc) == o.count()
    # same key -> same part under another partitioning
    a2, _, _ = sp.hash_split(o.repartition(3), "o_orderkey", [0.7, 0.2, 0.1])
    assert {r[0] for r in a2.collect()} == ka
    assert 0.65 < len(ka) / o.count() < 0.75


def test_random_split_disjoint_complete(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey")
    a, b = sp.random_split(o, [0.8, 0.2], seed=7)
    ka, kb = {r[0] for r in a.collect()}, {r[0] for r in b.collect()}
    assert not ka & kb and len(ka | kb) == o.count()


def test_multi_column_key_splits_a_heavy_group(spark):
    # one order key holds every row: a split on it puts all rows on one side,
    # a split on (order, line) spreads them by the weights
    df = spark.range(0, 4000).select(F.lit(7).alias("k"), F.col("id").alias("line"))
    a, b = sp.hash_split(df, "k", [0.8, 0.2])
    assert {a.count(), b.count()} == {0, 4000}
    a2, b2 = sp.hash_split(df, ["k", "line"], [0.8, 0.2])
    assert 0.75 < a2.count() / 4000 < 0.85 and a2.count() + b2.count() == 4000
    tagged = sp.with_split(df, ["k", "line"], [0.8, 0.2])
    assert tagged.filter(F.col("part") == "train").count() == a2.count()
