"""Connected components of a table of links, by alternating stars.

Each round replaces links so that every component shrinks towards a star
around its smallest member; links and members never leave the executors, and
the number of rounds grows with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``links``: ``a``, ``b`` (long).  Returns ``node`` and ``root`` (the
    component's smallest node) for every node but the roots themselves."""
    now = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "links")
    before = None
    while True:
        # large star: a node's larger neighbours move to its smallest neighbour
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        after = stored(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(now)
        now = after
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
