"""Corpus preparation: quality filter, near-duplicate removal, repeated-passage
removal, benchmark decontamination, tokenisation.  Each stage takes
(spark, docs, sf_dir), works on all its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabml.llm import bpe, decontaminate, jaccard_join, linear, quality, suffix_dedup
from tabml.llm.common import stored
from tabml.sources import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.  It learns from the
    labelled rows whose crc32(doc_id) modulo 5 is not 0, as its own query does."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), linear.remainder("doc_id", 5) != 0)
    return quality.score(docs, model, docs.columns).filter("predicted = 1").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return jaccard_join.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that start earlier elsewhere."""
    return suffix_dedup.remove_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no run of ten words of a benchmark item."""
    return decontaminate.remove_contaminated_rows(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE token ids of every remaining document."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN, keep=["doc_id"])


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE encoding and decoding", encode),
]

#: The stages hold fitted models and token merges; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
