"""Registered queries of the subpackage: each applies one operator with its
production parameters to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.sources import table

from . import (alignment, bpe, chaining, decontaminate, fingerprint, hard_negatives, jaccard_join, language, linear, partition_index,
               quality, suffix_dedup, toxicity, warc)


def op1_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN, keep=["doc_id"], ids=False)


def op4_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _held_out(divisor: int, remainder: int):
    """Rows never learnt from; rows without an id are among them."""
    return F.coalesce(linear.remainder("doc_id", divisor) == remainder, F.lit(True))


def op5_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~_held_out(3, 1))
    return toxicity.score(docs, weights, ["doc_id"]) \
        .select("doc_id", _held_out(3, 1).alias("held_out"), "score", "predicted")


def op6_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~_held_out(5, 0))
    return quality.score(docs, model, ["doc_id"]) \
        .select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op7_language_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, ~_held_out(5, 0))
    return language.predict(docs, model, ["doc_id"]) \
        .select("doc_id", _held_out(5, 0).alias("held_out"), "lang_pred", "score")


def op8_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op9_bucket_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, payload=False) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_merge_asof_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"),
                           public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_hilbert_zone_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings") \
        .withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_collinear_chaining": op1_collinear_chaining,
    "op2_multiset_hash": op2_multiset_hash,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_chosen_path_join": op4_chosen_path_join,
    "op5_ftrl_toxicity": op5_ftrl_toxicity,
    "op6_nbsvm_quality": op6_nbsvm_quality,
    "op7_language_hierarchy": op7_language_hierarchy,
    "op8_positional_index": op8_positional_index,
    "op9_bucket_pointer": op9_bucket_pointer,
    "op10_warc_dictionary": op10_warc_dictionary,
    "op11_merge_asof_alignment": op11_merge_asof_alignment,
    "op12_learned_partitions": op12_learned_partitions,
    "op13_hilbert_zone_negatives": op13_hilbert_zone_negatives,
}

ORACLE_SQL = {
    "op13_hilbert_zone_negatives": """
WITH e AS (
    SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND NOT coalesce(list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))), false)),
s AS (
    SELECT a.uid, a.vec_id AS anchor_id, b.uid AS other, b.vec_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM e a JOIN e b ON a.uid <> b.uid WHERE a.vec_id % 50 = 0),
p AS (
    SELECT uid, anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id, other) AS nth
    FROM s WHERE same QUALIFY nth <= 5),
n AS (
    SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.uid, nth ORDER BY s.score DESC, s.vec_id, s.other) AS INTEGER) AS rank
    FROM p JOIN s ON p.uid = s.uid AND NOT s.same
     AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op10_warc_dictionary": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
heads AS (SELECT html, max(page_id) AS head FROM p WHERE size >= 1000 GROUP BY html)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < head THEN head END AS refers_to
FROM p LEFT JOIN heads ON p.html = heads.html""",
    "op8_positional_index": r"""
WITH toks AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
btoks AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
runs AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS run
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM btoks WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM runs),
wins AS (
    SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS run
    FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i FROM toks, lens)),
found AS (SELECT w.doc_id, w.i, w.k, r.item_id FROM wins w JOIN runs r ON w.run = r.run AND w.k = r.k),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM toks t LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
