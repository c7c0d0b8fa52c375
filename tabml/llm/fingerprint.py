"""Document fingerprints: a homomorphic multiset hash (operator 2).

A paragraph (a non-empty line) is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo 2**16
or 2**32.  So it does not depend on the order of paragraphs, and inserting
or deleting one adds or subtracts its vector, without the rest of the text.

A vector has two parts.  ``EXACT`` lanes of 16 bits come from SHAKE-128 of the paragraph
and are uniform: two documents have equal sums only if they have the same
paragraphs (not meant against an adversary, who could search for sums).
``LIKE`` lanes of 32 bits are a signed count sketch of the paragraph's three-word
shingles (all its words if fewer), whose sums give the cosine of two documents'
shingle counts, to about 1/sqrt(LIKE).  They hold counts up to 2**31 - 1, more
than any text has shingles.

Null texts are empty; the empty document's fingerprint is all zeros.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, blank_table, grams, slices, words

EXACT, LIKE, SHINGLE = 128, 256, 3
WIDTH = EXACT + LIKE
#: Buckets of consecutive ids for each shuffle partition.
BUCKETS = 8
_FIRST = -(1 << 63)


def fingerprints(texts: list[bytes], powers: Powers, table: np.ndarray) -> np.ndarray:
    """One row of ``WIDTH`` lanes for each text."""
    out = np.zeros((len(texts), WIDTH), np.uint32)
    lines = [[x for x in t.split(b"\n") if x] for t in texts]
    counts = np.array([len(x) for x in lines], np.int64)
    digests = [hashlib.shake_128(x).digest(EXACT * 2) for doc in lines for x in doc]
    if digests:
        lanes = np.frombuffer(b"".join(digests), "<u2").reshape(-1, EXACT)
        some = np.flatnonzero(counts)
        out[some, :EXACT] = np.add.reduceat(lanes, (np.cumsum(counts) - counts)[some], axis=0, dtype=np.uint16)
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0, *map(len, texts)])
    cuts = np.union1d(off, np.flatnonzero(data == 10) + 1)      # paragraphs
    h, para, _, _ = words(data, cuts, table, powers)
    g, para = grams(h, para, SHINGLE)
    doc = np.searchsorted(off, cuts[para], "right") - 1
    sign = 1.0 - 2.0 * ((g >> np.uint64(8)) & np.uint64(1)).astype(np.float64)
    sums = np.bincount(doc * LIKE + (g & np.uint64(LIKE - 1)).astype(np.int64), sign, len(texts) * LIKE)
    out[:, EXACT:] = (sums.astype(np.int64).reshape(-1, LIKE) & 0xFFFFFFFF).astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints, row by row: 1 if they are equal,
    otherwise the cosine of their shingle sketches, or 0 if that is negative."""
    x, y = (v[:, EXACT:].astype(np.int32).astype(np.float64) for v in (a, b))
    norm = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cos = (x * y).sum(axis=1) / np.where(norm > 0, norm, 1.0)
    return np.where((a == b).all(axis=1), 1.0, np.clip(cos, 0.0, 0.999999))


def to_text(lanes: np.ndarray) -> str:
    """A fingerprint as lower-case hexadecimal digits of its lanes' bytes,
    little-endian: two for each exact lane, four for each other."""
    return (lanes[:EXACT].astype("<u2").tobytes() + lanes[EXACT:].astype("<u4").tobytes()).hex()


def from_text(text: str) -> np.ndarray:
    raw = bytes.fromhex(text)
    return np.concatenate([np.frombuffer(raw, "<u2", EXACT).astype(np.uint32), np.frombuffer(raw, "<u4", LIKE, 2 * EXACT)])


def plus(a: str, b: str) -> str:
    """Fingerprint of both documents' paragraphs together (``to_text`` takes each lane's modulus)."""
    return to_text(from_text(a) + from_text(b))


def minus(a: str, b: str) -> str:
    """Fingerprint after deleting b's paragraphs from a."""
    return to_text(from_text(a) - from_text(b))


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of the whole text of every row.  Rows are
    independent: null ids and repeated rows are kept as they are.  A column
    named ``out``, or ``__text``, is refused."""
    if {out, "__text"} & set(docs.columns):
        raise ValueError(f"columns {sorted({out, '__text'} & set(docs.columns))} exist already")
    src = docs.withColumn("__text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    names = [*docs.columns, out]

    def run(batches):
        powers, table = Powers(), blank_table()
        for whole in batches:
            for batch, data, off in slices(whole, "__text"):
                raw = [data[a:b].tobytes() for a, b in zip(off[:-1], off[1:])]
                fp = [to_text(x) for x in fingerprints(raw, powers, table)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp, pa.string())], names=names)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{out}` string"])
    return src.mapInArrow(run, schema)


def updated(prints: DataFrame, edits: DataFrame, key: str = "doc_id", out: str = "fingerprint") -> DataFrame:
    """Fingerprints after insertions and deletions, without the documents'
    texts.  ``edits``: ``key``, ``paragraph`` (one or more lines; null: none)
    and ``inserted`` (true, or false for a deletion).  Keys of ``edits`` that
    ``prints`` lacks start from the empty document; null keys are one key.
    Lane sums are combined before they are shuffled."""
    delta = fingerprint(edits.select(key, "inserted", F.col("paragraph").alias("text")))
    parts = prints.select(key, F.lit(True).alias("inserted"), F.col(out).alias("fingerprint")) \
        .unionByName(delta.select(key, "inserted", "fingerprint"))
    # a lane is two or four bytes in little-endian order
    def lane(i):
        long = i >= EXACT
        at = F.when(long, EXACT * 4 + (i - EXACT) * 8).otherwise(i * 4) + 1
        byte = [F.substring("fingerprint", at + 2 * k, F.lit(2)) for k in range(4)]
        return F.conv(F.when(long, F.concat(*byte[::-1])).otherwise(F.concat(byte[1], byte[0])), 16, 10).cast("long")

    signed = F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)),
                         lambda i: F.when(F.col("inserted"), lane(i)).otherwise(-lane(i)))
    sums = parts.select(key, F.posexplode(signed).alias("i", "v")).groupBy(key, "i") \
        .agg(F.pmod(F.sum("v"), F.when(F.col("i") < EXACT, F.lit(1 << 16)).otherwise(F.lit(1 << 32))).alias("v"))
    word = F.lpad(F.lower(F.hex("v")), 8, "0")
    byte = [F.substring(word, 7 - 2 * k, 2) for k in range(4)]
    return sums.withColumn("w", F.when(F.col("i") < EXACT, F.concat(byte[0], byte[1])).otherwise(F.concat(*byte))).groupBy(key) \
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]), "")
             .alias(out))


def _cuts(keys: DataFrame, buckets: int) -> list[int]:
    """Ids that part the table into about equal buckets (at most ``buckets``)."""
    got = keys.agg(F.percentile_approx("key", [i / buckets for i in range(1, buckets)], 10_000).alias("c")).first().c
    return sorted(set(got or []))


def with_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every document and its edited text: the last floor(n/2) code
    points replaced by the first as many (or all) of the next document's, in
    ascending id (after the last: the first).  Null ids come first; rows of one
    id are ordered by text.  One result row per input row: ``doc_id``,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``.

    Each text is shuffled once, into buckets of consecutive ids; a bucket also
    gets a copy of the first document of the next one.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                      F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_FIRST)).alias("key"),
                      F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    cuts = spark.sparkContext.broadcast(np.array(_cuts(src.select("key"), parts * BUCKETS), np.int64))

    @F.pandas_udf("int")
    def bucket(key):
        import pandas as pd
        return pd.Series(np.searchsorted(cuts.value, key.to_numpy(), "left").astype(np.int32))

    src = src.withColumn("bucket", bucket("key"))
    heads = sorted((r.bucket, r.key) for r in src.groupBy("bucket").agg(F.min("key").alias("key")).collect())
    before = {key: heads[i - 1][0] for i, (_, key) in enumerate(heads)}     # one entry a bucket
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
             "near_edited double, near_next double"
    if not heads:
        return spark.createDataFrame([], schema)
    lead = src.join(F.broadcast(spark.createDataFrame(list(before.items()), "key long, halo int")), "key") \
        .groupBy("key", "halo").agg(F.min("text").alias("text"))
    rows = src.select("bucket", "key", F.lit(0).alias("halo"), "doc_id", "text").unionByName(
        lead.select(F.col("halo").alias("bucket"), "key", F.lit(1).alias("halo"),
                    F.lit(None).cast("long").alias("doc_id"), "text"))
    rows = rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "halo", "key", "text") \
        .select("halo", "doc_id", "text")

    def run(batches):
        powers, table = Powers(), blank_table()
        last = None                                     # (halo, doc_id, text, fingerprint)
        for whole in batches:
            for batch, data, off in slices(whole, "text"):
                halo, ids, texts = (c.to_pylist() for c in batch.columns)
                own = fingerprints([data[a:b].tobytes() for a, b in zip(off[:-1], off[1:])], powers, table)
                if last is not None:
                    halo, ids, texts = [last[0], *halo], [last[1], *ids], [last[2], *texts]
                    own = np.concatenate([last[3], own])
                last = halo[-1], ids[-1], texts[-1], own[-1:]
                at = [i for i in range(len(texts) - 1) if not halo[i]]
                edited = [(t[:len(t) - len(t) // 2] + texts[i + 1][:len(t) // 2]).encode()
                          for i, t in ((i, texts[i]) for i in at)]
                other = fingerprints(edited, powers, table)
                after = [i + 1 for i in at]
                here, following = own[at], own[after]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in at], pa.int64()), pa.array([len(texts[i]) for i in at], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in edited], pa.string()),
                     pa.array([to_text(x) for x in here], pa.string()),
                     pa.array([to_text(x) for x in other], pa.string()),
                     pa.array(likeness(here, other)), pa.array(likeness(here, following))],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                           "near_edited", "near_next"])

    return rows.mapInArrow(run, schema)
