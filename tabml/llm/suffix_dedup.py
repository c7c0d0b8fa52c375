"""Removal of repeated substrings by bucket-pointer refinement (operator 9).

Every byte covered by a ``length``-byte string that also starts earlier (in an
earlier document, or earlier in the same one) is removed.  Suffixes are sorted
into buckets only as deep as ``length``:

1. *Initial q-gram buckets.*  The bucket of a position is the identifier of
   its 32-byte gram, itself refined from 1 byte by five doublings: the
   identifier of 2q bytes is that of the pair (bucket of p, bucket of p + q).
   Each window of ``length`` bytes is represented by its anchor, the position
   of the smallest identifier in it (the leftmost, if tied), so equal windows
   have equal anchors at equal offsets, and about one position in 35 is
   shuffled.  Buckets of a single position cannot hold a repeat and are left.
2. *Refinement.*  In every remaining bucket, windows are sorted on the bucket
   identifiers of later offsets: (p, p + 32) gives 64 bytes, and that of
   (p, p + length - 64), reused once more, the whole window.  All but the
   first window of a final bucket are repeats.

Exact copies of a whole document are found by their digest first and leave the
buckets.  A bucket of more than ``HOT`` anchors is refined on Spark before a
task takes it: of members with equal bytes only the first stays, as all windows
of the others are repeats; if more than ``HOT`` are left, the bucket is split in
two by the offset of the anchor in the window, and each half goes to buckets of
the longer string that all its windows share, until these are small enough.  So
no task holds an unbounded bucket, and no row is made for a window.  Identifiers are 64-bit hashes; two different
windows count as equal only if they agree in both the anchor's and their own.

Documents are rows in ascending id (null first); rows of one id are ordered by
text, so of equal rows all but the first are copies.  Null texts are empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, run_starts, slices, stored, text_buffers, whole_groups

LENGTH, GRAM = 100, 32
#: Anchors of one bucket that a task refines by itself.
HOT = 50_000
#: A bucket with more than this part of a join's rows is dealt to several tasks.
PIECES = 1000
_STEP = 65_000                          # windows whose anchors are packed with 16-bit places
_K = np.uint64(0x9E3779B97F4A7C15)


def _pairs(ids: np.ndarray, q: int) -> np.ndarray:
    """Identifiers of 2q bytes from those of q bytes."""
    return mix(ids[:-q] * _K + ids[q:])


def grams(data: np.ndarray) -> np.ndarray:
    """Identifier of the 32-byte gram at every position."""
    ids = mix(data.astype(np.uint64) + np.uint64(1))
    q = 1
    while q < GRAM:
        ids = _pairs(ids, q)
        q *= 2
    return ids


def anchors(ids: np.ndarray, windows: int, length: int) -> np.ndarray:
    """Place of the smallest (then leftmost) gram of each window."""
    span = length - GRAM + 1                         # grams in a window
    out = np.empty(windows, np.int64)
    low = np.uint64(0xFFFF)
    for lo in range(0, windows, _STEP):
        hi = min(windows, lo + _STEP)
        part = ids[lo:hi + span - 1]
        m = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        q = 1
        while q * 2 <= span:                          # minimum over 1, 2, 4, ... places
            m = np.minimum(m[:-q], m[q:])
            q *= 2
        if span > q:
            m = np.minimum(m[:hi - lo], m[span - q:span - q + hi - lo])
        out[lo:hi] = (m[:hi - lo] & low).astype(np.int64) + lo
    return out


def windows_of(data: np.ndarray, off: np.ndarray, length: int):
    """Anchors of all values of a buffer: (gram identifiers, anchor place,
    first window, number of windows), windows within one value only."""
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none
    ids = grams(data)
    a = anchors(ids, n, length)
    end = np.repeat(off[1:], np.diff(off))[:n]
    p = np.flatnonzero(end - np.arange(n) >= length)
    a = a[p]
    start = run_starts(a)
    return ids, a[start], p[start], np.diff(np.r_[start, len(p)])


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def refine(bucket: np.ndarray, context: np.ndarray, off: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Which windows are repeats.  Members are in order; member i has bucket
    ``bucket[i]`` and ``count[i]`` windows at the start of its context."""
    ids = grams(context)
    p = _ranges(off[:-1], count)
    final = mix(window_ids(ids, p, length) * _K + np.repeat(bucket, count))
    order = np.argsort(final, kind="stable")
    again = np.zeros(len(p), bool)
    again[order[1:]] = final[order[1:]] == final[order[:-1]]
    return again


def window_ids(ids: np.ndarray, p: np.ndarray, length: int) -> np.ndarray:
    """Identifiers of the windows at ``p`` from their 32-byte grams."""
    if length < 2 * GRAM:
        return mix(ids[p] * _K + ids[p + length - GRAM])
    wide = _pairs(ids, GRAM)
    return mix(wide[p] * _K + wide[p + length - 2 * GRAM])


def with_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``__uid``, distinct and ascending in document order: the
    id itself if it is distinct and never null, else a number after sorting."""
    key = F.col(f"`{doc_id}`").cast("long")
    n, distinct = docs.select(F.count(F.lit(1)), F.count_distinct(key)).first()
    if n == distinct:
        return docs.withColumn("__uid", key)
    order = [key.asc_nulls_first(), F.col(f"`{text}`").cast("string").asc_nulls_first()]
    ranged = docs.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order) \
        .sortWithinPartitions(*order)
    return stored(ranged.withColumn("__uid", F.monotonically_increasing_id()), "ordered")


def _anchor_rows(src: DataFrame, length: int) -> DataFrame:
    """(bucket, uid, place) of every anchor."""
    def run(batches):
        for whole in batches:
            for batch, data, off in slices(whole, "text"):
                ids, a, _, _ = windows_of(data, off, length)
                doc = np.searchsorted(off, a, "right") - 1
                uid = batch.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a].view(np.int64)), pa.array(uid[doc]), pa.array((a - off[doc]).astype(np.int32))],
                    names=["bucket", "uid", "place"])

    return src.mapInArrow(run, "bucket long, uid long, place int")


def _several(rows: DataFrame, least: int = 2) -> DataFrame:
    """Buckets with at least two rows, and their numbers of rows."""
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _limit(side: DataFrame) -> int:
    """Rows from which a bucket is dealt to several tasks: a ``PIECES``th of
    all that ``side`` (one row a bucket, with ``many`` rows) counts."""
    return max(1, (side.agg(F.sum("many")).first()[0] or 0) // PIECES)


def _marked(rows: DataFrame, side: DataFrame, limit: int) -> DataFrame:
    """``rows`` with ``many`` where their bucket is over the limit, else null.
    Fewer than ``PIECES`` buckets can be, so they are broadcast."""
    return rows.join(F.broadcast(side.filter(F.col("many") > limit).select("bucket", "many")), "bucket", "left")


def _meet(rows: DataFrame, side: DataFrame, limit: int, place: str = "place") -> DataFrame:
    """``rows`` joined with ``side`` (one row a bucket) by bucket.  Both have
    ``many``; a bucket over the limit is dealt by row to as many pieces as it
    has limits, and its one row of ``side`` goes to each."""
    pieces = F.coalesce(F.ceil(F.col("many") / limit), F.lit(1)).cast("long")
    dealt = rows.withColumn("piece", F.pmod(F.xxhash64("uid", place), pieces)).drop("many")
    each = side.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    return dealt.join(each, ["bucket", "piece"]).drop("piece")


_MEMBER = ["bucket", "uid", "first", "n", "context"]


def _contexts(src: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """The anchors at ``places``: bucket, uid, first window, number of windows,
    the bytes they span, the anchor's place ``at`` in them, and ``hot``."""
    def cut(batches):
        for whole in batches:
            for batch, data, off in slices(whole, "text"):
                ids, a, first, count = windows_of(data, off, length)
                doc = np.searchsorted(off, a, "right") - 1
                lists, n = batch.column(2), batch.num_rows
                want = np.sort(np.concatenate([np.zeros(0, np.int64)] + [
                    (lists[i].values.to_numpy(zero_copy_only=False).astype(np.int64) + off[i]) * 2
                    + batch.column(3)[i].values.to_numpy(zero_copy_only=False) for i in range(n)]))
                at = np.searchsorted(want, a * 2)
                at[at == len(want)] = 0
                k = np.flatnonzero(want[at] >> 1 == a) if len(want) else np.zeros(0, np.int64)
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a[k]].view(np.int64)), pa.array(batch.column(0).to_numpy()[doc[k]]),
                     pa.array((first[k] - off[doc[k]]).astype(np.int32)), pa.array(count[k].astype(np.int32)),
                     pa.array([raw[s:s + c + length - 1] for s, c in zip(first[k].tolist(), count[k].tolist())], pa.binary()),
                     pa.array((a[k] - first[k]).astype(np.int32)), pa.array(want[at[k]] & 1 == 1)], names=[*_MEMBER, "at", "hot"])

    return src.join(places, "uid").select("uid", "text", "place", "hot") \
        .mapInArrow(cut, "bucket long, uid long, first int, n int, context binary, at int, hot boolean")


def _halves(rows: DataFrame, length: int) -> DataFrame:
    """Members of buckets split in two: windows that start ``low`` to ``high``
    bytes before their anchor share the bytes from ``low`` before it to
    ``length - high`` after it, which are their new bucket."""
    def run(batches):
        for batch in batches:
            out = []
            for bucket, uid, first, n, context, at, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                middle = (low + high) // 2
                for lo, hi in ((middle + 1, high), (low, middle)):
                    most, least = min(hi, at), max(lo, at - n + 1)
                    if least <= most:
                        skip = at - most
                        shared = context[at - lo:at - hi + length]
                        key = hashlib.blake2b(b"%d,%d,%d:" % (bucket, lo, hi) + shared, digest_size=8).digest()
                        out.append((int.from_bytes(key, "little", signed=True), uid, first + skip, most - least + 1,
                                    context[skip:skip + most - least + length], most, lo, hi))
            cols = list(zip(*out)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, batch.schema)], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _cooled(context: DataFrame, local: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """``local`` with the members of ``context``'s hot buckets in buckets of at
    most ``HOT``, and the spans (uid, start, end) of the members left out, which
    have the same bytes as an earlier one."""
    columns = [*_MEMBER, "at", "low", "high"]
    rows = context.filter("hot").withColumn("low", F.lit(0)).withColumn("high", F.lit(length - GRAM)).select(*columns)
    spans = []
    while True:
        equal = rows.withColumn("owner", F.col("bucket")).withColumn("bucket", F.xxhash64("bucket", "at", "context"))
        lead = stored(equal.groupBy("bucket").agg(F.min(F.struct("uid", "first")).alias("lead"), F.count(F.lit(1)).alias("many")), "leads")
        limit = _limit(lead)
        met = stored(_meet(_marked(equal, lead, limit), lead, limit, "first")
                     .withColumn("again", F.struct("uid", "first") != F.col("lead")).drop("lead", "many"), "members")
        spans.append(met.filter("again").select("uid", F.col("first").alias("start"), (F.col("first") + F.col("n") + length - 1).alias("end")))
        left = met.filter("not again").drop("bucket").withColumnRenamed("owner", "bucket").select(*columns)
        sizes = stored(_several(left).withColumnRenamed("n", "many"), "sizes")
        limit = _limit(sizes)
        left = _meet(_marked(left, sizes, limit), sizes, limit, "first")
        local = local.unionByName(left.filter(F.col("many") <= HOT).select(*_MEMBER))
        if sizes.filter(F.col("many") > HOT).isEmpty():
            return local, spans
        rows = stored(_halves(left.filter(F.col("many") > HOT).select(*columns), length), "halves")


def repeats(src: DataFrame, length: int = LENGTH) -> DataFrame:
    """``src``: ``uid`` (distinct, in document order) and ``text``.  Returns
    ``uid``, ``copy`` (the whole text is an earlier document's) and the byte
    spans ``starts``, ``ends`` of repeated windows, which may overlap; only
    documents that have any."""
    digests = src.filter(F.octet_length("text") >= length).select("uid", F.sha2("text", 256).alias("digest"))
    groups = digests.groupBy("digest").agg(F.min("uid").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = stored(digests.join(groups, "digest").filter("uid <> first").select("uid"), "copies")

    rows = _anchor_rows(src, length)
    buckets = stored(_several(rows).withColumnRenamed("n", "many"), "buckets")
    limit = _limit(buckets)
    shared = stored(_meet(_marked(rows, buckets, limit), buckets, limit).join(copies, "uid", "left_anti"), "anchors")
    left = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("many").alias("many")).filter("n > 1")
    kept = _meet(shared, left, limit).select("uid", "place", (F.col("n") > HOT).alias("hot"))
    places = stored(kept.groupBy("uid").agg(F.collect_list(F.struct("place", "hot")).alias("places"))
                    .select("uid", F.col("places.place").alias("place"), F.col("places.hot").alias("hot")), "places")

    parts = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    any_hot = not places.filter(F.exists("hot", lambda x: x)).isEmpty()
    context = _contexts(src, places, length)
    if any_hot:
        context = stored(context, "contexts")

    def judge(batches):
        """Repeated spans, bucket by bucket (rows sorted by bucket)."""
        for t in whole_groups(batches, "bucket"):
            yield from spans(t.combine_chunks())

    def spans(t):
        bucket = t.column("bucket").to_numpy().view(np.uint64)
        lo = 0
        data, off = text_buffers(t.column("context"))
        while lo < len(bucket):          # whole buckets, about a megabyte of context at a time
            hi = int(np.searchsorted(off, off[lo] + (1 << 20), "right")) - 1
            hi = max(hi, lo + 1)
            hi = int(np.searchsorted(bucket.view(np.int64), bucket.view(np.int64)[min(hi, len(bucket)) - 1], "right"))
            count = t.column("n").to_numpy()[lo:hi].astype(np.int64)
            first = t.column("first").to_numpy()[lo:hi].astype(np.int64)
            again = refine(bucket[lo:hi], data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], count, length)
            member = np.repeat(np.arange(hi - lo), count)
            p = _ranges(first, count)
            k = np.flatnonzero(again)
            if len(k):
                new = np.r_[True, (member[k[1:]] != member[k[:-1]]) | (p[k[1:]] != p[k[:-1]] + 1)]
                s = np.flatnonzero(new)
                e = np.r_[s[1:], len(k)] - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t.column("uid").to_numpy()[lo:hi][member[k[s]]]), pa.array(p[k[s]].astype(np.int32)),
                     pa.array((p[k[e]] + length).astype(np.int32))], names=["uid", "start", "end"])
            lo = hi

    local, copied = context.filter("not hot").select(*_MEMBER), []
    if any_hot:
        local, copied = _cooled(context, local, length)
    found = local.repartition(parts, "bucket").sortWithinPartitions("bucket", "uid", "first") \
        .mapInArrow(judge, "uid long, start int, end int")
    for some in copied:
        found = found.unionByName(some)
    spans_of = found.groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("s")) \
        .select("uid", F.lit(False).alias("copy"), F.col("s.start").alias("starts"), F.col("s.end").alias("ends"))
    none = F.array().cast("array<int>")
    return stored(spans_of.unionByName(copies.select("uid", F.lit(True).alias("copy"), none.alias("starts"),
                                                     none.alias("ends"))), "spans")


def deduplicated(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``kept`` (the remaining bytes), ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept_sha256``.
    Columns of these names are not allowed in ``docs``."""
    made = ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if set(made) & set(docs.columns):
        raise ValueError(f"columns {sorted(set(made) & set(docs.columns))} exist already")
    keep = [c for c in docs.columns if c != text]
    src = with_order(docs, doc_id, text)
    src = src.select("__uid", *[F.col(f"`{c}`") for c in keep],
                     F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    spans = repeats(src.select(F.col("__uid").alias("uid"), F.col("__text").alias("text")), length)
    spans = spans.select(F.col("uid").alias("__uid"), F.col("copy").alias("__copy"), F.col("starts").alias("__starts"),
                         F.col("ends").alias("__ends"))
    rows = src.join(spans, "__uid", "left").select("__copy", "__starts", "__ends", *[F.col(f"`{c}`") for c in keep], "__text")

    def run(batches):
        for whole in batches:
            for batch, data, off in slices(whole, "__text"):
                kept, removed, runs = [], [], []
                for i, (copy, starts, ends) in enumerate(zip(*(batch.column(c) for c in range(3)))):
                    raw = data[off[i]:off[i + 1]]
                    if copy.as_py():
                        kept.append(b"")
                        removed.append(len(raw))
                        runs.append(1)
                    elif starts.is_valid and len(starts.values):
                        step = np.bincount(starts.values, minlength=len(raw) + 1) - np.bincount(ends.values, minlength=len(raw) + 1)
                        gone = np.cumsum(step[:len(raw)]) > 0
                        kept.append(raw[~gone].tobytes())
                        removed.append(int(gone.sum()))
                        runs.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                    else:
                        kept.append(raw.tobytes())
                        removed.append(0)
                        runs.append(0)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[3:-1], pa.array(kept, pa.binary()), pa.array(np.diff(off)),
                     pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())], names=[*keep, *made])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]
                       + ["kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"])
    return rows.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the remaining text of every row.  A character whose bytes
    were removed in part goes as a whole.  ``n_chars`` follows, if present."""
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("kept")
            texts = [x.decode("utf-8", "ignore") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.string())],
                                             names=[*batch.schema.names[:at], text])

    keep = [c for c in docs.columns if c != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]
                       + [f"`{text}` string"])
    out = deduplicated(docs, length, doc_id, text).select(*keep, "kept").mapInArrow(run, schema)
    if "n_chars" in keep:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
