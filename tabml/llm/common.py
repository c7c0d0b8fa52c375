"""Shared helpers: tables in the shared folder, Arrow text buffers, and word
and gram hashes computed over whole byte buffers with numpy."""

from __future__ import annotations

import ctypes
import gc
import pickle
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from tabml.session import ensure_checkpoint_dir

#: Text bytes worked on at once inside a task; bounds numpy temporaries.
CHUNK_BYTES = 1 << 20


# --------------------------------------------------------------- shared tables
def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage,
    survives lost executors, and lets Spark drop the shuffles behind it."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    gc.collect()                      # drop Python's handles on finished plans ...
    spark.sparkContext._jvm.System.gc()   # ... so that Spark's cleaner frees their shuffle files
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table written by ``stored`` once nothing reads it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def ship(spark: SparkSession, value) -> Callable:
    """Broadcast ``value`` and return what reads it inside a task.  Classes of
    this package travel by value, so workers need not be able to import it."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


# ---------------------------------------------------------------- Arrow buffers
def release() -> None:
    """Give freed memory back to the system.  Python workers serve one stage
    after another, and what allocators keep of each would add up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all values, offsets of each value).  Null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    if not len(col) or bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, col: str, limit: int = CHUNK_BYTES):
    """Cut a batch into runs of whole rows with at most ``limit`` bytes of
    ``col`` (one row may be longer): yields (slice, bytes, offsets)."""
    data, off = text_buffers(batch.column(batch.schema.get_field_index(col)))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield batch.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi
    release()


# ----------------------------------------------------------------------- hashes
_A, _B, _P = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer over an array of uint64 (a new array)."""
    x = x ^ (x >> _S)
    x *= _A
    x ^= x >> _S
    x *= _B
    x ^= x >> _S
    return x


def word_table(lower: bool = True) -> np.ndarray:
    """Byte table of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after
    lower-casing A-Z: a word byte maps to itself, any other byte to 0."""
    t = np.zeros(256, np.uint8)
    for lo, hi in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
        t[lo:hi] = np.arange(lo, hi)
    t[0x41:0x5B] = np.arange(0x61, 0x7B) if lower else np.arange(0x41, 0x5B)
    return t


def blank_table() -> np.ndarray:
    """Byte table of words between blanks and control characters."""
    t = np.arange(256).astype(np.uint8)
    t[:0x21] = 0
    return t


class Powers:
    """Powers of the word hash's odd multiplier and of its inverse modulo
    2**64, grown to the longest buffer seen by a task."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES)
            p = 0x5851F42D4C957F2D
            for name, base in (("up", p), ("down", pow(p, -1, 1 << 64))):
                a = np.full(n, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))
        return self.up, self.down


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray, powers: Powers):
    """Words of all values at once: (hash uint64, value index, start, end).
    Words never cross values."""
    n = len(data)
    low = table[data]
    is_w = np.zeros(n + 2, bool)
    is_w[1:-1] = low != 0
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(is_w[1:] & (~is_w[:-1] | edge))
    ends = np.flatnonzero(is_w[:-1] & (~is_w[1:] | edge))
    up, down = powers.get(n + 1)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(low * up[:n], out=s[1:], dtype=np.uint64)
    h = (s[ends] - s[starts]) * down[starts]
    h += (ends - starts).astype(np.uint64) * _P
    return mix(h), np.searchsorted(off, starts, "right") - 1, starts, ends


def grams(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of one value, with the value's index.  A
    value of fewer words, but not none, has one gram of all of them."""
    if not len(h):
        return h, doc
    n = len(h) - k + 1
    out_h, out_d = h[:0], doc[:0]
    if n > 0:
        acc = np.zeros(n, np.uint64)
        for j in range(k):
            acc = acc * _P + h[j:n + j]
        ok = doc[:n] == doc[k - 1:]
        out_h, out_d = acc[ok], doc[:n][ok]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    count = np.diff(np.r_[first, len(doc)])
    short = count < k
    if short.any():
        first, count = first[short], count[short]
        acc = np.zeros(len(first), np.uint64)
        for j in range(k - 1):
            m = j < count
            acc[m] = acc[m] * _P + h[first[m] + j]
        acc = acc * _P + count.astype(np.uint64)
        out_h, out_d = np.r_[out_h, acc], np.r_[out_d, doc[first]]
        order = np.argsort(out_d, kind="stable")
        out_h, out_d = out_h[order], out_d[order]
    return mix(out_h), out_d


def run_starts(key: np.ndarray) -> np.ndarray:
    """Index of the first row of each run of equal neighbours."""
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)


def whole_groups(batches, column: str):
    """Batches sorted by an integer column, as tables of whole groups."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(batch.schema.get_field_index(column)).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if held and last != key[0]:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
        last = key[-1]
    if held:
        yield pa.Table.from_batches(held)
    held.clear()
    release()
