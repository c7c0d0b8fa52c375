"""Benchmark decontamination over a distributed positional inverted index
(operator 8).

``build_index`` stores the postings of every token of every training document,
partitioned by document: one row is a segment of whole documents with its
sorted terms, their counts, and one ascending list of word positions per term.
``search`` finds where runs of benchmark words occur.  For each run it starts
from the list of its rarest term (counted over the whole index) and intersects
it with the other terms' lists, each shifted by the term's offset, from rare
to frequent.  The benchmark is the stated query set: it is cut into blocks of
at most ``BLOCK`` runs, so what is broadcast is bounded whatever its size.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; a term is
the 64-bit hash of its bytes.  Null and wordless texts have no words, are
never hit, and a null or wordless item has no runs.  Repeated rows are rows of
their own; items of the same id are one item; an item without an id still
hits words but is not listed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, Powers, ship, slices, stored, word_table, words
from .suffix_dedup import with_order

#: Benchmark runs broadcast at once (about 100 bytes each).
BLOCK = 200_000
#: Text bytes of one index segment; a longer document is a segment of its own.
SEGMENT_BYTES = 2 * CHUNK_BYTES
_SEGMENT = "segment long, doc_ids array<bigint>, starts binary, terms binary, counts binary, postings binary"


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs``, a table of segments.  Store it before searching."""
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                      F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        table, powers, made = word_table(), Powers(), 0
        part = TaskContext.get().partitionId()
        for whole in batches:
            for batch, data, off in slices(whole, "text", SEGMENT_BYTES):
                h, doc, _, _ = words(data, off, table, powers)
                order = np.argsort(h, kind="stable").astype(np.uint32)
                terms, counts = np.unique(h, return_counts=True)
                starts = np.searchsorted(doc, np.arange(len(off))).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | made]), pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64()))]
                    + [pa.array([x.tobytes()], pa.binary()) for x in
                       (starts, terms, counts.astype(np.uint32), order)],
                    names=["segment", "doc_ids", "starts", "terms", "counts", "postings"])
                made += 1

    return src.mapInArrow(run, _SEGMENT)


def runs_of(benchmark: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct runs of ``n`` consecutive words of each item (all its words if
    it has fewer): ``item_id``, ``run`` (hash) and ``terms`` (packed)."""
    src = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"),
                           F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        table, powers = word_table(), Powers()
        for whole in batches:
            for batch, data, off in slices(whole, "text"):
                h, doc, _, _ = words(data, off, table, powers)
                ids, at, terms = batch.column(0).to_pylist(), [], []
                first = np.searchsorted(doc, np.arange(len(off)))
                for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    for k in range(lo, max(lo + 1, hi - n + 1)) if hi > lo else ():
                        at.append(ids[i])
                        terms.append(h[k:min(hi, k + n)].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(terms, pa.binary())],
                                                 names=["item_id", "terms"])

    return src.mapInArrow(run, "item_id long, terms binary").distinct() \
        .select("item_id", F.xxhash64("terms").alias("run"), "terms")


class Queries:
    """One block of benchmark runs: the distinct runs as rows of term numbers
    (-1 pads), the vocabulary they use, and the items of each run."""

    def __init__(self, rows):
        numbers: dict[bytes, int] = {}
        pairs = [(numbers.setdefault(bytes(r.terms), len(numbers)), r.item_id) for r in rows]
        runs = [np.frombuffer(x, np.uint64) for x in numbers]
        self.vocabulary = np.unique(np.concatenate(runs)) if runs else np.zeros(0, np.uint64)
        self.lengths = np.array([len(x) for x in runs], np.int64)
        self.terms = np.full((len(runs), max(self.lengths, default=1)), -1, np.int64)
        for i, x in enumerate(runs):
            self.terms[i, :len(x)] = np.searchsorted(self.vocabulary, x)
        self.items: list[list] = [[] for _ in runs]
        for i, item in pairs:
            self.items[i].append(item)
        self.order_by(np.zeros(len(self.vocabulary), np.int64))

    def order_by(self, counts: np.ndarray) -> None:
        """Offsets of each run from its rarest term to its most frequent."""
        rank = np.where(self.terms < 0, np.iinfo(np.int64).max, counts[self.terms])
        self.offsets = np.argsort(rank, axis=1, kind="stable")


class Segment:
    """Postings of one index row, ready for look-ups."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.starts = np.frombuffer(row["starts"], np.uint32).astype(np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        self.postings = np.frombuffer(row["postings"], np.uint32).astype(np.int64)
        self.begin = np.r_[0, np.cumsum(self.counts)]
        self.size = int(self.starts[-1])

    def local(self, vocabulary: np.ndarray) -> np.ndarray:
        """Number of each term in this segment, -1 if absent."""
        if not len(self.terms):
            return np.full(len(vocabulary), -1)
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        return np.where(self.terms[at] == vocabulary, at, -1)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, position, "right") - 1

    def search(self, q: Queries, slop: int | None = None):
        """(run number, first word, last word) of every match.  ``slop`` None:
        exact phrases.  Otherwise proximity: every term of the run occurs
        within its length - 1 + slop words of an occurrence of its rarest."""
        local = np.r_[self.local(q.vocabulary), -1]
        here = ((q.terms < 0) | (local[q.terms] >= 0)).all(axis=1)
        runs = np.flatnonzero(here)
        none = np.zeros(0, np.int64)
        if not len(runs):
            return none, none, none
        anchor = local[q.terms[runs, q.offsets[runs, 0]]]
        count = self.counts[anchor]
        run = np.repeat(runs, count)
        at = self.postings[np.arange(len(run)) + np.repeat(self.begin[anchor] - np.cumsum(count) + count, count)]
        start = at - np.repeat(q.offsets[runs, 0], count)
        # term-major, position-ascending: one sorted list of all lists
        lists = np.repeat(np.arange(len(self.terms)), self.counts) << 32 | self.postings
        if slop is None:
            last = start + q.lengths[run] - 1
            ok = (start >= 0) & (last < self.size)
            ok[ok] = self.doc_of(start[ok]) == self.doc_of(last[ok])
        else:
            reach = q.lengths[run] - 1 + slop
            doc = self.doc_of(at)
            low, high = np.maximum(at - reach, self.starts[doc]), np.minimum(at + reach, self.starts[doc + 1] - 1)
            start, last, ok = at, at.copy(), np.ones(len(at), bool)
        for j in range(1, q.terms.shape[1]):
            run, start, last = run[ok], start[ok], last[ok]
            if slop is not None:
                at, low, high = at[ok], low[ok], high[ok]
            if not len(run):
                break
            off = q.offsets[run, j]
            more = j < q.lengths[run]
            term = local[q.terms[run, off]]
            if slop is None:
                want = term << 32 | (start + off)
                got = lists[np.minimum(np.searchsorted(lists, want), len(lists) - 1)]
                ok = ~more | (got == want)
            else:
                i = np.searchsorted(lists, term << 32 | at)
                after = lists[np.minimum(i, len(lists) - 1)] - (term << 32)
                before = lists[np.maximum(i - 1, 0)] - (term << 32)
                a, b = (after >= at) & (after <= high), (before >= low) & (before <= at)
                near = np.where(a & (~b | (after - at <= at - before)), after, before)
                ok = ~more | a | b
                start = np.where(more & ok, np.minimum(start, near), start)
                last = np.where(more & ok, np.maximum(last, near), last)
        else:
            run, start, last = run[ok], start[ok], last[ok]
        return run, start, last


def one_by_one(batch: pa.RecordBatch):
    """The rows of a batch of segments, of which only one is copied at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _blocks(index: DataFrame, benchmark: DataFrame, n: int):
    """Broadcast blocks of the benchmark's runs, each ordered by the counts of
    its terms over the whole index."""
    spark = index.sparkSession
    runs = stored(runs_of(benchmark, n), "runs")
    blocks = max(1, -(-runs.count() // BLOCK))
    for b in range(blocks):
        q = Queries(runs.filter(F.pmod(F.xxhash64("run", "item_id"), F.lit(blocks)) == b).collect())
        known = spark.sparkContext.broadcast(q.vocabulary)

        def count(batches):
            total = np.zeros(len(known.value), np.int64)
            for batch in batches:
                for terms, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    terms, counts = np.frombuffer(terms, np.uint64), np.frombuffer(counts, np.uint32)
                    if len(terms):
                        at = np.minimum(np.searchsorted(terms, known.value), len(terms) - 1)
                        total += np.where(terms[at] == known.value, counts[at], 0)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

        counts = np.zeros(len(q.vocabulary), np.int64)
        for r in index.select("terms", "counts").mapInArrow(count, "term long, n long") \
                .groupBy("term").agg(F.sum("n").alias("n")).collect():   # at most the block's vocabulary
            counts[r.term] = r.n
        q.order_by(counts)
        yield ship(spark, q)


def matches(index: DataFrame, benchmark: DataFrame, n: int = 10, slop: int | None = None) -> DataFrame:
    """Every match as a row: ``doc_id``, ``item_id``, ``first_word``,
    ``last_word`` (from 0, in the document).  ``slop`` as in
    ``Segment.search``: None gives exact phrases, a number proximity matches."""
    def one(block):
        def run(batches):
            q = block()
            for batch in batches:
                for row in one_by_one(batch):
                    s = Segment(row)
                    found, start, last = s.search(q, slop)
                    doc = s.doc_of(start)
                    base = s.starts[doc]
                    rows = [(s.doc_ids[d], item, a, b) for r, d, a, b in
                            zip(found.tolist(), doc.tolist(), (start - base).tolist(), (last - base).tolist())
                            for item in q.items[r]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), pa.int64()) for c in (zip(*rows) if rows else ([], [], [], []))],
                        names=["doc_id", "item_id", "first_word", "last_word"])
        return index.mapInArrow(run, "doc_id long, item_id long, first_word long, last_word long")

    out = None
    for block in _blocks(index, benchmark, n):
        out = one(block) if out is None else out.unionByName(one(block))
    return out.distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """One row per document row: ``doc_id``, ``n_words``, ``n_hit`` (words
    inside any occurrence of a benchmark run of ``n`` words), ``items`` (sorted
    ids, as strings, of the items with occurring runs) and ``contaminated``."""
    index = stored(build_index(docs, doc_id, text), "index")

    def one(block):
        def run(batches):
            q = block()
            for batch in batches:
                for row in one_by_one(batch):
                    s = Segment(row)
                    found, start, last = s.search(q)
                    step = np.bincount(start, minlength=s.size + 1) - np.bincount(last + 1, minlength=s.size + 1)
                    hit = np.cumsum(step[:s.size]) > 0
                    doc = s.doc_of(start)
                    pairs = np.unique(doc * len(q.items) + found) if len(found) else found
                    items: dict[int, set] = {}
                    for p in pairs.tolist():
                        items.setdefault(p // len(q.items), set()).update(q.items[p % len(q.items)])
                    bounds = s.starts.tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["segment"]] * len(s.doc_ids), pa.int64()),
                         pa.array(range(len(s.doc_ids)), pa.int64()), pa.array(s.doc_ids, pa.int64()),
                         pa.array(np.diff(s.starts), pa.int64()),
                         pa.array([np.packbits(hit[a:b]).tobytes() if i in items else None
                                   for i, (a, b) in enumerate(zip(bounds, bounds[1:]))], pa.binary()),
                         pa.array([[str(x) for x in items.get(i, ()) if x is not None]
                                   for i in range(len(s.doc_ids))], pa.list_(pa.string()))],
                        names=["segment", "row", "doc_id", "n_words", "hits", "items"])
        return index.mapInArrow(run, "segment long, row long, doc_id long, n_words long, hits binary, "
                                     "items array<string>")

    parts = [one(block) for block in _blocks(index, benchmark, n)]
    out = parts[0].withColumn("hits", F.array("hits"))
    if len(parts) > 1:                                  # a document's hits, from each block
        rest = parts[0]
        for p in parts[1:]:
            rest = rest.unionByName(p)
        out = rest.groupBy("segment", "row", "doc_id", "n_words").agg(
            F.collect_list("hits").alias("hits"), F.flatten(F.collect_list("items")).alias("items"))

    def merge(batches):
        for batch in batches:
            hits = []
            for n_words, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                bits = np.zeros(-(-n_words // 8), np.uint8)
                for p in parts:
                    if p is not None:
                        bits |= np.frombuffer(p, np.uint8)
                hits.append(int(np.unpackbits(bits).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.int64()),
                                              batch.column(3)], names=["doc_id", "n_words", "n_hit", "items"])

    return out.select("doc_id", "n_words", "hits", F.array_sort(F.array_distinct("items")).alias("items")) \
        .mapInArrow(merge, "doc_id long, n_words long, n_hit long, items array<string>") \
        .withColumn("contaminated", F.col("n_hit") > 0)


def remove_contaminated_rows(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Rows no word of which lies in a benchmark run.  Rows are told apart by a
    number of their own, so null and repeated ids do not matter."""
    src = with_order(docs)
    bad = contamination(src, benchmark, n, "__uid").filter("contaminated").select(F.col("doc_id").alias("__uid"))
    return src.join(bad, "__uid", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def item_digest(items: list[str]) -> str:
    """Digest of a sorted list of item ids, as the query reports it."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
