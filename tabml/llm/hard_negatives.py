"""Hard-negative mining over Hilbert-ordered blocks with zone maps (operator 13).

1. *Blocks.*  Rows are sorted along a Hilbert curve through the ``AXES``
   widest directions of a sample and written as Parquet, ``BLOCK`` rows to a
   block, each with its zone map: the least and largest value of every
   component, and its labels.
2. *Bounds.*  For a vector q and a block, interval arithmetic over the zone map
   bounds every inner product from both sides: q+ . high + q- . low above,
   q+ . low + q- . high below, where q+ and q- are q's positive and negative
   components.
3. *Positives.*  An anchor reads the blocks that have its label and whose upper
   bound reaches the score that its own block already offers for the last place.
4. *Windows.*  Each positive's score s opens a window of scores from
   ``low`` to ``high`` percent of s.  An anchor reads the blocks that have
   another label and whose bounds meet one of its windows, above the score that
   its own block already offers for the last place there.

The result is exact whatever the bounds spare: on clustered vectors most
blocks, on vectors without structure few or none.  Anchors are taken in decks
of neighbours on the curve, blocks in zones of ``ZONE``; what leaves a (deck,
zone) is the best few rows of each anchor and window.

Vectors are scaled and floored to integers first, and scores are their
integer inner products.  Rows whose id, label or vector is null, or whose
vector holds a null or non-finite component, take no part.  Shorter vectors
count as if filled with zeros.  Repeated ids are rows of their own; an anchor
leaves out its own row only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored
from .partition_index import matrix

#: Rows of a block, blocks of a zone, anchors of a deck (about).
BLOCK, ZONE, DECK = 512, 16, 256
#: Directions of the curve, and bits of each.
AXES, BITS = 8, 6
#: Rows that the curve's directions are taken from at most.
SAMPLE = 16_384
#: Lower than any score.
NONE = np.iinfo(np.int64).min


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (0 to
    2**bits - 1), by Skilling's transposed bits."""
    x = cells.astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for row in x:
            place = place << 1 | (row >> b) & 1
    return place


def curve(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(directions, origin, cell width) of the curve: the widest directions of
    a sample, from its 1st to its 99th percentile along each."""
    if not len(sample):
        return np.zeros((sample.shape[1], 1)), np.zeros(1), np.ones(1)
    axes = np.linalg.eigh(np.cov(sample.T, bias=True).reshape(sample.shape[1], -1))[1][:, ::-1][:, :AXES]
    lo, hi = np.percentile(sample @ axes, [1, 99], axis=0)
    return axes, lo, np.maximum((hi - lo) / (1 << BITS), 1e-9)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bound of the inner product of each vector with anything
    in each box."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


def best(rows: np.ndarray, score: np.ndarray, ident: np.ndarray, uid: np.ndarray, k: int) -> np.ndarray:
    """Which entries are the first k of their row: highest score, smallest id."""
    order = np.lexsort((uid, ident, -score, rows))
    r = rows[order]
    return order[np.arange(len(r)) - np.searchsorted(r, r) < k]


class _Best:
    """The best k of each row over several blocks."""

    def __init__(self, rows: int, k: int):
        self.k, self.last = k, np.full(rows, NONE)             # score of the last place so far
        self.held = tuple(np.zeros(0, np.int64) for _ in range(4))

    def add(self, score: np.ndarray, ok: np.ndarray, ident: np.ndarray, uid: np.ndarray, first: int = 0) -> None:
        """Scores (rows by candidates) of rows ``first`` and on; only ``ok`` ones count."""
        last = self.last[first:first + len(score)]
        ok = ok & (score >= last[:, None])
        if ok.shape[1] > self.k:                               # no more than the k-th of this block, and what ties with it
            kth = -np.partition(-np.where(ok, score, NONE + 1), self.k - 1, axis=1)[:, self.k - 1]
            ok &= score >= kth[:, None]
        i, j = np.nonzero(ok)
        if not len(i):
            return
        new = (i + first, score[i, j], ident[j], uid[j])
        every = tuple(np.r_[a, b] for a, b in zip(self.held, new))
        chosen = best(*every, self.k)
        self.held = tuple(x[chosen] for x in every)
        row, s = self.held[0], self.held[1]
        start = np.searchsorted(row, row)
        full = np.arange(len(row)) - start == self.k - 1
        self.last[row[full]] = s[full]


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


def _packed(table: pa.Table, name: str, kind: str, width: int) -> np.ndarray:
    """Packed numbers of all rows, as rows of ``width``."""
    raw = b"".join(v.as_buffer() for v in table.column(name))
    return np.frombuffer(raw, kind).reshape(-1, width)


class _Scores:
    """Integer inner products: through doubles where these are exact."""

    def __init__(self, size: int, largest: int):
        self.size = size
        self.kind = np.float64 if size * largest * largest < 1 << 53 else np.int64

    def vectors(self, packed: np.ndarray) -> np.ndarray:
        return packed.astype(self.kind)

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a @ b.T).astype(np.int64)


def blocks(rows: DataFrame, size: int, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """Write rows (id, label, v, anchor) in the order of the curve: a stored
    table of one row per block: ``part``, ``seq`` (its place), ``low``, ``high``
    (zone map), ``labels`` (different ones), and the packed ``ids``,
    ``row_labels``, ``vectors`` and ``anchors``.  Rows inside a block are in
    ascending id."""
    spark = rows.sparkSession
    n = rows.count()
    chance = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 0.97 * sample / max(n, 1)))
    some = (rows if n <= sample else rows.filter(chance).limit(sample)).select("v").toArrow()
    axes, origin, width = curve(matrix(some.column(0), size))

    def place(batches):
        for batch in batches:
            x = (matrix(batch.column(2), size) @ axes - origin) / width
            key = hilbert(np.clip(x, 0, (1 << BITS) - 1).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=["id", "label", "v", "anchor", "key"])

    keyed = rows.select("id", "label", "v", "anchor").mapInArrow(place, "id long, label long, v array<long>, anchor boolean, key long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches):
        part, seq, held, count = TaskContext.get().partitionId(), 0, [], 0

        def one(t: pa.Table) -> pa.RecordBatch:
            t = t.sort_by([("id", "ascending")])
            v, label = matrix(t.column("v"), size).astype("<i8"), t.column("label").to_numpy()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([v.min(axis=0).tobytes()], pa.binary()),
                 pa.array([v.max(axis=0).tobytes()], pa.binary()), pa.array([np.unique(label).tolist()], pa.list_(pa.int64())),
                 pa.array([t.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                 pa.array([label.astype("<i8").tobytes()], pa.binary()), pa.array([_narrow(v).tobytes()], pa.binary()),
                 pa.array([t.column("anchor").to_numpy(zero_copy_only=False).astype("?").tobytes()], pa.binary())],
                names=["part", "seq", "low", "high", "labels", "ids", "row_labels", "vectors", "anchors"])

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            while count >= block:
                t = pa.Table.from_batches(held)
                yield one(t.slice(0, block))
                held, count, seq = t.slice(block).to_batches(), count - block, seq + 1
        if count:
            yield one(pa.Table.from_batches(held))

    return stored(keyed.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")
                  .select("id", "label", "v", "anchor")
                  .mapInArrow(pack, "part long, seq long, low binary, high binary, labels array<long>, ids binary, "
                                    "row_labels binary, vectors binary, anchors binary"), "blocks")


def _narrow(v: np.ndarray) -> np.ndarray:
    """Components as 16-bit numbers if all of a block fit, else 64-bit."""
    return v.astype("<i2") if v.size and np.abs(v).max() < 1 << 15 else v.astype("<i8")


def _block(row: dict, size: int):
    """(ids, labels, vectors, anchors) of a block."""
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["row_labels"], "<i8")
    kind = "<i2" if len(row["vectors"]) == 2 * size * len(ids) else "<i8"
    return ids, labels, np.frombuffer(row["vectors"], kind).reshape(len(ids), size), np.frombuffer(row["anchors"], "?")


def _own(table: DataFrame, size: int, largest: int, positives: int) -> DataFrame:
    """The anchors with what their own blocks offer: ``floor`` (score of the
    last positive there), and ``others`` (scores of different labels)."""
    def run(batches):
        scores = _Scores(size, largest)
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, v, asks = _block(row, size)
                if not asks.any():
                    continue
                at = np.flatnonzero(asks)
                whole = scores.vectors(v)
                s = scores.products(whole[at], whole)
                same = labels[at, None] == labels
                same[np.arange(len(at)), at] = False
                floor, others = [], []
                for i in range(len(at)):
                    mine = np.sort(s[i][same[i]])[::-1]
                    floor.append(int(mine[positives - 1]) if len(mine) >= positives else NONE)
                    others.append(np.sort(s[i][labels != labels[at[i]]]).astype("<i8").tobytes())
                k = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["deck"]] * k, pa.int64()), pa.array((row["block"] * _SPAN + at).astype(np.int64)),
                     pa.array(ids[at]), pa.array(labels[at]), pa.array([x.tobytes() for x in v[at].astype("<i8")], pa.binary()),
                     pa.array(floor, pa.int64()), pa.array(others, pa.binary())],
                    names=["deck", "uid", "id", "label", "v", "floor", "others"])

    return table.select("deck", "block", "ids", "row_labels", "vectors", "anchors") \
        .mapInArrow(run, "deck long, uid long, id long, label long, v binary, floor long, others binary")


#: A row's number is its block's times this plus its place there.
_SPAN = 1 << 24


def windows(t: pa.Table, negatives: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) score of each anchor's windows, a column per positive.
    A window starts no lower than the last place that the anchor's own block
    can fill; without a positive it is empty."""
    lists = t.column("scores").to_pylist()
    width = max(map(len, lists), default=0)
    lo, hi = np.ones((len(lists), width), np.int64), np.zeros((len(lists), width), np.int64)
    for i, (scores, others) in enumerate(zip(lists, t.column("others"))):
        own = np.frombuffer(others.as_buffer(), "<i8")
        for j, s in enumerate(scores):
            lo[i, j], hi[i, j] = -(-low * s // 100), high * s // 100
            a, b = np.searchsorted(own, lo[i, j], "left"), np.searchsorted(own, hi[i, j], "right")
            if b - a >= negatives:
                lo[i, j] = own[b - negatives]
    return lo, hi


def _reads(anchors: DataFrame, zones: DataFrame, n_zones: int, n_decks: int, size: int, largest: int, needs) -> DataFrame:
    """(deck, zone, block) that the anchors of a deck must read.  ``needs``
    (anchor rows, lower, upper, labels of the blocks) tells by anchor and block."""
    def test(a: pa.Table, z: pa.Table) -> pa.Table:
        scores = _Scores(size, largest)
        if not a.num_rows or not z.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("deck", "zone", "block")})
        q = scores.vectors(_packed(a, "v", "<i8", size))
        lower, upper = bounds(q, *(scores.vectors(_packed(z, c, "<i8", size)) for c in ("low", "high")))
        read = z.filter(pa.array(needs(a, lower, upper, z.column("labels").to_pylist()).any(axis=0)))
        return pa.table({"deck": pa.array([a.column("deck")[0].as_py()] * read.num_rows, pa.int64()),
                         "zone": read.column("zone"), "block": read.column("block")})

    left = anchors.withColumn("zone", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_zones - 1).cast("long"))))
    right = zones.withColumn("deck", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_decks - 1).cast("long"))))
    return left.groupBy("deck", "zone").cogroup(right.groupBy("deck", "zone")) \
        .applyInArrow(test, "deck long, zone long, block long")


def _scored(anchors: DataFrame, table: DataFrame, reads: DataFrame, size: int, largest: int, k: int, ok) -> DataFrame:
    """Each anchor's best rows of each zone that it reads: ``anchor`` (uid),
    ``slot``, ``score``, ``id``, ``uid``.  ``ok`` (anchor rows) gives for a
    block (scores, same label) the slots' masks."""
    def score(a: pa.Table, b: pa.Table) -> pa.Table:
        scores = _Scores(size, largest)
        label, uid = _columns(a, "label", "uid")
        q = scores.vectors(_packed(a, "v", "<i8", size))
        slots, masks = ok(a)
        top = _Best(slots * len(label), k)
        for row in b.to_pylist() if len(label) else []:
            ids, labels, v, _ = _block(row, size)
            own = row["block"] * _SPAN + np.arange(len(ids))
            s = scores.products(q, scores.vectors(v))
            for slot, mask in enumerate(masks(s, label[:, None] == labels)):
                top.add(s, mask & (uid[:, None] != own), ids, own, slot * len(label))
        at, value, ident, other = top.held
        n = max(len(label), 1)
        return pa.table({"anchor": pa.array(uid[at % n] if len(label) else at), "slot": pa.array((at // n).astype(np.int32)),
                         "score": pa.array(value), "id": pa.array(ident), "uid": pa.array(other)})

    payload = table.select("block", "ids", "row_labels", "vectors", "anchors").join(reads, "block")
    mine = anchors.join(reads.select("deck", "zone").distinct(), "deck")
    mine = mine.toDF(*mine.columns)                            # columns of its own: both sides come from ``reads``
    return mine.groupBy("deck", "zone").cogroup(payload.groupBy("deck", "zone")) \
        .applyInArrow(score, "anchor long, slot int, score long, id long, uid long")


def mine(vectors: DataFrame, anchors: Column, scale: int = 256, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         block: int = BLOCK) -> DataFrame:
    """Hard negatives of the rows for which ``anchors`` holds.  For each of an
    anchor's first ``positives`` other rows of its label, the first
    ``negatives`` rows of another label whose score is at least ``low`` and at
    most ``high`` percent of the positive's: ``anchor_id``, ``positive_id``,
    ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    An empty table, or one without anchors, gives no rows.  Scores must fit a
    long: a table with components so large that they may not is refused."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                          F.when(v.isNotNull() & ~bad, whole).alias("d"), F.coalesce(anchors, F.lit(False)).alias("anchor")) \
        .filter("id is not null and label is not null and d is not null")
    n, n_anchors, size, largest = rows.agg(
        F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("d")),
        F.max(F.coalesce(F.array_max(F.transform("d", F.abs)), F.lit(0.0)))).first()
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return vectors.sparkSession.createDataFrame([], names)
    size, largest = max(size, 1), max(float(largest), 1.0)
    if size * largest * largest >= 2.0 ** 62:
        raise ValueError("vectors so large that their scores may not fit a long")
    largest = int(largest)
    rows = rows.select("id", "label", F.transform("d", lambda x: x.cast("long")).alias("v"), "anchor")

    # number the blocks along the curve: a count per partition of the sort
    table = blocks(rows, size, block)
    sizes = {r.part: r.n for r in table.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = np.cumsum([0, *[sizes.get(p, 0) for p in range(max(sizes) + 1)]]).tolist()
    n_blocks = before[-1]
    per_deck = max(1, -(-DECK * n_blocks // n_anchors))
    n_decks, n_zones = -(-n_blocks // per_deck), -(-n_blocks // ZONE)
    table = table.withColumn("block", F.get(F.array(*[F.lit(b).cast("long") for b in before]), F.col("part").cast("int")) + F.col("seq")) \
        .withColumn("zone", F.floor(F.col("block") / ZONE)).withColumn("deck", F.floor(F.col("block") / per_deck))
    zones = table.select("zone", "block", "low", "high", "labels")
    own = stored(_own(table, size, largest, positives), "anchors")

    def near(a, lower, upper, labels):
        label, floor = _columns(a, "label", "floor")
        has = np.stack([np.isin(label, x) for x in labels], axis=1)
        return has & (upper >= floor[:, None])

    def same(a):
        floor, = _columns(a, "floor")
        return 1, lambda s, same: [same & (s >= floor[:, None])]

    base = own.drop("others")
    reads = stored(_reads(base, zones, n_zones, n_decks, size, largest, near), "reads")
    first = _scored(base, table, reads, size, largest, positives, same)
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "uid")
    chosen = stored(first.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives)
                    .select("anchor", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    lists = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "positive_score"))).alias("p")) \
        .select(F.col("anchor").alias("uid"), F.col("p.positive_score").alias("scores"))      # as many as positives at most
    asking = stored(own.drop("floor").join(lists, "uid"), "windows")
    discard(reads)

    def meets(a, lower, upper, labels):
        label, = _columns(a, "label")
        lo, hi = windows(a, negatives, low, high)
        other = np.stack([np.full(len(label), True) if len(x) > 1 else label != x[0] for x in labels], axis=1)
        return other & ((upper[:, :, None] >= lo[:, None, :]) & (lower[:, :, None] <= hi[:, None, :])
                        & (lo <= hi)[:, None, :]).any(axis=2)

    def inside(a):
        lo, hi = windows(a, negatives, low, high)
        return lo.shape[1], lambda s, same: (~same & (s >= lo[:, j, None]) & (s <= hi[:, j, None]) for j in range(lo.shape[1]))

    reads = stored(_reads(asking, zones, n_zones, n_decks, size, largest, meets), "reads")
    found = _scored(asking, table, reads, size, largest, negatives, inside)
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id", "uid")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.withColumn("nth", F.col("slot") + 1).join(chosen, ["anchor", "nth"]) \
        .join(own.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor") \
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))
