"""Approximate nearest neighbours by learned partitions (operator 12).

1. *Graph.*  Of a sample of at most ``SAMPLE`` vectors (chosen by hash), each
   one's ``NEIGHBOURS`` nearest are found by Spark, slice by slice against the
   broadcast sample.
2. *Balanced parts.*  The sample is halved along principal directions into
   equal parts; then vertices move to the part that most of their neighbours
   are in, while no part outgrows its share by more than ``SLACK``, so that
   few edges are cut.
3. *Classifier.*  A softmax regression learns which parts a vector's
   neighbours are in.  It is a few thousand weights, whatever the table.
4. *Search.*  Every row of the table goes to its most probable part, in a
   stored index; a query goes to its several most probable parts, as many as
   found ``TARGET`` of the neighbours of sampled vectors that the classifier
   did not learn from.  There all vectors are compared, in cells of bounded
   size: small parts share a cell, which returns a query's best of all of them,
   and a part of many rows is dealt to several, so a part of near copies is no
   single task.

Nearness is the inner product in double precision.  Products of whole blocks
only preselect; the scores that are compared and returned are summed
component by component in order, so equal vectors have equal scores and ties
go to the smaller id.  Rows without an id, and vectors that are null, empty,
zero or hold a null or non-finite component take no part.  Shorter vectors
count as if filled with zeros.  Repeated ids are rows of their own: a query
leaves out its own row only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored

#: Vectors that the index learns from at most.
SAMPLE = 16_384
#: Neighbours of a sampled vector in the graph.
NEIGHBOURS = 16
#: Rows a part should hold, and the most parts there are (a larger table has larger parts, dealt to several cells).
PART_ROWS, MAX_PARTS = 256, 256
#: Room of a part beyond its share of the sample.
SLACK = 0.1
#: Share of the held-out sample's neighbours that routing must reach.
TARGET = 0.95
#: Candidates and queries compared in one cell.
CELL_ROWS, CELL_QUERIES = 8192, 2048
#: Queries scored at once in a cell; bounds its memory.
AT_ONCE = 128


def usable(vector: str) -> Column:
    """Whether a vector can be compared: some component is not 0, none null or non-finite."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def matrix(col: pa.Array, size: int) -> np.ndarray:
    """Arrow lists as rows of ``size`` doubles, shorter ones filled with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = np.diff(col.offsets.to_numpy())
    if len(col) and (n == size).all():
        return flat.reshape(len(col), size)
    out = np.zeros((len(col), size))
    out[np.arange(size) < n[:, None]] = flat
    return out


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed component by component."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


# ------------------------------------------------------------------- the fit
def neighbour_graph(sample: DataFrame, vectors: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Positions of each sampled vector's nearest ones, most alike first.
    ``sample``: (at, vector), of which ``vectors`` is the matrix."""
    n, size = vectors.shape
    k = min(k, n - 1)
    shared = sample.sparkSession.sparkContext.broadcast(vectors)      # at most SAMPLE rows

    def run(batches):
        for batch in batches:
            at, rows = batch.column(0).to_numpy(), matrix(batch.column(1), size)
            for lo in range(0, len(at), 512):
                s = rows[lo:lo + 512] @ shared.value.T
                s[np.arange(len(s)), at[lo:lo + 512]] = -np.inf
                near = np.argpartition(-s, k - 1, axis=1)[:, :k]
                near = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1, kind="stable"), 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(at[lo:lo + 512]), pa.array([x.tobytes() for x in near], pa.binary())],
                                                 names=["at", "near"])

    slots = sample.sparkSession.sparkContext.defaultParallelism
    rows = sample.repartition(slots).mapInArrow(run, "at long, near binary").collect()
    out = np.zeros((n, k), np.int32)
    for r in rows:
        out[r.at] = np.frombuffer(r.near, np.int32)
    shared.destroy()
    return out


def halved(x: np.ndarray, parts: int) -> np.ndarray:
    """Equal parts (a power of two) by halving along the widest direction."""
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        cut = []
        for g in groups:
            y = x[g] - x[g].mean(axis=0)
            o = g[np.argsort(y @ np.linalg.eigh(y.T @ y)[1][:, -1], kind="stable")]
            cut += [o[:len(o) // 2], o[len(o) // 2:]]
        groups = cut
    out = np.zeros(len(x), np.int64)
    for i, g in enumerate(groups):
        out[g] = i
    return out


def balanced(near: np.ndarray, part: np.ndarray, parts: int, slack: float = SLACK, rounds: int = 8) -> np.ndarray:
    """Cut fewer edges of the graph: vertices move, largest gain first, to the
    part most of their neighbours are in, if it has room."""
    n, k = near.shape
    part, room = part.copy(), int(np.ceil(n / parts * (1 + slack)))
    src = np.r_[np.repeat(np.arange(n), k), near.ravel()]
    dst = np.r_[near.ravel(), np.repeat(np.arange(n), k)]
    order = np.argsort(src, kind="stable")
    src, dst = src[order], dst[order]
    start = np.searchsorted(src, np.arange(n + 1))
    size = np.bincount(part, minlength=parts)
    links = np.zeros((n, parts))
    np.add.at(links, (src, part[dst]), 1)
    for _ in range(rounds):
        gain, moved = links.max(axis=1) - links[np.arange(n), part], 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            open_ = np.where(size < room, links[i], -1.0)
            to, old = int(open_.argmax()), part[i]
            if open_[to] > links[i, old]:
                part[i] = to
                size[to] += 1
                size[old] -= 1
                around = dst[start[i]:start[i + 1]]
                np.add.at(links, (around, to), 1)
                np.add.at(links, (around, old), -1)
                moved += 1
        if moved <= n // 1000:
            break
    return part


def softmax_fit(x: np.ndarray, target: np.ndarray, epochs: int = 20, rate: float = 0.02, batch: int = 256) -> np.ndarray:
    """Weights (components and an intercept, by part) of a softmax regression
    on soft targets, by Adam with a falling rate."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros((x.shape[1], target.shape[1]))
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    for epoch in range(epochs):
        for lo in range(0, len(x), batch):
            b = x[lo:lo + batch]
            z = b @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = b.T @ (p - target[lo:lo + batch]) / len(b) + 1e-5 * w
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (1 - epoch / epochs) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def fit(rows: DataFrame, n: int, size: int, sample: int = SAMPLE, target: float = TARGET,
        max_parts: int = MAX_PARTS) -> tuple[np.ndarray, int]:
    """(weights, parts a query is routed to).  ``rows``: (uid, vector), ``n``
    of them with vectors of ``size``.  The sample and all that is made of it
    is bounded by ``sample``; a table no larger is learnt from whole."""
    parts = 1
    while parts < max_parts and n >= 2 * parts * PART_ROWS:
        parts *= 2
    chance = F.pmod(F.xxhash64("uid", F.lit(12)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 0.97 * sample / max(n, 1)))
    some = rows if n <= sample else rows.filter(chance).limit(sample)
    if parts == 1:
        return np.zeros((size + 1, 1)), 1
    table = some.orderBy(F.xxhash64("uid", F.lit(7))).select("v").toArrow()   # in an order that has nothing to do with ids
    x = matrix(table.column(0), size)
    at = rows.sparkSession.createDataFrame(pa.table({"at": pa.array(np.arange(len(x))), "v": table.column(0)}))
    near = neighbour_graph(at, x)
    part = balanced(near, halved(x, parts), parts)
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1.0)
    goal[np.arange(len(x)), part] += 1.0
    goal /= goal.sum(axis=1, keepdims=True)
    held = max(1, len(x) // 8)                                 # not learnt from: says how many parts to ask
    w = softmax_fit(x[held:], goal[held:])
    z = logits(x, w)
    own, rank = z.argmax(axis=1), np.argsort(np.argsort(-z[:held], axis=1, kind="stable"), axis=1)
    needed = np.sort(rank[np.arange(held)[:, None], own[near[:held]]], axis=None)
    return w, int(needed[int(np.ceil(target * len(needed))) - 1]) + 1


# ---------------------------------------------------------------- the search
def nearest(q: np.ndarray, q_uid: np.ndarray, c: np.ndarray, c_uid: np.ndarray, k: int):
    """(query, candidate, score) of each query's k nearest other rows.
    Candidates are in ascending id: of equal scores the earlier ones count."""
    out = []
    widest = np.sqrt((c * c).sum(axis=1).max(initial=0.0))
    for lo in range(0, len(q), AT_ONCE):
        part = q[lo:lo + AT_ONCE]
        s = part @ c.T
        s[q_uid[lo:lo + AT_ONCE, None] == c_uid[None, :]] = -np.inf
        kth = -np.partition(-s, k - 1, axis=1)[:, k - 1] if s.shape[1] > k else np.full(len(s), -np.inf)
        # block products may be off by rounding: what is that near the last place is scored exactly
        blur = 1e-14 * c.shape[1] * widest * np.sqrt((part * part).sum(axis=1))
        i, j = np.nonzero((s >= (kth - blur)[:, None]) & (s > -np.inf))
        score = exact(part[i], c[j])
        order = np.lexsort((j, -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        out.append((i[place < k] + lo, j[place < k], score[place < k]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int),) * 2 + (np.zeros(0),)


def search(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           sample: int = SAMPLE, target: float = TARGET, max_parts: int = MAX_PARTS) -> DataFrame:
    """The ``k`` nearest other rows found (all, if fewer) of each row for which
    ``queries`` holds: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.
    An empty table, or one without queries, gives no rows; columns but the id
    and the vector are not read."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asks")) \
        .filter(F.col("vec_id").isNotNull() & usable("v"))
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    weights, probes = fit(rows.select("uid", "v"), n, size, sample, target, max_parts)
    weights_parts = weights.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(weights)        # MAX_PARTS by a vector's size at most

    def route(batches):
        for batch in batches:
            z = logits(matrix(batch.column(1), size), shared.value)
            asks = batch.column(2).to_numpy(zero_copy_only=False)
            order = np.argsort(-z[asks], axis=1, kind="stable")[:, :probes].astype(np.int32)
            lists: list = [None] * batch.num_rows
            for i, row in zip(np.flatnonzero(asks).tolist(), order.tolist()):
                lists[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(z.argmax(axis=1).astype(np.int32)),
                 pa.array(lists, pa.list_(pa.int32()))], names=["vec_id", "v", "uid", "part", "probes"])

    kind = dict(rows.dtypes)["v"]
    index = stored(rows.select("vec_id", "v", "asks", "uid")
                   .mapInArrow(route, f"vec_id long, v {kind}, uid long, part int, probes array<int>"), "index")
    discard(rows)
    # parts share a cell up to CELL_ROWS rows; a larger part has cells of its own (the tables collected have a row per part or group)
    sizes = {r.part: r.n for r in index.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups, rows_in = [], [0]
    for p in range(weights_parts):
        if rows_in[-1] and rows_in[-1] + sizes.get(p, 0) > CELL_ROWS:
            rows_in.append(0)
        groups.append(len(rows_in) - 1)
        rows_in[-1] += sizes.get(p, 0)
    group = F.array(*[F.lit(g) for g in groups])
    asked = index.filter("probes is not null").withColumn("cell", F.explode(F.array_distinct(F.transform("probes", lambda p: F.get(group, p)))))
    loads = {r.cell: r.n for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    def cells(count: list[int], rows_each: int) -> Column:
        """How many cells the rows of a group are dealt to."""
        return F.get(F.array(*[F.lit(max(1, -(-n // rows_each))) for n in count]), F.col("cell"))

    blocks, decks = cells(rows_in, CELL_ROWS), cells([loads.get(g, 0) for g in range(len(rows_in))], CELL_QUERIES)

    def deal(count: Column) -> Column:
        return F.pmod(F.xxhash64("uid"), count).cast("int")

    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    left = asked.select("vec_id", "v", "uid", "probes", "cell").withColumn("deck", deal(decks)).withColumn("block", every(blocks))
    right = index.select("vec_id", "v", "uid", "part").withColumn("cell", F.get(group, F.col("part"))) \
        .filter(F.col("cell").isin(sorted(loads)) if loads else F.lit(False)) \
        .withColumn("block", deal(blocks)).withColumn("deck", every(decks))

    def compare(q: pa.Table, c: pa.Table) -> pa.Table:
        """The k nearest of each query among the cell's rows in its parts."""
        c = c.sort_by([("part", "ascending"), ("vec_id", "ascending"), ("uid", "ascending")])
        part, ids, uids = (c.column(x).to_numpy() for x in ("part", "vec_id", "uid"))
        x, y, q_uid = matrix(q.column("v"), size), matrix(c.column("v"), size), q.column("uid").to_numpy()
        wants = np.zeros((len(x), weights_parts), bool)
        for i, probes_of in enumerate(q.column("probes").to_pylist()):
            wants[i, probes_of] = True
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        for p in np.unique(part).tolist():
            lo, hi = np.searchsorted(part, [p, p + 1])
            at = np.flatnonzero(wants[:, p])
            i, j, score = nearest(x[at], q_uid[at], y[lo:hi], uids[lo:hi], k)
            found.append((at[i], j + lo, score))
        i, j, score = (np.concatenate(f) for f in zip(*found))
        order = np.lexsort((uids[j], ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        i, j, score = i[first], j[first], score[first]
        return pa.table({"query": q.column("uid").take(pa.array(i)), "query_id": q.column("vec_id").take(pa.array(i)),
                         "vec_id": pa.array(ids[j]), "uid": pa.array(uids[j]), "score": pa.array(score, pa.float64())})

    cell = ["cell", "block", "deck"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)) \
        .applyInArrow(compare, "query long, query_id long, vec_id long, uid long, score double")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
