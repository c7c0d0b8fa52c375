"""Recommendation.

ALS is Spark ML's blocked alternating least squares.  ``top_k_from_factors``
scores two factor tables without ever materialising all user x item pairs:
users are hash-blocked, all items stream through each block, longest vectors
first, numpy multiplies them and only each user's top k leaves the task; a
final per-user top-k merges at most ``item_blocks * k`` candidates.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .features import dense_index
from .models import cached

INT_MAX = 2 ** 31 - 1
# Sizes of the factor top-k.  Every item is copied once per user block, so
# user blocks are as large as a Python worker can hold (USER_VALUES numbers,
# and k best of each user beside them).  Items are only parted where the users
# alone don't fill the task slots (into blocks of ITEM_BLOCK at least), or where
# a task would read more than ITEM_VALUES numbers of them.
# Products are taken USER_CHUNK users by ITEM_CHUNK items at a time, and what is
# told leaves USER_BLOCK users at a time.
USER_BLOCK = 4096
USER_VALUES = 1 << 23
ITEM_BLOCK = 65536
ITEM_VALUES = 1 << 27
USER_CHUNK = 1024
ITEM_CHUNK = 1024
#: Ratings of an ALS block up to which there is one for every other task slot.
BLOCK_RATINGS = 40_000_000
#: Where ratings, ALS's blocks of them and its vectors are kept.
KEPT, KEPT_NAME = StorageLevel.DISK_ONLY, "DISK_ONLY"
#: Users a block has at least when blocks are made to fill the task slots.
LEAST_USERS = 1024
#: Candidates of a user in one chunk up to which they are scored one by one.
FEW = 64


def id_map(df: DataFrame, key: str, out: str = "id") -> DataFrame:
    """Dense 32-bit ids ``(key, out)`` for keys that may not fit in an int
    (ALS requires int ids).  Distributed numbering, no driver round trip."""
    keys = df.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    return dense_index(keys, [F.col(key).asc()], out).select(key, F.col(out).cast("int").alias(out))


def fits_int(df: DataFrame, *cols: str) -> bool:
    """Whether the id columns are usable as ALS ids (within the 32-bit int
    range).  Columns typed int/short/byte need no pass over the data; wider
    ones are checked with one min/max aggregate."""
    narrow = ("int", "smallint", "tinyint")
    if all(dict(df.dtypes)[c] in narrow for c in cols):
        return True
    row = df.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).head()
    return all((row[f"lo{i}"] is None or row[f"lo{i}"] >= -INT_MAX - 1) and
               (row[f"hi{i}"] is None or row[f"hi{i}"] <= INT_MAX) for i in range(len(cols)))


def fit_als(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 10,
            max_iter: int = 10, reg: float = 0.1, seed: int = 42,
            cold_start: str = "drop", implicit: bool = False, blocks: int | None = None):
    """F9 + I1: explicit-feedback ALS with the reference's settings (10
    iterations, lambda 0.1, rank 10).  Ids must fit in a 32-bit int; use
    :func:`id_map` first for wider keys.  ``cold_start='drop'`` removes rows
    with unknown user or item from ``transform`` output."""
    # ALS scans its input twice before it builds (and persists) its own
    # user/item rating blocks; keep the input for the fit only, so the joins
    # that produced the ratings run once.  Building a block takes several times
    # its size in arrays that Spark does not account for, and kept blocks make
    # no room for them; so what is kept waits on disk.
    with cached(ratings.select(user, item, rating), KEPT) as r:
        blocks = blocks or als_blocks(r)
        als = ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, maxIter=max_iter,
                  regParam=reg, seed=seed, coldStartStrategy=cold_start, implicitPrefs=implicit,
                  checkpointInterval=10, numUserBlocks=blocks, numItemBlocks=blocks,
                  intermediateStorageLevel=KEPT_NAME, finalStorageLevel=KEPT_NAME)
        return als.fit(r)


def als_blocks(ratings: DataFrame) -> int:
    """User (and item) blocks of a fit.  Every half step sends a vector to
    each block that has a rating of it, so what is shuffled grows with the
    blocks until there are as many as ratings of a user: half the task slots
    keep the shuffle low, and more are taken only where a block would hold
    more than BLOCK_RATINGS."""
    slots = ratings.sparkSession.sparkContext.defaultParallelism
    return max(2, slots // 2, _block_count(ratings.count(), BLOCK_RATINGS))


def score_holdout(model, train: DataFrame, holdout: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """Score held-out ratings and account for every one of them, one row
    ``(n, scored, unknown_user, unknown_item, unknown_both, rmse, mae)``.

    A rating whose user or item has no vector is not scored: with the fit's
    cold start ``drop`` it vanishes from ``transform``, with ``nan`` its prediction is
    NaN.  Either way it counts under what the training ratings lack: the user
    alone, the item alone, or both (a NULL id is unknown).  ``scored`` counts the predictions that the
    model really gave, and the errors are over these."""
    users = train.select(F.col(user).alias("_u")).filter("_u is not null").distinct().withColumn("_ku", F.lit(True))
    items = train.select(F.col(item).alias("_i")).filter("_i is not null").distinct().withColumn("_ki", F.lit(True))
    held = holdout.select(user, item, F.col(rating).cast("double").alias("_r"))
    no_user, no_item = F.col("_ku").isNull(), F.col("_ki").isNull()
    counts = held.join(users, F.col(user) == F.col("_u"), "left").join(items, F.col(item) == F.col("_i"), "left").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(no_user & ~no_item).alias("unknown_user"),
        F.count_if(~no_user & no_item).alias("unknown_item"), F.count_if(no_user & no_item).alias("unknown_both"))
    p = F.col(model.getPredictionCol()).cast("double")
    e = F.when(p.isNotNull() & ~F.isnan(p), p - F.col("_r"))
    errors = model.transform(held.filter(F.col(user).isNotNull() & F.col(item).isNotNull())).agg(
        F.count(F.when(p.isNotNull() & ~F.isnan(p), F.lit(1))).alias("scored"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))
    one = errors.agg(F.struct(F.first("scored").alias("scored"), F.first("rmse").alias("rmse"), F.first("mae").alias("mae"))).scalar()
    return counts.withColumn("_e", one).select("n", F.col("_e.scored").alias("scored"), "unknown_user", "unknown_item",
                                               "unknown_both", F.col("_e.rmse").alias("rmse"), F.col("_e.mae").alias("mae"))


def top_k(model, k: int = 5, user: str | None = None, item: str | None = None,
          method: str = "blocked") -> DataFrame:
    """Top-k items for every user, seen items not excluded, flat:
    ``(user, rank, item, score)``.

    ``method="blocked"`` (default) scores the model's user and item factor
    tables with :func:`top_k_from_factors`: hash blocks meet in a cogroup and
    only each user's top k leaves a task, so the plan has no cross join;
    ties go to the smaller item id.  ``method="builtin"`` is Spark's
    ``recommendForAllUsers`` (a cartesian product of factor blocks with a
    bounded top k per block); on the test data both give the same lists."""
    if method == "blocked":
        return top_k_from_factors(model.userFactors, model.itemFactors, k,
                                  "id", "features", "id", "features")
    user = user or model.getUserCol()
    item = item or model.getItemCol()
    recs = model.recommendForAllUsers(k)
    return recs.select(F.col(user), F.posexplode("recommendations").alias("pos", "r")).select(
        F.col(user).alias("user"), (F.col("pos") + 1).alias("rank"),
        F.col(f"r.{item}").alias("item"), F.col("r.rating").cast("double").alias("score"))


def _block_count(n: int, target: int) -> int:
    return max(1, math.ceil(n / target))


def _top_k_cells(S: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each row's top k by (score desc, column asc), exactly.

    Columns are in item-id order.  ``np.partition`` finds each row's k-th
    score t in linear time; every score > t is kept and scores == t fill the
    remaining places from the left (smaller ids first).  Row-major output:
    each row's min(k, n_cols) cells are contiguous."""
    n_items = S.shape[1]
    kk = min(k, n_items)
    if kk == n_items:
        sel = np.ones_like(S, dtype=bool)
    else:
        t = -np.partition(-S, kk - 1, axis=1)[:, kk - 1][:, None]
        gt = S > t
        eq = S == t
        need = kk - gt.sum(axis=1, keepdims=True)
        sel = gt | (eq & (np.cumsum(eq, axis=1) <= need))
    rows, cols = np.nonzero(sel)
    return rows, cols


def _merge_top_k(best_s, best_i, s, i, k):
    """Keep each row's k best of (kept, new) candidates, by (score desc, id asc)."""
    cs = np.concatenate([best_s, s], axis=1)
    ci = np.concatenate([best_i, i], axis=1)
    order = np.lexsort((ci, -cs), axis=1)[:, :k]
    return np.take_along_axis(cs, order, 1), np.take_along_axis(ci, order, 1)


def _pair_scores(U: np.ndarray, I: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Dot products of row pairs, summed in the order of the components, so a
    score does not depend on what is scored beside it."""
    s = U[rows, 0] * I[cols, 0]
    for j in range(1, U.shape[1]):
        s += U[rows, j] * I[cols, j]
    return s


def _merge_all(U, I, ids, best_s, best_i, k):
    """Merge each user's top k of all items ``I`` into the kept ones."""
    S = np.zeros((len(U), len(I)))
    with np.errstate(invalid="ignore", over="ignore"):
        for j in range(U.shape[1]):
            S += np.multiply.outer(U[:, j], I[:, j])
    S[np.isnan(S)] = -np.inf                                # a NaN score ranks last
    _, cols = _top_k_cells(S, k)
    cols = cols.reshape(len(U), min(k, len(I)))
    return _merge_top_k(best_s, best_i, np.take_along_axis(S, cols, 1), ids[cols], k)


def _merge_cells(mask, U, I, ids, best_s, best_i, k):
    """The same where all that can be in the top k is marked in ``mask``.
    Few cells of a user are scored one by one, many (ties) all together."""
    count = mask.sum(axis=1)
    many = count > max(FEW, 4 * k)
    width = min(k, best_s.shape[1] + len(I))
    out_s, out_i = np.empty((len(U), width)), np.empty((len(U), width), dtype=np.int64)
    for lo in range(0, int(many.sum()), LEAST_USERS):
        at = np.flatnonzero(many)[lo:lo + LEAST_USERS]
        out_s[at], out_i[at] = _merge_all(U[at], I, ids, best_s[at], best_i[at], k)
    rows, cols = np.nonzero(mask & ~many[:, None])
    few = np.flatnonzero(~many)
    r = np.concatenate([np.repeat(few, best_s.shape[1]), rows])
    s = np.concatenate([best_s[few].ravel(), _pair_scores(U, I, rows, cols)])
    i = np.concatenate([best_i[few].ravel(), ids[cols]])
    order = np.lexsort((i, -s, r))
    pick = order[np.searchsorted(r[order], few)[:, None] + np.arange(width)]
    out_s[few], out_i[few] = s[pick], i[pick]
    return out_s, out_i


def _plain(V: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of vectors, and which can be scaled to length 1 in single precision."""
    with np.errstate(invalid="ignore", over="ignore"):
        n = np.sqrt((V * V).sum(axis=1))
    return n, np.isfinite(n) & (n < 1e100)


class TopK:
    """Exact top k items of users, for items that come in batches, the longest
    vectors first (:meth:`add`); ``scores`` and ``ids`` hold what is best so far.

    A user's k-th score so far, divided by its length, is the least length of
    an item that can still matter, so a user leaves at the first batch in which
    none is as long.  For the others products in single precision of vectors
    scaled to length 1 tell which items reach the k-th score, give or take
    ``margin``, the most that such a product can be off; those are scored in
    double precision.  So no item that belongs to the top k is passed over.
    Vectors of no length, or that are not finite, are scored with everything."""

    def __init__(self, U: np.ndarray, k: int, user_chunk: int = USER_CHUNK):
        self.U, self.k, self.user_chunk = U, k, user_chunk
        n, ok = _plain(U)
        ok &= (n > 1e-100) & (U.shape[1] > 0)
        self.margin = (U.shape[1] + 4) * 2.0 ** -23
        self.plain, self.rest = np.flatnonzero(ok), np.flatnonzero(~ok)
        self.length = n[self.plain]
        self.unit = np.empty((len(self.plain), U.shape[1]), dtype=np.float32)
        for lo in range(0, len(self.plain), user_chunk):
            to = slice(lo, lo + user_chunk)
            self.unit[to] = U[self.plain[to]] / self.length[to, None]
        self.scores, self.ids = np.empty((len(U), 0)), np.empty((len(U), 0), dtype=np.int64)
        self.live = np.arange(len(self.plain))

    @property
    def done(self) -> bool:
        """Whether no shorter item can matter to any user."""
        return not len(self.live) and not len(self.rest)

    def _widen(self, n: int) -> bool:
        """Make room for ``n`` items more; whether that many were missing."""
        width = min(self.k, self.scores.shape[1] + n)
        missing = width - self.scores.shape[1]
        if missing:
            self._old = self.scores.shape[1]
            self.scores = np.concatenate([self.scores, np.empty((len(self.U), missing))], axis=1)
            self.ids = np.concatenate([self.ids, np.empty((len(self.U), missing), dtype=np.int64)], axis=1)
        return bool(missing)

    def _best(self, at: np.ndarray, fresh: bool) -> tuple[np.ndarray, np.ndarray]:
        n = self._old if fresh else self.scores.shape[1]
        return self.scores[at, :n], self.ids[at, :n]

    def _all(self, users: np.ndarray, I: np.ndarray, ids: np.ndarray, fresh: bool) -> None:
        for lo in range(0, len(users), LEAST_USERS):
            at = users[lo:lo + LEAST_USERS]
            self.scores[at], self.ids[at] = _merge_all(self.U[at], I, ids, *self._best(at, fresh), self.k)

    def add(self, I: np.ndarray, ids: np.ndarray) -> None:
        """Meet the next items, none of them longer than those before (but for
        items that are not finite, which may come at any time)."""
        if not len(I) or self.done:
            return
        order = np.argsort(ids, kind="stable")              # ties go to the smaller id
        I, ids = I[order], ids[order]
        n, ok = _plain(I)
        if not ok.all():
            fresh = self._widen(int((~ok).sum()))
            self._all(np.arange(len(self.U)), I[~ok], ids[~ok], fresh)
            I, ids, n = I[ok], ids[ok], n[ok]
            if not len(I):
                return
        fresh = self._widen(len(I))
        self._all(self.rest, I, ids, fresh)
        longest = n.max() or 1.0
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            items = (I / longest).astype(np.float32).T.copy()
            scale = self.length[self.live] * longest
            limit = np.full(len(self.live), -np.inf) if fresh else self.scores[self.plain[self.live], -1] / scale - self.margin
        if not fresh:
            near = ~(limit > 1)
            live, limit = self.live[near], limit[near].astype(np.float32)
            if longest > 1e-150:                            # else lengths are not told apart in order
                self.live = live
        else:
            live = self.live
        c = min(self.k, len(I))
        for lo in range(0, len(live), self.user_chunk):
            part = live[lo:lo + self.user_chunk]
            S = self.unit[part] @ items
            if fresh:
                mask = S >= (np.partition(S, S.shape[1] - c, axis=1)[:, -c] - 2 * self.margin)[:, None]
            else:
                least = limit[lo:lo + self.user_chunk]
                hit = np.flatnonzero(S.max(axis=1) >= least)
                if not len(hit):
                    continue
                part, mask = part[hit], S[hit] >= least[hit, None]
            at = self.plain[part]
            self.scores[at], self.ids[at] = _merge_cells(mask, self.U[at], I, ids, *self._best(at, fresh), self.k)


def score_block(U: np.ndarray, I: np.ndarray, item_ids: np.ndarray, k: int,
                user_chunk: int = USER_CHUNK, item_chunk: int = ITEM_CHUNK):
    """Exact top-k items per user row of ``U`` against ``I``.  Returns
    ``(scores, ids)`` of shape (n_users, min(k, n_items)); ties go to the
    smaller id.  The items meet :class:`TopK` chunk by chunk, longest first."""
    top = TopK(U, k, user_chunk)
    n, ok = _plain(I)
    order = np.argsort(np.where(ok, -n, np.inf), kind="stable")
    for lo in range(0, len(I), item_chunk):
        at = order[lo:lo + item_chunk]
        top.add(I[at], item_ids[at])
    return top.scores, top.ids


def usable_vectors(df: DataFrame, vec: str = "v") -> DataFrame:
    """Rows with a vector that has no NULL in it.  The others cannot be scored:
    count them with ``df.exceptAll(usable_vectors(df, vec))``."""
    return df.filter(F.col(vec).isNotNull() & ~F.exists(vec, lambda x: x.isNull()))


def top_k_from_factors(users: DataFrame, items: DataFrame, k: int = 5,
                       user_id: str = "id", user_vec: str = "features",
                       item_id: str = "id", item_vec: str = "features",
                       user_blocks: int | None = None, item_blocks: int | None = None,
                       user_chunk: int = USER_CHUNK, item_chunk: int = ITEM_CHUNK) -> DataFrame:
    """I2 second form: top-k items per user by dot product of two factor
    tables ``(id, array<double>)``.  Output ``(user, rank, item, score)``;
    ties go to the smaller item id.

    Users are hash-blocked, up to USER_VALUES numbers a block and at least one
    block for each task slot, and every block meets all items: they arrive
    sorted by length, longest first, and stream through :class:`TopK`, so a task
    holds one block of users and one batch of items, whatever the data size.
    Where there are too few users to fill the slots, or very many items, these
    are hash-blocked too.  A final per-user top k merges ``item_blocks * k`` candidates.  No
    user x item pair is ever materialised as a row.  Rows without a usable
    vector are left out; a NaN score ranks last."""
    u, i = _vectors(users, user_id, user_vec), _vectors(items, item_id, item_vec)
    if user_blocks is None or item_blocks is None:
        n_u, wide = u.agg(F.count(F.lit(1)), F.max(F.size("v"))).head()
        n_i = i.agg(F.count(F.lit(1))).head()[0]
        slots = users.sparkSession.sparkContext.defaultParallelism
        user_blocks = user_blocks or max(_block_count(n_u, max(1, USER_VALUES // max(1, wide or 1))),
                                         min(slots, max(1, n_u // LEAST_USERS)))
        item_blocks = item_blocks or max(_block_count(n_i * max(1, wide or 1), ITEM_VALUES),
                                         min(_block_count(slots, user_blocks), _block_count(n_i, ITEM_BLOCK)))
    ub = F.pmod(F.xxhash64("id"), F.lit(user_blocks)).cast("int")
    ib = F.pmod(F.xxhash64("id"), F.lit(item_blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # every user meets every item block once and vice versa; users come first
    rows = (u.withColumn("ub", ub).withColumn("ib", every(item_blocks)).withColumn("size", F.lit(None).cast("double"))
            .unionByName(i.withColumn("ib", ib).withColumn("ub", every(user_blocks)).withColumn(
                "size", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))))
    dealt = (rows.select("id", "v", "size", (F.col("ub") * item_blocks + F.col("ib")).alias("pair"))
             .repartitionById(user_blocks * item_blocks, "pair").sortWithinPartitions(F.col("size").desc_nulls_first()))

    def score(batches):
        seen, ids, top = [], [], None
        for batch in batches:
            size = batch.column("size")
            n = size.null_count                             # users stand before the items
            if n:
                seen.append(_matrix(batch.column("v").slice(0, n)))
                ids.append(batch.column("id").slice(0, n).to_numpy())
            if n == len(batch) or not seen:
                continue
            if top is None:
                U, uid = np.concatenate(seen), np.concatenate(ids)
                top = TopK(U, k, user_chunk)
            if top.done:                                    # the rest are shorter; the stream is read to its end
                continue
            I, iid = _matrix(batch.column("v").slice(n)), batch.column("id").slice(n).to_numpy()
            for lo in range(0, len(I), item_chunk):
                top.add(I[lo:lo + item_chunk], iid[lo:lo + item_chunk])
        if top is not None:
            for lo in range(0, len(uid), USER_BLOCK):
                s, i = top.scores[lo:lo + USER_BLOCK], top.ids[lo:lo + USER_BLOCK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(uid[lo:lo + USER_BLOCK], s.shape[1])), pa.array(i.reshape(-1)), pa.array(s.reshape(-1))],
                    names=["uid", "iid", "score"])

    cand = dealt.mapInArrow(score, "uid bigint, iid bigint, score double")
    w = Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("iid").asc())
    return (cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("uid").alias("user"), "rank", F.col("iid").alias("item"), "score"))


def _vectors(df: DataFrame, key: str, vec: str) -> DataFrame:
    """``(id, v)`` of the rows with a usable vector; floats travel as floats."""
    floats = df.schema[vec].dataType.simpleString() == "array<float>"
    return usable_vectors(df.select(F.col(key).cast("bigint").alias("id"),
                                    (F.col(vec) if floats else F.col(vec).cast("array<double>")).alias("v")))


def _matrix(column) -> np.ndarray:
    """The rows of an Arrow list column as doubles; they must be of one length."""
    size = np.diff(column.offsets.to_numpy())
    if (size != size[0]).any():
        raise ValueError("vectors of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size[0])


def with_history(recs: DataFrame, ratings: DataFrame, user: str, item: str,
                 rating: str | None = None) -> DataFrame:
    """Per user, the recommendations beside what the user already rated,
    for all users in one plan (no per-user jobs), in long form
    ``(user, item, source, rank, score, seen)``.

    Long form keeps a heavy user's history spread over many rows instead of
    one giant array; ``seen`` marks recommended items already in the
    history (a join on the (user, item) pair)."""
    hist = ratings.select(F.col(user).cast("bigint").alias("user"),
                          F.col(item).cast("bigint").alias("item"),
                          (F.col(rating).cast("double") if rating else F.lit(None).cast("double"))
                          .alias("score"))
    pairs = hist.select("user", "item").distinct().withColumn("seen", F.lit(True))
    r = (recs.select(F.col("user").cast("bigint").alias("user"), F.col("item").cast("bigint").alias("item"),
                     F.lit("recommended").alias("source"), F.col("rank").cast("int").alias("rank"),
                     F.col("score").cast("double").alias("score"))
         .join(pairs, ["user", "item"], "left")
         .withColumn("seen", F.coalesce(F.col("seen"), F.lit(False))))
    h = hist.select("user", "item", F.lit("history").alias("source"),
                    F.lit(None).cast("int").alias("rank"), "score", F.lit(True).alias("seen"))
    return r.unionByName(h)
