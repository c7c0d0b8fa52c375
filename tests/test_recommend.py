import re

import numpy as np
from pyspark.sql import functions as F

from tabml.operators import recommend as rc


def _brute(users, items, k):
    out = {}
    for uid, u in users:
        s = sorted(((-float(np.dot(u, v)), iid) for iid, v in items))[:k]
        out[uid] = [(iid, -ns) for ns, iid in s]
    return out


def test_top_k_from_factors_blocked_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    users = [(int(i), rng.normal(size=4).round(2).tolist()) for i in range(37)]
    items = [(int(1000 + i), rng.normal(size=4).round(2).tolist()) for i in range(53)]
    items.append((2000, items[0][1]))            # an exact tie: smaller id wins
    U = spark.createDataFrame(users, "id bigint, features array<double>")
    I = spark.createDataFrame(items, "id bigint, features array<double>")
    want = _brute(users, items, 3)
    for ub, ib in [(1, 1), (3, 4), (7, 2)]:
        got = rc.top_k_from_factors(U, I, 3, user_blocks=ub, item_blocks=ib).collect()
        per = {}
        for r in sorted(got, key=lambda r: (r.user, r.rank)):
            per.setdefault(r.user, []).append((r.item, r.score))
        assert set(per) == set(want)
        for uid, lst in per.items():
            assert [i for i, _ in lst] == [i for i, _ in want[uid]]
            assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(lst, want[uid]))


def test_als_top_k_invariants_and_big_ids(spark):
    big = 2 ** 33
    rows = []
    rng = np.random.default_rng(5)
    for u in range(30):
        for i in rng.choice(40, size=8, replace=False):
            rows.append((big + u, big * 2 + int(i), float(rng.integers(1, 6))))
    r = spark.createDataFrame(rows, "user bigint, item bigint, rating double")
    assert not rc.fits_int(r, "user", "item")
    um = rc.id_map(r, "user", "uid")
    im = rc.id_map(r, "item", "iid")
    assert sorted(x.uid for x in um.collect()) == list(range(30))
    ri = r.join(um, "user").join(im, "item")
    model = rc.fit_als(ri, "uid", "iid", "rating", max_iter=5, seed=1)
    recs = rc.top_k(model, 5).collect()
    per = {}
    for x in recs:
        per.setdefault(x.user, []).append(x)
    assert len(per) == 30
    for lst in per.values():
        lst.sort(key=lambda x: x.rank)
        assert len(lst) <= 5 and len({x.item for x in lst}) == len(lst)
        assert all(a.score >= b.score for a, b in zip(lst, lst[1:]))
    # cold start 'drop': an unknown user gives no row
    unk = spark.createDataFrame([(999, 0)], "uid int, iid int")
    assert model.transform(unk).count() == 0


def test_with_history_long_form(spark):
    ratings = spark.createDataFrame([(1, 10, 4.0), (1, 11, 2.0), (2, 10, 5.0)],
                                    "user bigint, item bigint, rating double")
    recs = spark.createDataFrame([(1, 1, 10, 3.9), (1, 2, 12, 3.0), (2, 1, 11, 4.1)],
                                 "user bigint, rank int, item bigint, score double")
    out = rc.with_history(recs, ratings, "user", "item", "rating").collect()
    hist = sorted((r.user, r.item) for r in out if r.source == "history")
    assert hist == [(1, 10), (1, 11), (2, 10)]
    seen = {(r.user, r.item): r.seen for r in out if r.source == "recommended"}
    assert seen == {(1, 10): True, (1, 12): False, (2, 11): False}


def test_top_k_chunked_scoring_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    users = [(int(i), rng.integers(-2, 3, size=3).astype(float).tolist()) for i in range(23)]
    items = [(int(500 + i), rng.integers(-2, 3, size=3).astype(float).tolist()) for i in range(41)]
    U = spark.createDataFrame(users, "id bigint, features array<double>")
    I = spark.createDataFrame(items, "id bigint, features array<double>")
    want = _brute(users, items, 4)
    got = rc.top_k_from_factors(U, I, 4, user_blocks=2, item_blocks=3, user_chunk=5,
                                item_chunk=3).collect()
    per = {}
    for r in sorted(got, key=lambda r: (r.user, r.rank)):
        per.setdefault(r.user, []).append(r.item)
    assert per == {u: [i for i, _ in lst] for u, lst in want.items()}


def _whole(U, I, ids, k):
    """Every score, its components summed in order; NaN ranks last, ties to the smaller id."""
    with np.errstate(invalid="ignore"):
        S = sum(np.multiply.outer(U[:, j], I[:, j]) for j in range(U.shape[1]))
    S = np.where(np.isnan(S), -np.inf, S)
    order = np.lexsort((np.broadcast_to(ids, S.shape), -S), axis=1)[:, :k]
    return np.take_along_axis(S, order, 1), ids[order]


def test_score_block_equals_all_pairs_bit_for_bit():
    rng = np.random.default_rng(8)
    for n, d, k, chunks in ((3000, 10, 5, (256, 32)), (3000, 10, 5, (4096, 128)), (700, 3, 40, (50, 4)), (9, 2, 20, (4, 2))):
        U, I = rng.normal(size=(300, d)), rng.normal(size=(n, d)) * rng.uniform(0.2, 2, (n, 1))
        I[n // 2:n // 2 + n // 9] = I[:n // 9]                  # equal vectors: ties everywhere
        I[-n // 4:] = I[0] * 1.5                                # and one that very many share
        U[5], U[6], U[7, 0], U[8], U[9] = 0, 1e-200, np.nan, U[8] * 1e150, np.inf
        I[3], I[n // 3, 1], I[n // 3 + 1], I[n // 3 + 2] = 0, np.nan, 1e150, -np.inf
        U[10:200] += 3                                          # most users alike
        ids = np.sort(rng.choice(10 * n, n, replace=False))
        s, i = rc.score_block(U, I, ids, k, *chunks)
        want_s, want_i = _whole(U, I, ids, k)
        assert (s == want_s).all() and (i == want_i).all()


def test_score_block_passes_over_most_pairs(monkeypatch):
    rng = np.random.default_rng(9)
    U, I, scored = rng.normal(size=(500, 6)), rng.normal(size=(20000, 6)), []
    one, whole = rc._pair_scores, rc._merge_all
    monkeypatch.setattr(rc, "_pair_scores", lambda *a: scored.append(len(a[2])) or one(*a))
    monkeypatch.setattr(rc, "_merge_all", lambda *a: scored.append(len(a[0]) * len(a[1])) or whole(*a))
    s, i = rc.score_block(U, I, np.arange(20000), 5)
    want_s, want_i = _whole(U, I, np.arange(20000), 5)
    assert (s == want_s).all() and (i == want_i).all()
    assert sum(scored) < 500 * 20000 / 100


def test_als_blocks_follow_slots_and_ratings(spark, monkeypatch):
    """Half the task slots, as each block more is sent every vector once more; more only by size."""
    r = spark.range(1000).select((F.col("id") % 50).cast("int").alias("u"), (F.col("id") % 37).cast("int").alias("i"),
                                 (F.col("id") % 5).cast("float").alias("r"))
    slots, seen = spark.sparkContext.defaultParallelism, []

    def als(*a, **kw):
        seen.append((kw["numUserBlocks"], kw["numItemBlocks"]))
        return whole(*a, **kw)

    whole = rc.ALS
    monkeypatch.setattr(rc, "ALS", als)
    rc.fit_als(r, "u", "i", "r", rank=2, max_iter=1)
    monkeypatch.setattr(rc, "BLOCK_RATINGS", 90, raising=False)
    rc.fit_als(r, "u", "i", "r", rank=2, max_iter=1)
    rc.fit_als(r, "u", "i", "r", rank=2, max_iter=1, blocks=3)
    half = max(2, slots // 2)
    assert seen == [(half, half), (max(half, 12), max(half, 12)), (3, 3)]


def test_ratings_are_joined_once_per_holdout(spark, monkeypatch):
    from tabml.plans import catalog
    kept, prepared = [], catalog.mo.prepared
    monkeypatch.setattr(catalog.mo, "prepared", lambda df, *a: kept.append(df.columns) or prepared(df, *a))
    row = catalog.rating_holdout(spark, "/root/testdata/sf0.001").first()
    assert kept == [["user", "item", "rating"]]
    assert row.n == row.scored + row.unknown_user + row.unknown_item + row.unknown_both and 0 < row.mae <= row.rmse


def _kept_levels(spark):
    return {int(i): r.getStorageLevel() for i, r in dict(spark.sparkContext._jsc.getPersistentRDDs()).items()}


def test_fits_keep_ratings_and_blocks_on_disk(spark, monkeypatch):
    """Blocks are built in arrays that Spark does not account for: what is kept must leave the heap to them."""
    from tabml.plans import catalog
    before, seen, whole = set(_kept_levels(spark)), [], rc.ALS

    def als(*a, **kw):
        levels = _kept_levels(spark)
        seen.append([levels[i].useMemory() for i in levels if i not in before])
        return whole(*a, **kw)

    monkeypatch.setattr(rc, "ALS", als)
    catalog.rating_holdout(spark, "/root/testdata/sf0.001")
    r = spark.range(400).select((F.col("id") % 50).cast("int").alias("u"), (F.col("id") % 37).cast("int").alias("i"),
                                F.lit(1.0).alias("r"))
    model = rc.fit_als(r, "u", "i", "r", rank=2, max_iter=2)
    assert len(seen) == 2 and all(seen) and not any(sum(seen, []))
    after = _kept_levels(spark)
    left = {i for i in after if i not in before}
    assert model.userFactors.count() == 50 and left and not any(after[i].useMemory() for i in left)


def test_users_leave_when_no_item_left_is_long_enough():
    rng = np.random.default_rng(10)
    U, I = rng.normal(size=(200, 3)), rng.normal(size=(5000, 3))
    ids = np.arange(5000)
    order = np.argsort(-np.linalg.norm(I, axis=1))
    top, met = rc.TopK(U, 5, 64), 0
    while not top.done:
        at = order[met:met + 100]
        top.add(I[at], ids[at])
        met += 100
    want_s, want_i = _whole(U, I, ids, 5)
    assert met < 2500 and (top.scores == want_s).all() and (top.ids == want_i).all()


def test_top_k_parts_users_only_as_far_as_they_fit(spark, monkeypatch):
    """Users are not copied to blocks of items while they fill the slots by themselves."""
    rng = np.random.default_rng(12)
    V = rng.integers(-3, 4, size=(3000, 3)).astype(float)
    U = spark.createDataFrame([(int(i), V[i].tolist()) for i in range(400)], "id bigint, features array<double>")
    I = spark.createDataFrame([(int(i), V[i].tolist()) for i in range(3000)], "id bigint, features array<float>")
    monkeypatch.setattr(rc, "LEAST_USERS", 400 // spark.sparkContext.defaultParallelism)
    monkeypatch.setattr(rc, "ITEM_BLOCK", 100)
    got = rc.top_k_from_factors(U, I, 4)
    copies = re.findall(r"explode\(sequence\(0, (\d+)", got._jdf.queryExecution().analyzed().toString())
    assert sorted(map(int, copies)) == [0, spark.sparkContext.defaultParallelism - 1]
    want_s, want_i = _whole(V[:400], V, np.arange(3000), 4)
    for r in got.collect():
        assert (r.item, r.score) == (want_i[r.user, r["rank"] - 1], want_s[r.user, r["rank"] - 1])
