"""N-gram Jaccard self-join by chosen paths (operator 4).

A document is the set of its shingles of five consecutive words (all its words
if fewer), lower-cased.  Documents of equal sets form one class, and the join
runs over classes.

*Chosen paths.*  Starting from all sets, a set x goes down a path along each of
its shingles s for which hash(path, s) < 1 / (threshold |x|), so two sets that
are similar enough are expected to share at least one step; the paths divide
the sets by sampled shared shingles.  The scan that makes a set also takes
all its steps, some twenty to a level, so that no set is shuffled for them.  A
bucket of at most ``LIMIT`` sets is
compared by brute force, a larger one is split again, and after ``DEPTH``
splits what is still large is compared block by block.  A pair at the
threshold meets in one run with a probability of at least 1-e^-(1-e^-(1-1/e))
= 0.374 for three splits, and runs are repeated until 1-(1-0.374)^runs reaches
``target``.

Brute force in buckets compares 64-byte MinHash sketches against a bound four
deviations below the threshold, and yields the links of a spanning forest;
their components are candidate groups.  In each, all pairs are then compared
exactly, block by block, so a pair of one group is found even if it met in no
run.  Counting a group's links takes work quadratic in its number of
*different* sets; copies cost nothing.

Null and wordless texts have no shingles and are linked to nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, discard, grams, mix, slices, stored, whole_groups, word_table, words
from .components import components
from .suffix_dedup import with_order

SHINGLE, THRESHOLD, TARGET, DEPTH = 5, 0.8, 0.999, 3
#: Sets of a bucket compared by brute force in one task; and of a block when
#: groups are compared exactly.
LIMIT, BLOCK = 8192, 512
SKETCH = 64
_TOKEN = 48                             # bits of a shingle's hash
_MULTIPLIERS = mix(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
_K = np.uint64(0x9E3779B97F4A7C15)
_TOP = 2.0 ** 64 - 2.0 ** 11            # the largest double below 2**64
_STRIP = 16384


def runs_for(target: float, depth: int) -> int:
    """Runs until a pair at the threshold has met with probability ``target``."""
    met = 1.0
    for _ in range(depth):
        met = 1.0 - math.exp(-met)
    return math.ceil(math.log(1.0 - target) / math.log(1.0 - met))


def shingle_sets(data: np.ndarray, off: np.ndarray, table, powers, k: int):
    """Distinct shingles of each text: (shingles, starts), 48-bit hashes."""
    h, doc, _, _ = words(data, off, table, powers)
    g, doc = grams(h, doc, k)
    keys = np.unique(doc.astype(np.uint64) << np.uint64(_TOKEN) | g >> np.uint64(64 - _TOKEN))
    starts = np.searchsorted(keys >> np.uint64(_TOKEN), np.arange(len(off), dtype=np.uint64))
    return keys & np.uint64((1 << _TOKEN) - 1), starts


def chosen_paths(token: np.ndarray, runs: int, depth: int, threshold: float) -> list:
    """The paths of one non-empty set: ``depth`` levels of (paths, place of the
    path they lead on from in the level above)."""
    limit = np.uint64(min(2.0 ** 64 / (threshold * len(token)), _TOP))
    path, levels = np.arange(1, runs + 1, dtype=np.uint64), []
    for _ in range(depth):
        root = mix(path)
        odd = (root | np.uint64(1))[:, None]
        at, step = [], []
        for lo in range(0, len(token), _STRIP):     # long sets in strips
            strip = token[lo:lo + _STRIP]
            i, j = np.nonzero(odd * strip < limit)
            at.append(i)
            step.append(strip[j])
        at, step = np.concatenate(at), np.concatenate(step)
        path = mix(root[at] + step * _K)
        levels.append((path, at))
    return levels


def sketches(token: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A byte of each of ``SKETCH`` minimum hashes, for non-empty sets."""
    h = mix(token + np.uint64(1))
    out = np.empty((len(starts), SKETCH), np.uint8)
    for j, m in enumerate(_MULTIPLIERS):
        out[:, j] = mix(np.minimum.reduceat(h * m, starts)) >> np.uint64(56)
    return out


def _sets(src: DataFrame, runs: int, k: int, threshold: float) -> DataFrame:
    """uid, fingerprint of the set, size, sketch and paths of each text: of
    level d the paths ``paths<d>`` and their places ``from<d>`` in the level above."""
    lists = [f"{c}{d}" for d in range(1, DEPTH + 1) for c in ("paths", "from")]
    schema = "uid long, low long, high long, n int, sketch binary, " + ", ".join(
        f"{c} array<{'long' if c.startswith('paths') else 'int'}>" for c in lists)

    def run(batches):
        table, powers = word_table(), Powers()
        for whole in batches:
            for batch, data, off in slices(whole, "text"):
                token, starts = shingle_sets(data, off, table, powers, k)
                some = np.flatnonzero(np.diff(starts))
                size = np.diff(starts)[some]
                first = starts[:-1][some]
                if not len(some):
                    continue
                low, high = (np.add.reduceat(mix(token + np.uint64(s)), first) for s in (7, 1 << 50))
                levels = [chosen_paths(token[a:a + m], runs, DEPTH, threshold)
                          for a, m in zip(first.tolist(), size.tolist())]
                arrays = []
                for d in range(DEPTH):
                    bounds = pa.array(np.cumsum([0] + [len(x[d][0]) for x in levels]).astype(np.int32))
                    path, at = (np.concatenate([x[d][c] for x in levels]) for c in (0, 1))
                    arrays += [pa.ListArray.from_arrays(bounds, pa.array(path.view(np.int64))),
                               pa.ListArray.from_arrays(bounds, pa.array(at.astype(np.int32)))]
                sk = sketches(token, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(some)), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)),
                     pa.array(size.astype(np.int32)), pa.array([x.tobytes() for x in sk], pa.binary()), *arrays],
                    names=["uid", "low", "high", "n", "sketch", *lists])

    return src.mapInArrow(run, schema)


def _tokens(src: DataFrame, uids: DataFrame, k: int) -> DataFrame:
    """uid and packed shingles of the documents in ``uids``."""
    def run(batches):
        table, powers = word_table(), Powers()
        for whole in batches:
            for batch, data, off in slices(whole, "text"):
                token, starts = shingle_sets(data, off, table, powers, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([token[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])], pa.binary())],
                    names=["uid", "tokens"])

    return src.join(uids, "uid", "left_semi").select("uid", "text").mapInArrow(run, "uid long, tokens binary")


def _split(rows: DataFrame, sets: DataFrame, depth: int) -> DataFrame:
    """(path, uid, at) of level ``depth`` that lead on from ``rows`` (uid, at)
    of the level above."""
    own = rows.groupBy("uid").agg(F.collect_set("at").alias("above"))          # a document's own paths
    steps = own.join(sets.select("uid", F.col(f"paths{depth}").alias("p"), F.col(f"from{depth}").alias("f")), "uid")
    return steps.select("uid", "above", "f", F.posexplode("p").alias("at", "path")) \
        .filter("array_contains(above, f[at])").select("path", "uid", "at")


def _in_blocks(rows: DataFrame, key: str, size: str, block: int) -> DataFrame:
    """Deal the rows of a large group to all pairs of its blocks: adds ``task``,
    ``mine`` (the row's block) and ``other`` (the block it meets)."""
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    out = rows.withColumn("mine", F.pmod(F.xxhash64("uid"), n).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return out.withColumn("task", F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other")))


def forest(adjacent: np.ndarray) -> np.ndarray:
    """Smallest row linked to each row, over any number of links."""
    label = np.arange(len(adjacent))
    while True:
        near = np.concatenate([np.where(adjacent[i:i + 256], label, len(label)).min(axis=1)
                               for i in range(0, len(label), 256)])
        low = np.minimum(label, near)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _compare_sketches(rows: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) of a spanning forest of each group of ``task``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = math.floor(SKETCH * (threshold - 4 * math.sqrt(threshold * (1 - threshold) / SKETCH)))

    def run(batches):
        for t in whole_groups(batches, "task"):
            task = t.column("task").to_numpy()
            uid, n = t.column("uid").to_numpy(), t.column("n").to_numpy().astype(np.float64)
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
            start = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
            size = np.diff(np.r_[start, len(task)])
            i = start[size == 2]                        # pairs, all at once
            ok = ((sketch[i] == sketch[i + 1]).sum(axis=1) >= least) \
                & (np.minimum(n[i], n[i + 1]) >= threshold * np.maximum(n[i], n[i + 1]))
            a, b = [uid[i[ok]]], [uid[i[ok] + 1]]
            for s, m in zip(start[size > 2].tolist(), size[size > 2].tolist()):
                sk, nn = sketch[s:s + m], n[s:s + m]
                adjacent = np.empty((m, m), bool)
                columns = np.ascontiguousarray(sk.T)
                for lo in range(0, m, 64):
                    same = np.zeros((len(sk[lo:lo + 64]), m), np.uint8)
                    for c in range(SKETCH):
                        same += columns[c, lo:lo + 64, None] == columns[c][None, :]
                    adjacent[lo:lo + 64] = (same >= least) & (np.minimum.outer(nn[lo:lo + 64], nn)
                                                              >= threshold * np.maximum.outer(nn[lo:lo + 64], nn))
                root = forest(adjacent)
                k = np.flatnonzero(root != np.arange(m))
                a.append(uid[s + k])
                b.append(uid[s + root[k]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return rows.select("task", "uid", "n", "sketch").repartition(parts, "task").sortWithinPartitions("task", "uid") \
        .mapInArrow(run, "a long, b long")


def candidates(reps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links among the classes' sets that the chosen paths find."""
    rows = reps.select("uid", F.posexplode("paths1").alias("at", "path"))
    found = None
    for depth in range(1, DEPTH + 1):
        counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        rows = stored(rows.join(counts, "path"), "paths")
        small = rows.filter(F.col("c") <= LIMIT).select(F.col("path").alias("task"), "uid")
        large = rows.filter(F.col("c") > LIMIT)
        last = depth == DEPTH
        if last:
            small = small.unionByName(_in_blocks(large, "path", "c", LIMIT).select("task", "uid"))
        links = stored(_compare_sketches(small.join(reps.select("uid", "n", "sketch"), "uid"), threshold).distinct(), "met")
        found = links if found is None else found.unionByName(links)
        if last or large.isEmpty():
            return found
        rows = _split(large, sets, depth + 1)
    return found


def exact_links(groups: DataFrame, src: DataFrame, k: int, threshold: float) -> DataFrame:
    """``groups``: ``uid``, ``root``.  Compares all sets of a root exactly and
    returns ``uid``, ``root`` (smallest uid of its links' component within the
    comparison) and ``links`` (linked sets there)."""
    parts = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("c"))
    dealt = _in_blocks(groups.join(sizes, "root"), "root", "c", BLOCK)
    rows = dealt.join(_tokens(src, groups.select("uid"), k), "uid").select("task", "uid", "mine", "other", "tokens")

    def run(batches):
        for t in whole_groups(batches, "task"):
            task = t.column("task").to_numpy()
            start = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
            uid, mine, other = (t.column(c).to_numpy() for c in ("uid", "mine", "other"))
            tokens = t.column("tokens")
            out = [], [], []
            for s, e in zip(start.tolist(), [*start[1:].tolist(), len(task)]):
                m = e - s
                sets = [np.frombuffer(x, np.uint64) for x in tokens.slice(s, m).to_pylist()]
                size = np.array([len(x) for x in sets])
                owner = np.repeat(np.arange(m), size)
                _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
                shared = count[number] > 1
                column = (np.cumsum(count > 1) - 1)[number[shared]]
                owner = owner[shared]
                order = np.argsort(column, kind="stable")
                column, owner = column[order], owner[order]
                common = np.zeros((m, m))
                for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
                    a, b = np.searchsorted(column, (lo, lo + 2048))
                    part = np.zeros((m, 2048), np.float32)
                    part[owner[a:b], column[a:b] - lo] = 1.0
                    common += part @ part.T
                union = size[:, None] + size[None, :] - common
                linked = common >= threshold * union - 1e-9
                np.fill_diagonal(linked, False)
                if (mine[s:e] != other[s:e]).any():     # two blocks: only pairs across
                    linked &= mine[s:e][:, None] != mine[s:e][None, :]
                root = forest(linked)
                degree = linked.sum(axis=1)
                at = np.flatnonzero(degree)
                out[0].append(uid[s + at])
                out[1].append(uid[s + root[at]])
                out[2].append(degree[at])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out],
                                             names=["uid", "root", "links"])

    return rows.repartition(parts, "task").sortWithinPartitions("task", "uid") \
        .mapInArrow(run, "uid long, root long, links long")


def _classes(src: DataFrame, k: int, threshold: float, target: float) -> DataFrame:
    """uid, class (smallest uid of its group), links and copies of each uid
    that has shingles."""
    sets = stored(_sets(src, runs_for(target, DEPTH), k, threshold), "sets")
    same = sets.groupBy("low", "high", "n").agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("c"))
    members = stored(sets.select("uid", "low", "high", "n").join(same, ["low", "high", "n"])
                     .select("uid", "rep", "c"), "members")
    reps = stored(sets.join(members.filter("uid = rep").select("uid"), "uid", "left_semi")
                  .select("uid", "n", "sketch", "paths1"), "classes")
    groups = components(candidates(reps, sets, threshold))
    groups = stored(groups.select(F.col("node").alias("uid"), "root")
                    .unionByName(groups.select(F.col("root").alias("uid"), "root").distinct()), "groups")
    linked = stored(exact_links(groups, src, k, threshold), "linked")
    degree = linked.groupBy("uid").agg(F.sum("links").alias("n_links"))
    root = components(linked.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    by_rep = degree.join(root.withColumnRenamed("node", "uid"), "uid", "left") \
        .select(F.col("uid").alias("rep"), F.coalesce("root", "uid").alias("class"), "n_links")
    out = stored(members.join(by_rep, "rep", "left").select(
        "uid", F.coalesce("class", "rep").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("c") - 1).alias("n_copies")), "joined")
    for t in (sets, reps, groups, linked, members):
        discard(t)
    return out


def join(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, target: float = TARGET,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: ``doc_id``, ``class_id`` (smallest id of all
    documents it is linked with, over any number of links), ``n_links``
    (different shingle sets with a similarity of ``threshold`` or more) and
    ``n_copies`` (other documents with the very same set).  A null id is smaller
    than any other; repeated rows are copies of each other."""
    src = with_order(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                                 F.col(f"`{text}`").cast("string").alias("text")))
    ids = src.select("doc_id", F.col("__uid").alias("uid"))
    classes = _classes(src.select(F.col("__uid").alias("uid"), "text"), k, threshold, target)
    out = ids.join(classes, "uid", "left").withColumn("class", F.coalesce("class", "uid"))
    head = ids.select(F.col("uid").alias("class"), F.col("doc_id").alias("class_id"))
    return out.join(head, "class").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                                          F.coalesce("n_copies", F.lit(0)).alias("n_copies"))


def keep_one(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """The rows of ``docs`` without those whose group has an earlier one."""
    src = with_order(docs)
    classes = _classes(src.select(F.col("__uid").alias("uid"), F.col("text").cast("string").alias("text")), k, threshold, target)
    later = classes.filter("class <> uid").select(F.col("uid").alias("__uid"))
    return src.join(later, "__uid", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
