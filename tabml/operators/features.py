"""Feature operators (E1-E5): category indexing, one-hot encoding, vector
assembly, and the category map as a table.

The pipeline stages are Spark ML's own (StringIndexer fits every input column
in one pass; encoder and assembler are pure projections).  ``category_map``
exposes the fitted state of an indexer as a distributed table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (IndexToString, OneHotEncoder, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | row in partition


def dense_index(df: DataFrame, order: Sequence[Column], out: str = "index") -> DataFrame:
    """Number the rows 0..N-1 in a total ``order`` without a single-task
    window.

    The table is range-partitioned and sorted by ``order``; each row's
    position inside its partition comes from ``monotonically_increasing_id``,
    and a per-partition offset (a table with one row per partition, so of
    bounded size and safe to broadcast) turns it into the global position.
    The sorted table is checkpointed to the shared checkpoint folder so both
    uses read the same rows and a lost executor does not change them.
    """
    ensure_checkpoint_dir(df.sparkSession)       # the cluster's folder when it names one
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    ordered = ordered.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    sizes = ordered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (ordered.withColumn("_pid", pid)
            .join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + local)
            .drop("_pid", "_off", "_mid"))


def category_map(df: DataFrame, col: str, order: str = "frequencyDesc") -> DataFrame:
    """E5: ``(value, index, n)`` for a categorical column, in StringIndexer's
    order: most frequent first, ties alphabetical (``frequencyDesc``), or
    ``alphabetAsc``.  NULL is not a category (the indexer skips it in fit).
    Numeric columns are indexed as text (E1b)."""
    v = F.col(col).cast("string")
    counts = (df.select(v.alias("value")).filter(F.col("value").isNotNull())
              .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    if order == "frequencyDesc":
        keys = [F.col("n").desc(), F.col("value").asc()]
    elif order == "alphabetAsc":
        keys = [F.col("value").asc()]
    else:
        raise ValueError(f"unsupported order {order!r}")
    return dense_index(counts, keys, "index").select("value", "index", "n")


def indexer(cols: Sequence[str], outs: Sequence[str] | None = None,
            handle_invalid: str = "error", order: str = "frequencyDesc") -> StringIndexer:
    """One multi-column StringIndexer (one fitting pass for all
    columns).  Numeric inputs are indexed by their text form."""
    outs = list(outs or [f"{c}_idx" for c in cols])
    return StringIndexer(inputCols=list(cols), outputCols=outs,
                         handleInvalid=handle_invalid, stringOrderType=order)


def index_by_map(df: DataFrame, col: str, cmap: DataFrame, out: str | None = None,
                 handle_invalid: str = "error") -> DataFrame:
    """E1 for any number of categories: the index of each row's category from
    a :func:`category_map`, by a join.  The labels stay a distributed table:
    nothing is collected, and the plan does not carry them (Spark's indexer
    does both).  The index is the one that the indexer gives.

    A NULL or unknown value fails the job (``error``), drops the row (``skip``) or
    gets the index after the last (``keep``).  Left to Spark's size-checked
    planning: a small map is broadcast, a large one is sort-merged, with skewed
    categories split at run time."""
    out = out or f"{col}_idx"
    m = cmap.select(F.col("value").alias("_value"), F.col("index").cast("double").alias("_index"))
    joined = df.withColumn("_key", F.col(f"`{col}`").cast("string")) \
        .join(m, F.col("_key") == F.col("_value"), "inner" if handle_invalid == "skip" else "left")
    if handle_invalid == "keep":
        index = F.coalesce("_index", cmap.agg(F.count(F.lit(1)).cast("double")).scalar())
    elif handle_invalid == "error":
        index = F.when(F.col("_index").isNotNull(), F.col("_index")).otherwise(F.raise_error(F.concat(
            F.lit(f"unknown value of {col}: "), F.coalesce("_key", F.lit("NULL")))))
    elif handle_invalid == "skip":
        index = F.col("_index")
    else:
        raise ValueError(f"unsupported handle_invalid {handle_invalid!r}")
    return joined.withColumn(out, index).drop("_key", "_value", "_index")


def sparse_slots(df: DataFrame, indexed: Sequence[tuple[str, DataFrame]], numeric: Sequence[str] = (),
                 out: str = "slots", drop_last: bool = True, keep: bool = False) -> DataFrame:
    """E3 + E4 for any number of categories: ``out``, an array of
    ``(slot, value)`` with the values that are not 0, in the slots that the
    assembler gives: ``numeric`` columns first, then the one-hot slots of each
    ``(index column, category map)``, its last category dropped unless
    ``drop_last`` is false.  ``keep``: the indices have one more category, of
    unknown values, and as in :func:`feature_stages` with ``keep`` none is
    dropped (the encoder adds a category of its own for that).  Only the number of
    categories of each map is collected."""
    parts = [F.array(F.struct(F.lit(j).cast("long").alias("slot"), F.col(f"`{c}`").cast("double").alias("value")))
             for j, c in enumerate(numeric)]
    at = len(numeric)
    for c, cmap in indexed:
        n = cmap.count() + (1 if keep else -1 if drop_last else 0)
        index = F.col(f"`{c}`").cast("long")
        parts.append(F.when(index < n, F.array(F.struct((index + at).alias("slot"), F.lit(1.0).alias("value"))))
                     .otherwise(F.array().cast("array<struct<slot:bigint,value:double>>")))
        at += n
    return df.withColumn(out, F.filter(F.concat(*parts), lambda s: s["value"] != 0))


def feature_stages(categorical: Sequence[str], numeric: Sequence[str],
                   handle_invalid: str = "keep", features: str = "features",
                   drop_last: bool = True) -> list:
    """E1 + E3 + E4: indexer -> one-hot (last slot dropped) -> assembler."""
    idx = [f"{c}_idx" for c in categorical]
    vec = [f"{c}_vec" for c in categorical]
    stages = []
    if categorical:
        stages.append(indexer(categorical, idx, handle_invalid))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=drop_last,
                                    handleInvalid="keep" if handle_invalid == "keep" else "error"))
    stages.append(VectorAssembler(inputCols=list(numeric) + vec, outputCol=features,
                                  handleInvalid="error"))
    return stages


def index_to_value(df: DataFrame, index_col: str, out: str = "value",
                   labels: Sequence[str] | None = None) -> DataFrame:
    """Index -> original value, from the column's ML metadata or an
    explicit label list."""
    kw = {"labels": list(labels)} if labels is not None else {}
    return IndexToString(inputCol=index_col, outputCol=out, **kw).transform(df)


def vector_size(df: DataFrame, vec_col: str = "features") -> int:
    """Slots of a vector column by its ML attributes; 0 if they do not say."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    return int(meta.get("num_attrs", sum(len(g) for g in meta.get("attrs", {}).values())))


def vector_columns(df: DataFrame, vec_col: str, size: int | None = None, prefix: str = "f",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Flatten a vector column into double columns (``f0``..), one per slot.
    The number of slots comes from the column's ML attributes; ``size`` is
    needed where there are none, and must agree where there are.  A vector of
    another length fails the job: no slot is dropped or made up."""
    known = vector_size(df, vec_col)
    if size is None and not known:
        raise ValueError(f"column {vec_col!r} does not tell its size: pass it")
    if size is not None and known and known != size:
        raise ValueError(f"column {vec_col!r} has {known} slots, not {size}")
    size = size or known
    arr = vector_to_array(F.col(vec_col))
    whole = F.when((F.size(arr) == size) | arr.isNull(), arr).otherwise(
        F.raise_error(F.concat(F.lit(f"a vector of {vec_col} has not {size} slots but "), F.size(arr).cast("string"))))
    return df.select(*keep, whole.alias("_whole")).select(*keep, *[F.get("_whole", F.lit(i)).alias(f"{prefix}{i}") for i in range(size)])


def feature_names(df: DataFrame, vec_col: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its ML attribute metadata."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    attrs.sort(key=lambda a: a["idx"])
    names = [a.get("name", f"f{a['idx']}") for a in attrs]
    n = meta.get("num_attrs", len(names))
    return names if len(names) == n else [f"f{i}" for i in range(n)]
