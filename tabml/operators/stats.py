"""Aggregations.

The reference screens fields with one Spark job per column pair (n^2 jobs).
Here a summary is one aggregate, unpivoted from its one row, and so is a
correlation matrix; of very many columns it is two passes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prep import numeric_columns


def corr_expr(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both values are present
    (each side is masked by the other), NULL and not an error on a constant
    column: cov_pop / (sd_pop(a) * sd_pop(b)) with a guarded divide.  A NaN is a
    value like any other, so it makes the correlation NaN."""
    a_, b_ = F.col(a).cast("double"), F.col(b).cast("double")
    if a == b:
        x = y = a_
    else:
        x, y = F.when(b_.isNotNull(), a_), F.when(a_.isNotNull(), b_)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _unpivot_one_row(row_df: DataFrame, structs: list[Column]) -> DataFrame:
    return row_df.select(F.inline(F.array(*structs)))


#: Columns up to which a correlation matrix is one aggregate of built-in functions.
FUSED_COLUMNS = 16


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None,
                ordered_pairs: bool = True) -> DataFrame:
    """C4: all-pairs correlation in long form ``(col_a, col_b, corr)``: n^2
    rows (both orders and the diagonal), or one per pair without
    ``ordered_pairs``.  As in :func:`corr_expr`, each pair uses the rows where
    both values are present, a pair with a constant side is NULL, and a NaN is
    a value that makes its pairs NaN.

    Up to ``FUSED_COLUMNS`` columns it is one aggregate inside the JVM.  Its
    size is the square of the columns, so wider tables go through the moments
    of Arrow batches (:func:`_wide_corr`), with the same results.
    """
    cols = list(cols or numeric_columns(df))
    if len(cols) > FUSED_COLUMNS:
        return _wide_corr(df, cols, ordered_pairs)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[corr_expr(a, b).alias(f"_{k}") for k, (a, b) in enumerate(pairs)])
    structs = []
    for k, (a, b) in enumerate(pairs):
        both = ((a, b), (b, a)) if ordered_pairs and a != b else ((a, b),)
        structs += [F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"_{k}").alias("corr")) for x, y in both]
    return _unpivot_one_row(row, structs)


def _wide_corr(df: DataFrame, cols: list[str], ordered_pairs: bool) -> DataFrame:
    """:func:`corr_matrix` in two passes at any number of columns.

    One pass gives the column means (shifts that keep the sums accurate), a
    second the masked Gram matrices of every Arrow batch: counts, sums, squares
    and products of all pairs are matrix products.  A task emits one row per
    pair, which Spark adds up, so nothing grows with the rows, and the plan
    does not grow with the columns.
    """
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    shift = [v or 0.0 for v in x.agg(*[F.avg(F.when(~F.isnan(f"_{i}"), F.col(f"_{i}"))) for i in range(len(cols))]).first()]

    def gram(batches):
        m = len(cols)
        total = np.zeros((8, m, m))
        for batch in batches:
            for lo in range(0, batch.num_rows, 65536):
                some = batch.slice(lo, 65536)
                w = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in some.columns], axis=1).astype(np.float64)
                v = np.stack([c.to_numpy(zero_copy_only=False) for c in some.columns], axis=1) - shift
                nan = np.isnan(v) & (w > 0)
                y = np.where(np.isnan(v), 0.0, v)
                sx, sxx, odd = y.T @ w, (y * y).T @ w, nan.T.astype(np.float64) @ w
                total += np.stack([w.T @ w, sx, sx.T, sxx, sxx.T, y.T @ y, odd, odd.T])
        i, j = np.triu_indices(m)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(t[i, j]) for t in total]],
                                         names=["i", "j", *sums_of])

    sums_of = ["n", "sx", "sy", "sxx", "syy", "sxy", "nx", "ny"]
    sums = x.mapInArrow(gram, "i int, j int, " + ", ".join(f"{c} double" for c in sums_of)) \
        .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums_of])
    names = F.array(*[F.lit(c) for c in cols])
    means = F.array(*[F.lit(float(v)) for v in shift])

    def spread(total, square, index):
        """Population variance; 0 within rounding of a constant's square."""
        var = square / F.col("n") - F.pow(total / F.col("n"), F.lit(2))
        return F.when(var > F.lit(1e-18) * F.pow(F.get(means, F.col(index)), F.lit(2)), var)

    corr = F.when(F.col("nx") + F.col("ny") > 0, F.lit(float("nan"))).when(F.col("n") > 0, F.try_divide(
        F.col("sxy") / F.col("n") - F.col("sx") * F.col("sy") / F.pow("n", F.lit(2)),
        F.sqrt(spread(F.col("sx"), F.col("sxx"), "i") * spread(F.col("sy"), F.col("syy"), "j"))))
    out = sums.select("i", "j", corr.alias("corr"))
    if ordered_pairs:
        both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(F.array(
            F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
        out = out.select(F.inline(both), "corr")
    return out.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"), "corr")


def summarize(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, long form
    ``(column, count, mean, stddev, min, max)``, from one aggregate."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_m{i}"),
                 F.stddev_samp(x).alias(f"_s{i}"), F.min(x).alias(f"_lo{i}"),
                 F.max(x).alias(f"_hi{i}")]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("count"),
                        F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("stddev"),
                        F.col(f"_lo{i}").alias("min"), F.col(f"_hi{i}").alias("max"))
               for i, c in enumerate(cols)]
    return _unpivot_one_row(row, structs)


def pivot_sum(df: DataFrame, row: str, col: str, value: str,
              values: Sequence | None = None) -> DataFrame:
    """``row x col`` table of ``sum(value)``.

    Without ``values`` every value of ``col`` becomes a column, NULL among
    them (named ``null``); Spark learns them in a job of its own and refuses
    more than ``spark.sql.pivotMaxValues``.  Passing ``values`` saves that job
    and keeps just those columns.
    """
    pivoted = df.groupBy(row).pivot(col) if values is None else df.groupBy(row).pivot(col, list(values))
    return pivoted.agg(F.sum(value))


def pivot_cells(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """C6 in long form, ``(row, key, sum)``: the cells of the pivot that have
    rows, for any number of values of ``col`` (as text; NULL is ``null``, as the
    dense pivot names it), without learning them first.  One aggregate,
    combined map-side; no group is gathered anywhere."""
    return df.groupBy(F.col(f"`{row}`").alias(row), F.coalesce(F.col(f"`{col}`").cast("string"), F.lit("null")).alias("key")) \
        .agg(F.sum(F.col(f"`{value}`")).alias("sum"))


def pivot_sparse(df: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """C6 beyond ``spark.sql.pivotMaxValues``: ``(row, sums)``, ``sums`` a map from
    each key that the row has to its sum, from :func:`pivot_cells`.  A map is as
    large as its row of the dense table without the empty cells; where a single
    row may have unboundedly many keys, use the cells."""
    cells = pivot_cells(df, row, col, value)
    return cells.groupBy(F.col(f"`{row}`").alias(row)) \
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "sum")))).alias("sums"))


def count_by(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    """Rows per group (``groupBy(..).count()``, partial aggregation
    map-side, so a hot key is pre-counted before the shuffle)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
