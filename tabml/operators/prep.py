"""Row-level preparation (B1-B14, S1): filters, drops, renames, NULL filling,
ratios, scaling, threshold labels, category grouping.  Each is a Project or
Filter node that Catalyst collapses into the scan's codegen stage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.columns import (category_group, inverted_threshold, safe_ratio,
                                 threshold)

MODEL_OUTPUTS = ("prediction", "probability", "rawPrediction")


def filter_expr(df: DataFrame, predicate: str) -> DataFrame:
    """B1: filter by SQL predicate text; a NULL predicate does not pass."""
    return df.filter(F.expr(predicate))


def filter_key(df: DataFrame, key: str, value) -> DataFrame:
    """B2: key equality, built as a Column (no string concatenation)."""
    return df.filter(F.col(key) == F.lit(value))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; names not in the table are ignored."""
    return df.drop(*cols)


def drop_outputs(df: DataFrame, cols: Iterable[str] = MODEL_OUTPUTS) -> DataFrame:
    """Remove model output columns so the table can be scored again."""
    return df.drop(*[c for c in cols if c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (e.g. to the ``label`` convention)."""
    return df.withColumnsRenamed(dict(mapping))


def ratio(df: DataFrame, out: str, num: str, den: str) -> DataFrame:
    """Ratio column, NULL on a zero or NULL divisor."""
    return df.withColumn(out, safe_ratio(num, den))


def scale(df: DataFrame, col: str, k: float) -> DataFrame:
    """Multiply a column by a constant, replacing it."""
    return df.withColumn(col, F.col(col) * F.lit(k))


def threshold_label(df: DataFrame, out: str, src: str, t, inclusive: bool = True) -> DataFrame:
    """``src >= t -> 1 else 0`` (NULL -> 0)."""
    return df.withColumn(out, threshold(src, t, inclusive))


def inverted_label(df: DataFrame, out: str, src: str, t=0) -> DataFrame:
    """``src > t -> 0 else 1`` (1 means "nothing")."""
    return df.withColumn(out, inverted_threshold(src, t))


def numeric_columns(df: DataFrame) -> list[str]:
    """The numeric columns of a table, for loops over fields."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def fill_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """NULL -> 0 in the named columns.  Only numeric columns are touched;
    named string or boolean columns are left as they are (Spark's rule)."""
    return df.na.fill(0, subset=list(cols))


def group_categories(df: DataFrame, col: str, keep: Iterable[str] = (),
                     groups: Mapping[str, Iterable[str]] | None = None,
                     other: str = "OTHER", out: str | None = None,
                     mapping: DataFrame | None = None) -> DataFrame:
    """Category grouping without a UDF.

    Short lists become one CASE expression.  A large map is given as a
    ``mapping`` table ``(value, group)`` and joined (left, on the value);
    Spark's size-checked broadcast / AQE chooses the join strategy, so a map
    of any size works.  A value listed twice keeps its smallest group, so no
    row is duplicated.  Unmatched values and NULL become ``other``.
    """
    out = out or col
    if mapping is None:
        return df.withColumn(out, category_group(col, keep, groups, other))
    # a map must be a function: one group per value (the smallest, so the
    # choice is deterministic); otherwise the join would duplicate rows
    m = mapping.toDF("_gv", "_gg").groupBy("_gv").agg(F.min("_gg").alias("_gg"))
    joined = df.join(m, F.col(col) == F.col("_gv"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_gg"), F.lit(other))).drop("_gv", "_gg")


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct rows of the projection (partial aggregation map-side)."""
    return df.select(*cols).distinct()
