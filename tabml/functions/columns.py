"""Column expressions.  All of them are Catalyst expressions (JVM side, inside
whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


#: What a NULL key is hashed as.
NULL_KEY = "\x1eNULL"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(key, buckets: int = 10000) -> Column:
    """Stable bucket of a key: the first 32 bits of md5(key as text), mod
    ``buckets``.  It depends on the key alone, never on partitioning or on a
    random generator, so a split made from it is reproducible, survives task
    retries, and the same number comes out of any SQL engine with md5.

    ``key`` may be a list of columns (joined with a unit separator before
    hashing), e.g. a row-unique key when one group key is too heavy.  A NULL
    key is hashed as a fixed text, so it has a bucket like any other."""
    def text_of(k):
        return F.coalesce(_c(k).cast("string"), F.lit(NULL_KEY))

    if isinstance(key, (list, tuple)):
        text = F.concat_ws("\x1f", *[text_of(k) for k in key])
    else:
        text = text_of(key)
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10)
    return (h.cast("bigint") % F.lit(buckets)).cast("bigint")


def safe_ratio(num, den) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise on plain /)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def threshold(c, t, inclusive: bool = True) -> Column:
    """1 when c >= t (or c > t), else 0.  NULL gives 0."""
    cond = _c(c) >= F.lit(t) if inclusive else _c(c) > F.lit(t)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def inverted_threshold(c, t) -> Column:
    """0 when c > t, else 1 (1 = "nothing happened").  NULL gives 1."""
    return F.when(_c(c) > F.lit(t), F.lit(0)).otherwise(F.lit(1))


def category_group(c, keep: Iterable[str], groups: Mapping[str, Iterable[str]] | None = None,
                   other: str = "OTHER") -> Column:
    """Native CASE form of a grouping map: values in ``keep`` stay, values in
    ``groups[name]`` become ``name``, anything else (NULL too) becomes
    ``other``.  Catalyst folds it into the projection; for maps too large for
    an IN list, join against a mapping table instead (see
    :func:`tabml.operators.prep.group_categories`)."""
    col = _c(c)
    expr = F.when(col.isin(list(keep)), col)
    for name, members in (groups or {}).items():
        expr = expr.when(col.isin(list(members)), F.lit(name))
    return expr.otherwise(F.lit(other))


def dot(a, b) -> Column:
    """Inner product of two equal-length numeric arrays (higher-order
    functions, evaluated in the JVM)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def sq_norm(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda acc, v: acc + v * v)


def sq_dist(a, b) -> Column:
    """Squared Euclidean distance of two equal-length arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)
