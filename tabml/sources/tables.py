"""Scans (A1, A2): typed CSV / glob scans and the parquet test tables."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


#: Tables read from elsewhere for the time of :func:`using`.
_INSTEAD: dict = {}


@contextlib.contextmanager
def using(sources: dict):
    """Within it, the named tables are read from CSV files (A1, A2), so that
    every query and job runs on them: ``{table: path or glob}``, or
    ``{table: (path, schema)}``, which spares the pass that infers types."""
    unknown = sorted(set(sources) - set(TABLES))
    if unknown:
        raise ValueError(f"unknown tables {unknown}")
    before = dict(_INSTEAD)
    _INSTEAD.update(sources)
    try:
        yield
    finally:
        _INSTEAD.clear()
        _INSTEAD.update(before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one of the driver tables, or what :func:`using` names in
    its place.  Parquet keeps filter pushdown, column pruning and the
    vectorized reader."""
    if name in _INSTEAD:
        path, schema = _INSTEAD[name] if isinstance(_INSTEAD[name], tuple) else (_INSTEAD[name], None)
        return read_csv(spark, path, schema=schema)
    return spark.read.parquet(table_path(sf_dir, name))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, glob: str | None = None) -> DataFrame:
    """CSV scan with a header row (A1).  ``path`` may be a file, a folder or a
    glob such as ``.../part-r-*.csv`` (A2); all matches form one table.

    Types come from ``schema`` when given.  Inference (an extra full pass over
    the files) is only the fallback, as in the reference's readers.
    """
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.csv(path)


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: StructType | str | None = None, **options) -> DataFrame:
    """Generic scan: parquet by default, CSV when the path says so."""
    fmt = fmt or ("csv" if ".csv" in path else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, schema=schema, **options)
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)
