"""Tree rules that run.

A fitted tree is a table of at most 2^(depth + 1) nodes.  Here it becomes rules
over the *raw* columns, with feature names and category values: one readable
row per leaf, and one column expression that routes every row to its leaf
inside whole-stage codegen, without assembling a vector or calling the model.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .models import tree_nodes

#: Label that an indexer gives to values it does not know (``handleInvalid="keep"``).
UNKNOWN = "__unknown"


@dataclass
class Feature:
    """A slot of the feature vector: its raw column and, for a category, its
    values by index (the last may be :data:`UNKNOWN`)."""

    column: str
    values: list[str] | None = None


def vector_features(df: DataFrame, features: str = "features", sources: Mapping[str, str] | None = None) -> list[Feature]:
    """The slots of an assembled vector from its ML attributes.  ``sources``
    maps an attribute to its raw column; by default a nominal attribute
    ``c_idx`` comes from column ``c`` and any other is its own column."""
    meta = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    out = {}
    for kind, attrs in meta.items():
        for a in attrs:
            name = a.get("name", f"f{a['idx']}")
            values = list(a.get("vals", [])) if kind in ("nominal", "binary") and a.get("vals") else None
            column = (sources or {}).get(name, name.removesuffix("_idx") if values else name)
            out[a["idx"]] = Feature(column, values)
    if sorted(out) != list(range(len(out))) or not out:
        raise ValueError(f"column {features!r} has no complete ML attributes")
    return [out[i] for i in range(len(out))]


def _goes_left(node, feature: Feature) -> tuple[Column, str, str]:
    """(condition, its text, text of its opposite) of an inner node."""
    c = F.col(f"`{feature.column}`")
    if node.left_categories is None:
        t = repr(float(node.threshold))
        return (F.coalesce(c.cast("double") <= F.lit(float(node.threshold)), F.lit(False)),
                f"{feature.column} <= {t}", f"{feature.column} > {t}")
    if feature.values is None:
        ids = [float(v) for v in node.left_categories]
        return F.coalesce(c.cast("double").isin(ids), F.lit(False)), f"{feature.column} in {ids}", f"{feature.column} not in {ids}"
    known = [v for v in feature.values if v != UNKNOWN]
    left = [feature.values[int(i)] for i in node.left_categories]
    text = c.cast("string")
    cond = F.coalesce(text.isin([v for v in left if v != UNKNOWN]), F.lit(False))
    if UNKNOWN in left:
        cond = cond | ~F.coalesce(text.isin(known), F.lit(False))
    right = [v for v in feature.values if v not in left]
    return cond, f"{feature.column} in {sorted(left)}", f"{feature.column} in {sorted(right)}"


def _trees(model, spark: SparkSession) -> dict[int, dict]:
    """Nodes of each tree by id: the model's own bounded state."""
    out: dict[int, dict] = {}
    for r in tree_nodes(model, spark).collect():
        out.setdefault(r.tree, {})[r.node] = r
    return out


def leaf_rules(model, df: DataFrame, features: str = "features", sources: Mapping[str, str] | None = None) -> DataFrame:
    """One row per leaf ``(tree, leaf, node, depth, rule, prediction, n)``:
    leaves are numbered from the left, ``rule`` joins the conditions on the
    way with ``and`` (a tree of one node has the rule ``true``), ``n`` is the
    number of training rows."""
    spark = df.sparkSession
    slots, rows = vector_features(df, features, sources), []
    for tree, nodes in sorted(_trees(model, spark).items()):
        todo, leaf = [(0, ())], 0
        while todo:
            at, path = todo.pop()
            node = nodes[at]
            if node.left is None:
                rows.append((tree, leaf, at, len(path), " and ".join(path) or "true", float(node.prediction), node.n))
                leaf += 1
            else:
                _, yes, no = _goes_left(node, slots[node.feature])
                todo += [(node.right, (*path, no)), (node.left, (*path, yes))]
    return spark.createDataFrame(rows, "tree int, leaf int, node int, depth int, rule string, prediction double, n long")


def leaf_column(model, df: DataFrame, features: str = "features", sources: Mapping[str, str] | None = None,
                tree: int = 0) -> Column:
    """The leaf (as numbered by :func:`leaf_rules`) that a row of raw columns
    falls into, as one expression.  A missing or NaN number goes right, an
    unknown or NULL category goes where the indexer's extra index goes, both
    as in the model."""
    slots = vector_features(df, features, sources)
    nodes = _trees(model, df.sparkSession)[tree]
    number = iter(range(len(nodes)))

    def route(at: int) -> Column:
        node = nodes[at]
        if node.left is None:
            return F.lit(next(number))
        cond, _, _ = _goes_left(node, slots[node.feature])
        left = route(node.left)                    # numbered before the right side
        return F.when(cond, left).otherwise(route(node.right))

    return route(0)


def leaf_summary(rows: DataFrame, leaf: Column, label: str = "label") -> DataFrame:
    """``(leaf, n, mean)`` of raw rows routed by :func:`leaf_column`: one
    aggregate, combined map-side."""
    return rows.groupBy(leaf.alias("leaf")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("mean"))
