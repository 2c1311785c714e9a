"""A fitted decision tree as a column expression, without the library that fitted it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def tree_nodes(spark: SparkSession, path: str) -> dict[int, Row]:
    """The node table of a saved tree, by node number; its size is bounded by the tree's depth."""
    return {r.id: r for r in spark.read.parquet(f"{path.rstrip('/')}/data").collect()}


def _goes_left(split: Row, features: Sequence[str]) -> Column:
    value = F.col(features[split.featureIndex]).cast("double")
    if split.numCategories == -1:
        return value <= F.lit(split.leftCategoriesOrThreshold[0])
    return value.isin(list(split.leftCategoriesOrThreshold))


def _descend(nodes: dict[int, Row], number: int, features: Sequence[str], leaf) -> Column:
    node = nodes[number]
    if node.leftChild < 0:
        return leaf(node)
    left = _descend(nodes, node.leftChild, features, leaf)
    right = _descend(nodes, node.rightChild, features, leaf)
    return F.when(_goes_left(node.split, features), left).otherwise(right)


def _largest(values: Sequence[float]) -> int:
    return max(range(len(values)), key=lambda i: (values[i], -i))


def used_features(nodes: dict[int, Row], features: Sequence[str]) -> list[str]:
    """The features that some node of the tree asks about."""
    asked = {n.split.featureIndex for n in nodes.values() if n.leftChild >= 0}
    return [f for i, f in enumerate(features) if i in asked]


def _guarded(expression: Column, features: Sequence[str]) -> Column:
    """Null unless every feature that the tree asks about is known."""
    if not features:
        return expression
    return F.when(reduce(and_, [F.col(name).isNotNull() for name in features]), expression)


def tree_prediction(nodes: dict[int, Row], features: Sequence[str]) -> Column:
    """The predicted class: the largest count in the row's leaf, the smaller class on ties."""
    return _guarded(_descend(nodes, 0, features, lambda n: F.lit(_largest(n.impurityStats))), used_features(nodes, features))


def tree_score(nodes: dict[int, Row], features: Sequence[str], positive: int = 1) -> Column:
    """The share of class ``positive`` in the row's leaf."""

    def share(node: Row) -> Column:
        total = sum(node.impurityStats)
        return F.lit(node.impurityStats[positive] / total if total else 0.0)

    return _guarded(_descend(nodes, 0, features, share), used_features(nodes, features))


def score_by_rules(df: DataFrame, path: str, features: Sequence[str]) -> DataFrame:
    """Adds ``score`` and ``prediction`` of the tree saved at ``path``.

    The tree becomes nested conditions on plain columns in the row's own projection: only the
    columns that some node asks about are read, no vector is assembled, and a filter on the
    prediction can be reordered with others. Numbers compare as doubles, at or below a
    threshold to the left, as the tree was fitted; a row lacking one of those columns has null. Trees
    of a depth far beyond ten make expressions that no longer compile to one method.
    """
    nodes = tree_nodes(df.sparkSession, path)
    return df.withColumns({"score": tree_score(nodes, features), "prediction": tree_prediction(nodes, features)})
