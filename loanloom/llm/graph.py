"""Connected components of a link table, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.session import materialize


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of ``links(a, b)``.

    A distributed union-find: every round hangs the larger neighbours of a node on its
    smallest one, then each node's smaller neighbours on the smallest of them, until no
    edge changes. The minimum per node is combined before the shuffle, and the edges of a
    hub are split by the adaptive skew join, so no group has to fit one task. Each round
    is a table in the shared folder. Nulls and self links are ignored; an empty table has
    no rows.
    """
    edges = materialize(
        links.where("a <> b").select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        ).distinct(),
        "edges",
    )
    before = None
    for _ in range(rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(
            small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges"
        )
        after = edges.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
