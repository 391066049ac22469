"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize


def connected_components(links: DataFrame, name: str) -> DataFrame:
    """Rows ``node, component`` of all linked nodes from links ``a, b``; a component is named by its smallest node.

    Large-star and small-star turns: every node passes its smallest neighbour on to its other neighbours until all are stars. The links of a turn are
    never more than before it, minima combine before the shuffle, and each turn ends in a scratch table, so no lineage grows and a
    lost executor costs one turn. Only a count and two checksums reach the driver.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, f"{name}-links")
    state = None
    while (now := _state(edges)) != state:
        state = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(smallest, "a")
        small = moved.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = materialize(small.unionByName(smallest.select("a", F.col("least").alias("b"))).distinct(), f"{name}-links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 20))).first())
