"""Connected components of an undirected graph by alternating large and small stars.

Edges are rows (a, b) with a > b. A large star links every larger neighbour of a node to
the node's smallest neighbour; a small star links a node's smaller neighbours, and the node
itself, to the smallest of them. Both keep components and end in stars around each
component's smallest node, after a number of rounds logarithmic in practice.

Minima are stored before they are joined, so that both sides of each join come straight
from a shuffle and adaptive execution can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigris.session import materialize


def _digest(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    below = edges.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("least"))
    # Nodes without a smaller neighbour keep their edges.
    below = materialize(below, "large-star")
    return edges.join(below, "b", "left").select("a", F.coalesce("least", "b").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = materialize(edges.groupBy("a").agg(F.min("b").alias("least")), "small-star")
    moved = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).union(moved)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` that is not its component's smallest."""
    edges = materialize(edges.select("a", "b").filter("a > b").distinct(), "edges")
    before = _digest(edges)
    while before[0]:
        wide = materialize(_large_star(edges).distinct(), "edges")
        edges = materialize(_small_star(wide).distinct(), "edges")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
