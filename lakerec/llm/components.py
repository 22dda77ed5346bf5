"""Connected components of an edge table by alternating star contraction, without collecting edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerec.session import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Hang each node's neighbours (the larger ones, or the smaller ones with the node) on its least neighbour."""
    pairs = _both_ways(edges)
    if smaller_only:
        pairs = pairs.where("b <= a")
    least = pairs.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
    joined = pairs.join(least, "a")
    if smaller_only:
        hung = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
        hung = hung.union(least.select("a", F.col("least").alias("b")))
    else:
        hung = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.where("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and two order-free checksums of a stored edge table."""
    mark = F.xxhash64("a", "b")
    return tuple(
        edges.agg(F.count("*"), F.sum(mark.bitwiseAND((1 << 31) - 1)), F.sum(F.shiftrightunsigned(mark, 33))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the component's least node.

    Each node is joined with the least of its neighbours only, found by a reduction before the shuffle; a hot node's
    rows are a plain join that adaptive execution splits. The number of rounds grows with the logarithm of the
    longest path. An empty table gives an empty table.
    """
    clean = edges.select("a", "b").where("a is not null and b is not null")
    nodes = _both_ways(clean).select("a").distinct()
    edges = stored(clean.where("a != b").distinct(), "edges")
    before = _state(edges)
    while True:
        edges = stored(_stars(_stars(edges, smaller_only=False), smaller_only=True), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return nodes.join(roots, "a", "left").select(F.col("a").alias("node"), F.coalesce("root", "a").alias("root"))
