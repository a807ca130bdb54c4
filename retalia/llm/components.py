"""Connected components of a distributed edge table, by alternating large and small stars.

Every round replaces edges by edges to the smallest neighbour; rounds are few (the
logarithm of the longest path) and each is a sum by node and a join, written to the shared
folder.  The minima are written before they are joined, so that both sides of the join are
plain scans and a node with very many edges is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retalia.llm.common import stored


def _star(edges: DataFrame, rows: DataFrame, emit_self: bool) -> DataFrame:
    """``rows`` (x, y): y is linked to the smallest neighbour that ``edges`` (x, y) give x."""
    least = edges.groupBy("x").agg(F.min("y").alias("m"))
    least = stored(least.select("x", F.least("x", "m").alias("m")), "star-minima")
    out = rows.join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
    if emit_self:
        out = out.union(least.select("x", F.col("m").alias("y")))
    return out.filter("x != y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge to another; root is the smallest node reached.

    Node ids are longs; edges with a null end are no edges.
    """
    x, y = F.col(a), F.col(b)
    edges = edges.filter(x != y).select(F.greatest(x, y).alias("x"), F.least(x, y).alias("y")).distinct()
    edges = stored(edges, "star-edges")
    before, now = None, _state(edges)
    while now != before and now[0]:
        both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        edges = stored(_star(both, both.filter("y > x"), False), "star-edges")
        edges = stored(_star(edges, edges, True), "star-edges")
        before, now = now, _state(edges)
    return edges.select(F.col("x").alias("node"), F.col("y").alias("root")).union(
        edges.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    )
