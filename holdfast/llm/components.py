"""Connected components of an edge table by repeated contraction.

Every node points to its smallest neighbour (or itself), pointers are doubled until each names the root of its
tree, and the edges are rewritten between roots. At least half of the nodes that still have an edge vanish in a
round. Neighbours are combined as minima before the shuffle, so no node's neighbour list is ever gathered, and all
joins are plain equi-joins over stored tables, which adaptive execution can split at a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import materialize


def _follow(pointers: DataFrame) -> DataFrame:
    """Double the pointers (node, root) until every one names a root."""
    while True:
        up = pointers.select(F.col("node").alias("root"), F.col("root").alias("up"))
        doubled = materialize(
            pointers.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "pointers"
        )
        pointers = doubled.select("node", "root")
        if doubled.filter("moved").isEmpty():
            return pointers


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b): root is the smallest node reachable. Self-loops are allowed."""
    edges = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    result: DataFrame | None = None
    while result is None or not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")).select("e.*")
        pointers = ends.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("root"))
        pointers = _follow(materialize(pointers, "pointers"))
        if result is None:
            result = pointers
        else:
            step = pointers.select(F.col("node").alias("root"), F.col("root").alias("up"))
            result = materialize(result.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        a = pointers.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = pointers.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(a, "a").join(b, "b").filter("ra <> rb")
        edges = materialize(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    return result
