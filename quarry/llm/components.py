"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b longs): root is the smallest
    node reachable.  Self-loops and repeated edges are allowed; no edges give no
    rows.  Each star operation is an aggregation and a join on the node, so a
    node with very many neighbours is never gathered in one place; every round
    is written to the shared folder.
    """
    nodes = stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # in a large star every edge leads from a node to a smaller one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                            F.col("m").alias("b"))
        now = stored(small.filter("a <> b").distinct(), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge sets (count and an order-free checksum)."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
