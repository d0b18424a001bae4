"""Connected components on DataFrames.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014).  Every step is a grouped minimum,
which combines on the map side, and an equi-join that adaptive execution may
split, so a hub of any degree never gathers in one task.  Rounds are
logarithmic in the diameter for practical graphs; each is written to the shared
scratch folder, so no lineage grows and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeflow.workspace import Workspace


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every neighbour above a node to the least of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return (
        near.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .where("u <> v")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its lower neighbours to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionAll(least.select("u", F.col("least").alias("v"))).where("u <> v").distinct()


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node.

    ``component`` is the least node reachable.  Null ends and self-loops are
    ignored, repeated edges are harmless, an empty edge table gives no rows.
    Nodes without edges are their own component; callers that need them left-join
    this result to their node table (see :func:`label_nodes`).
    """
    spark = edges.sparkSession
    ws = Workspace(spark, "components")
    pair = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a <> b")
    current = ws.stage(pair.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = _fingerprint(current)
    while mark[0]:
        large = ws.stage(_large_star(current), "large")
        small = ws.stage(_small_star(large), "small")
        ws.drop(current, large)
        current, before = small, mark
        mark = _fingerprint(current)
        if mark == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def label_nodes(nodes: DataFrame, edges: DataFrame, node: str = "node", src: str = "src", dst: str = "dst") -> DataFrame:
    """All nodes with their component; an isolated node is its own component."""
    found = connected_components(edges, src, dst)
    return (
        nodes.select(F.col(node).alias("node"))
        .distinct()
        .join(found, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"))
    )
