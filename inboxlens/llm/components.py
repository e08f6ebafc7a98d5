"""Connected components of an edge table, by hooking and pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a long, b long)``; the component
    is its least node.

    In a round every node points to its least neighbour if that is smaller than itself;
    doubling the pointers takes each to its tree's root, and the edges are redrawn
    between roots.  Only local minima survive a round, at most half of the nodes, so the
    rounds grow with the logarithm of the number of nodes.  All aggregates are minima
    with a map-side part, so a node with very many edges is no hot group.
    """
    left = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = materialise(left.where("a < b").distinct(), "edges")
    found = None
    while not left.isEmpty():
        # Each node's least neighbour that is smaller; a root points to itself.
        point = materialise(
            left.select(F.col("b").alias("node"), F.col("a").alias("to"))
            .unionByName(left.select(F.col("a").alias("node"), F.col("a").alias("to")))
            .groupBy("node").agg(F.min("to").alias("to")), "hook")
        while True:
            up = point.select(F.col("node").alias("to"), F.col("to").alias("next"))
            jumped = materialise(point.join(up, "to").select("node", "to", "next"), "jump")
            moved = jumped.where("next <> to")
            done = moved.isEmpty()
            point = jumped.select("node", F.col("next").alias("to"))
            if done:
                break
        if found is None:
            found = point.select("node", F.col("to").alias("component"))
        else:
            nxt = point.select(F.col("node").alias("component"), F.col("to").alias("next"))
            found = materialise(
                found.join(nxt, "component", "left")
                .select("node", F.coalesce("next", "component").alias("component")), "labels")
        ends = point.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        other = point.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        left = materialise(
            left.join(ends, "a").join(other, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "edges")
    if found is None:
        found = left.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return found
