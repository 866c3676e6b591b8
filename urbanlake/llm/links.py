"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.session import stage, unstage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link: the smallest node reachable.

    In a round every node takes its smallest neighbour, chains of such choices are followed to their end by doubling, and
    the links are rewritten between the ends. At least half of the nodes of a component vanish in each round, so the rounds
    grow with the logarithm of its size; a node with many links costs one aggregate. Every round is written to the shared
    folder, and what the rounds before wrote is deleted. Null nodes and links from a node to itself are left out.
    """
    edges = stage(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    label = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "links-up")
        used = [edges, parent]
        if label is None:
            label = parent.select("node", F.col("node").alias("component"))
        elif parent.isEmpty():
            for part in used:
                unstage(part)
            return label
        else:
            used.append(label)
        if parent.isEmpty():
            unstage(edges)
            return label
        while True:
            top = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = stage(parent.join(top, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "links-up")
            used.append(jumped)
            moved = not jumped.where("moved").isEmpty()
            parent = jumped.select("node", "up")
            if not moved:
                break
        label = stage(label.join(parent.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("up", "component").alias("component")), "links-label")
        edges = edges.join(parent.select(F.col("node").alias("a"), F.col("up").alias("_a")), "a").join(parent.select(F.col("node").alias("b"), F.col("up").alias("_b")), "b")
        edges = stage(edges.select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b").distinct(), "links")
        for part in used:
            unstage(part)
