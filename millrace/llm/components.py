"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialise

#: Times that a node takes over the label of its label in one round; a chain shrinks by two to this power.
JUMPS = 2


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``): the smallest node that can be reached.

    In each round every node points to its smallest neighbour, takes over the pointer of the node it points to, and the links
    are carried over to the nodes pointed to. Rounds end when no link is left. Everything stays in tables; a node with very many
    links is one row after partial aggregation. Links of a node with itself count for nothing, null ends are left out.
    """
    edges = links.select("a", "b").dropna().filter("a <> b").distinct()
    edges = materialise(edges, "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label"))
        points = materialise(points, "points")
        for _ in range(JUMPS):
            further = points.select(F.col("node").alias("label"), F.col("label").alias("next"))
            points = points.join(further, "label").select("node", F.col("next").alias("label"))
        points = materialise(points, "points")
        if labels is None:
            labels = points.withColumnRenamed("label", "component")
        else:
            step = points.select(F.col("node").alias("component"), F.col("label").alias("next"))
            labels = labels.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
        labels = materialise(labels, "labels")
        to_a, to_b = (points.select(F.col("node").alias(c), F.col("label").alias(f"new_{c}")) for c in ("a", "b"))
        moved = edges.join(to_a, "a").join(to_b, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
        edges = materialise(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return labels
