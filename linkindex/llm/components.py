"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkindex.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of the edges ``a, b``: the smallest node it can reach.

    In each round every node goes to its smallest neighbour and on to that one's, and the edges are
    drawn anew between the places reached, until none is left. All tables stay distributed; a hub's
    neighbours are reduced before the shuffle. Loops and repeated edges are passed over.
    """
    edges = staged(
        edges.filter("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    steps = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = staged(both.groupBy("a").agg(F.min("b").alias("b"))
                        .select(F.col("a").alias("node"), F.least("a", "b").alias("parent")))
        onward = parent.select(F.col("node").alias("parent"), F.col("parent").alias("onward"))
        step = staged(parent.join(onward, "parent").select("node", F.col("onward").alias("to")))
        steps.append(step)
        edges = staged(
            edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .filter("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = steps[0].withColumnRenamed("to", "component")
    for step in steps[1:]:
        onward = step.select(F.col("node").alias("component"), "to")
        labels = labels.join(onward, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component"))
    return staged(labels)
