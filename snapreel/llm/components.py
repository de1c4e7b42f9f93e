"""Connected components of an edge table, by contraction, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapreel.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a``, ``b``, any
    orderable type); a component is named by one of its nodes.

    Each round every node points to its smallest neighbour if that is smaller
    than itself, pointers are doubled until they reach the roots, and the edges
    are drawn between roots. At least every other node goes per round, so the
    rounds grow with the logarithm of the largest component. Every step is a
    stored table; a node with many edges is summed before it is shuffled.
    """
    maps = []
    edges = staged(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "cc-edges")
    while edges.first() is not None:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        up = staged(up.select("node", F.least("node", "low").alias("parent")), "cc-parents")
        while True:
            over = up.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            up = staged(up.join(over, "parent").select("node", F.col("above").alias("parent"),
                                                       (F.col("above") != F.col("parent")).alias("moved")), "cc-parents")
            if up.where("moved").first() is None:
                break
            up = up.drop("moved")
        up = up.select("node", "parent")
        maps.append(up)
        a = up.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        b = up.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        drawn = edges.join(a, "a").join(b, "b").where(F.col("ra") != F.col("rb"))
        edges = staged(drawn.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cc-edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = maps[0].select("node", F.col("parent").alias("component"))
    for later in maps[1:]:
        step = later.select(F.col("node").alias("component"), "parent")
        found = found.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
    return staged(found, "cc-found")
