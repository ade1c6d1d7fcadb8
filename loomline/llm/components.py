"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import checkpointed


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the stored ``edges`` ``(a, b)``; root is the smallest node.

    Alternates two rewritings of the edges, each one shuffle per node: every node sends its
    larger neighbours to its smallest one, then its smaller ones. Ends when all edges are
    stars. No component is ever gathered in one place; rewritten edges are stored each round.
    """
    current = edges.select("a", "b").where("a <> b")
    previous = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # (node, smaller neighbour) -> link the smaller neighbours and the node to the least of them
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        current = checkpointed(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        )
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == previous:
            break
        previous = state
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
