"""Connected components of a graph given as an edge table, by alternating star steps.

Each round points every node of a neighbourhood at its smallest member
(larger nodes, then smaller ones), which converges in about log(nodes) rounds.
Minima are pre-aggregated; a node with very many neighbours is salted, so its
edges are dealt over many tasks. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import salted_join, written


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) from edges (``a``, ``b``).

    One row for each node that has an edge and isn't its component's root.
    Loops, repeated edges and null ends are ignored.
    """
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = written(ends.where("a > b").distinct(), "edges")
    last = None
    for _ in range(most_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_smallest(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        joined = _to_smallest(large)
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b"))).where("a > b").distinct()
        current = written(small, "edges")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                            ).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Edges with ``m``, the smallest of ``a`` and all its neighbours."""
    smallest = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return salted_join(edges, smallest, ["a"], "b", salts=8)
