"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.common import store


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): for every node of ``edges(a, b)`` the smallest node reachable.

    Each round links every larger neighbour to the smallest neighbour (large
    star), then smaller neighbours and the node itself to the smallest (small
    star); both are a min-aggregate, pre-aggregated before its shuffle, and a
    join that AQE can split, so a hub's neighbours are never gathered in one
    task. The edge table is written to the shared folder each round, which
    cuts lineage. Ends when a round changes nothing; O(log^2 n) rounds.
    NULL ends and self loops are ignored; no edges give an empty table.
    """
    e = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = store(e, "edges")
    state = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == state or now["n"] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select(F.col("b"), F.col("b"))).distinct()
        state = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        e = store(small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).where("a != b").distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
