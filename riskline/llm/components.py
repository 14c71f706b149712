"""Connected components of a distributed edge table by alternating large-star / small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import drop_staged, staged


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); component is the smallest node
    reachable.  Every round is two shuffles of the edges, whose number never grows; a hub
    of any degree is only ever a grouping key of partial aggregates and a skew-splittable
    join key.  The number of rounds grows with the logarithm of the longest chain."""
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    total = None
    for _ in range(max_rounds):
        # large-star: link each larger neighbour to the smallest of the node's neighbourhood
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small-star: link the node and its smaller neighbours to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        e, past = staged(small, "edges"), e
        drop_staged(past)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == total:
            break
        total = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
