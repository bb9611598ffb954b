"""Connected components of an edge table, distributed and restartable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``, root being the component's least node.

    Alternating large-star and small-star steps: a logarithmic number of rounds,
    each one grouping by key; every round is written, so a lost executor costs
    one round. An empty edge table gives an empty result; null ends are ignored.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    now = stored(pairs, "edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    before = None
    while True:
        large = _star(now, larger=True)
        small = stored(_star(large, larger=False), "edges")
        state = small.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(state) == before:
            break
        before, now = tuple(state), small
    # stars now: every edge leads from a node to its root
    return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's larger (or else smaller-or-equal) neighbours to its least neighbour; edges lead downwards (u > v)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not larger:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()
