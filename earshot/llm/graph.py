"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written

#: A table of one minimum per node is broadcast up to this many rows (16 bytes each).
BROADCAST_ROWS = 1_000_000


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): edges with the least neighbour of u. A hot u is one row of the minima; these
    are broadcast if their counted size allows it, else joined by a shuffle join that the
    adaptive planner can split at a hot u (both sides are written tables)."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    if least.count() <= BROADCAST_ROWS:
        least = F.broadcast(least)
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long): root is the least node that it
    can reach. Each step is written to the shared folder, so lineage stays short."""
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    before = None
    while True:
        both = written(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        large = (_with_least(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = written(large, "large")
        small = _with_least(large)
        edges = written(small.select("u", F.col("m").alias("v"))
                        .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                        .distinct(), "edges")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
