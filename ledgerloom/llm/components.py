"""Connected components as joins: alternating large-star and small-star steps until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum that does not depend on their order."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of the links (u, v).

    Both steps take a minimum per node, with partial sums before the shuffle,
    and join it back to the edges, where the adaptive join splits a node that
    has a large part of all edges. Each step's edges are written and reread.
    """
    edges = cut_lineage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut_lineage(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
