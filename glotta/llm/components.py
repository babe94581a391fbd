"""Connected components by alternating large-star and small-star steps.

Only edges move, grouped by a node.  A hub's edges are pre-aggregated for its
minimum; the minima of hubs come back by a broadcast of bounded size, so no task
gets all edges of one node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, made, settled


def _star(edges: DataFrame, large: bool, n: int = 0) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size")).select("u", F.least("u", "m").alias("m"), "size")
    # only the large step has hubs: in the small one edges are grouped by their greater ends
    out = join_counted(both, least, ["u"], "size", 2 * n) if large else both.join(least, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; component is the least
    node reachable.  ``edges`` has long columns u and v; loops are ignored."""
    since, first = made(), edges
    edges = settled(lambda: first.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", since)
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            break
        before = now
        last = edges
        edges = settled(lambda: _star(_star(last, True, now[0]), False), "edges", since)  # noqa: B023
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
