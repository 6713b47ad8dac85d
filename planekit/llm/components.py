"""Connected components of a distributed edge list, by alternating stars.

Each round joins the edges with the smallest neighbour of each node; minima
are aggregated map-side, so a hub's edges never meet in one task, and the join
is between two plain shuffles that AQE can split.  Every round is written to
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.session import cut_lineage


def _smallest(edges: DataFrame) -> DataFrame:
    return cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to its smallest neighbour (or to it)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = both.join(_smallest(both), "u").where(F.col("v") > F.col("u"))
    return cut_lineage(out.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``u > v`` on every edge: smaller neighbours, and the node, point to the smallest."""
    small = _smallest(edges)
    rest = edges.join(small, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return cut_lineage(rest.unionByName(small.withColumnRenamed("m", "v")).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` from ``u, v`` (longs): the smallest node reachable, for every node with an edge."""
    edges = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct())
    while True:
        edges = _small_star(_large_star(edges))
        # done when every node has one edge and no root has one
        inner = edges.select(F.col("v").alias("u")).distinct().join(edges, "u", "left_semi")
        twice = edges.groupBy("u").count().where("count > 1").select("u")
        if inner.unionByName(twice).isEmpty():
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
