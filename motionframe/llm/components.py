"""Connected components by alternating stars: every join is on one key and every group is reduced before its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionframe.llm.skew import join_sorted
from motionframe.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return join_sorted(both, least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them. Edges run from the larger u to the smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = join_sorted(edges, least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Of edges (u, v): (node, component) for each node that has an edge to another; component is the least node."""
    edges = written(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        edges = written(_small_star(_large_star(edges)), "edges")
        # Done when each u has one edge and no v is a u: all stars.
        roots = edges.select(F.col("v").alias("u")).distinct()
        more = edges.groupBy("u").count().where("count > 1").select("u").union(join_sorted(edges, roots, "u", "left_semi").select("u"))
        if more.isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
