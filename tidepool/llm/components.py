"""Connected components of a link table, in rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import settled as cut_lineage


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is
    its smallest node.

    Each round hangs every node's neighbours under the smallest of them
    (large-star, then small-star), so a chain of n links needs about log n
    rounds and a star under its smallest node none; every round is two
    aggregations over edges, cut by a reliable checkpoint, and ends the work
    once all edges are stars. Hot nodes are pre-aggregated (``min``) and the
    join back splits under AQE.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a IS NOT NULL AND b IS NOT NULL").distinct())
    loops, edges = edges.where("a = b"), edges.where("a > b")
    while not _stars(edges):
        # large-star: larger neighbours of u go under the smallest of u's neighbours and u
        both = _ends(edges, "u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # small-star: smaller neighbours of u, and u, go under the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = cut_lineage(large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
                            .where("a > b").distinct())
    return (_ends(edges, "node", "component").union(loops).toDF("node", "component")
            .groupBy("node").agg(F.min(F.least("node", "component")).alias("component")))


def _ends(edges: DataFrame, one: str, other: str) -> DataFrame:
    """Both directions of every edge."""
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias(one), F.col("b").alias(other)),
                                          F.struct(F.col("b").alias(one), F.col("a").alias(other)))).alias("e")).select("e.*")


def _stars(edges: DataFrame) -> bool:
    """Does every larger end ``a`` have one edge only, and none to a node below it?"""
    return (_ends(edges, "node", "other").groupBy("node")
            .agg(F.sum(F.expr("int(node > other)")).alias("up"), F.max(F.expr("int(node < other)")).alias("down"))
            .where("up > 1 OR up = 1 AND down = 1").isEmpty())
