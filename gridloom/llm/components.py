"""Connected components of a graph given as links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _large(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked with the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, are linked with the least of them. Links go from a to the smaller b."""
    least = stage(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    pairs = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return pairs.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _done(links: DataFrame) -> bool:
    """Whether all links are stars: each node has one smaller neighbour, which has none itself."""
    nodes = links.select(F.col("a").alias("node"), F.lit(1).alias("down")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("down")))
    by_node = nodes.groupBy("node").agg(F.sum("down").alias("down"), F.count_if(F.col("down") == 0).alias("up"))
    return by_node.where("down > 1 OR (down > 0 AND up > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long).  One row (node, component) for each node but the least of its component, which gives the name.

    Each round is written to the shared folder; only whether it was the last
    comes to the driver.  So are the least neighbours, of one row a node: the join
    with them then shuffles both sides, and Spark can split a node of very many
    links.  Links of a node with itself, or with null, don't count.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    links = stage(links.where("a != b").select(a.alias("a"), b.alias("b")).distinct(), "links")
    while not _done(links):
        links = stage(_small(stage(_large(links), "links")), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
