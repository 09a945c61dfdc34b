"""Connected components of a graph of links, without a driver-side or single-task graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(edges: DataFrame) -> DataFrame:
    """Least of each node's neighbours and itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    return least.select(F.col("a").alias("_node"), F.least("a", "_m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's least neighbour instead."""
    both = _both_ways(edges)
    return (
        both.where("b > a")
        .join(_least(both), F.col("a") == F.col("_node"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    below = (
        down.join(least, F.col("a") == F.col("_node"))
        .where("b > m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    own = least.where("_node > m").select(F.col("_node").alias("a"), F.col("m").alias("b"))
    return below.unionByName(own)


def connected(edges: DataFrame) -> DataFrame:
    """`node`, `label` for every node that has an edge (a, b); the label is its least node.

    Large-star and small-star steps in turn until nothing changes; every round is stored. A hub's
    edges are only summed per task, and joined back by keys that Spark can split.
    """
    stars = stored(edges.select("a", "b").where("a <> b").distinct(), "links")
    state = None
    while True:
        stars = stored(_small_star(_large_star(stars)).distinct(), "links")
        mark = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state = mark
    roots = stars.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
