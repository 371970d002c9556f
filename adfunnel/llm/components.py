"""Connected components of a link table, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the least node of its component.

    Large-star (link each larger neighbour to the least one) and small-star (link the smaller ones to
    the least) alternate until every link goes to a root, after O(log^2 n) rounds.  A round is two
    aggregations with partial sums and two joins on node keys, whose result is written; a star with a third
    of all nodes is a hot join key that AQE splits, and no neighbourhood is ever collected.
    """
    edges = written(links.filter("a != b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                    .distinct(), "links")
    state = None
    while True:
        # large star: from both ends, each larger neighbour joins the least of the neighbourhood
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, F.col("u") == F.col("c"))
                 .select(F.col("m").alias("u"), "v").filter("u != v").distinct())
        # small star: each node's smaller neighbours and itself join the least of them
        low = large.groupBy(F.col("v").alias("c")).agg(F.min("u").alias("m"))
        small = (large.join(low, F.col("v") == F.col("c"))
                 .select(F.col("m").alias("x"), F.explode(F.array("u", "v")).alias("y"))
                 .filter("x != y").select(F.col("x").alias("u"), F.col("y").alias("v")).distinct())
        # a row of the round before gives two at most
        edges = written(small, "links", state and 2 * state[0])
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()
