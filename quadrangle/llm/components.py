"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): root is the smallest node reachable.

    Each step keeps at most as many links as before; a component becomes a star
    in a logarithmic number of rounds. Nodes with very many links are reduced by
    partial minima before the shuffle, and the join back is an ordinary
    equi-join whose large partitions Spark may split.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    state = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(edges.join(least, "a").where("m <> a").select("a", F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = materialize(small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), "star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node").union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now
