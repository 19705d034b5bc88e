"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.sources.scans import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """`node` and `component`, the smallest node reachable, for every node of edges (a, b). Self-links are ignored.

    Each round hooks a node's larger neighbours, then its smaller ones, to the smallest of them, until nothing changes. A
    node with any number of neighbours costs one map-side minimum and one join, which AQE splits; nothing is gathered.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m"))

    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = scratch.write(smallest(both).withColumn("m", F.least("m", "a")))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.write(large.where("a <> b"))
        lower = scratch.write(smallest(large))
        small = large.join(lower, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        after = scratch.write(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct())
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        scratch.drop(now, large, lowest, lower)
        now = after
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(now.select("b", "b").distinct())
        seen = mark
