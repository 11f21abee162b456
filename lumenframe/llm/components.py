"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.base import stage


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to ``node``, ``root``: each node that is not the smallest of its
    component with that smallest node. Links to itself and repeated links do no harm.

    Every step takes minima per node, which combine before the shuffle, and joins them back;
    only the number and an order-free hash of the links reach the driver. The number of steps
    grows with the logarithm of the longest chain.
    """
    lo, hi = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    edges = stage(links.where(F.col("a") != F.col("b")).select(hi, lo).distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(moved.select("a", F.col("m").alias("b")))
        edges = stage(small.where("a > b").distinct(), "links")
