"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathlark.session import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours of a node go to its smallest one; small star: smaller ones, and itself."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
    moved = both.filter("b > a") if large else both
    moved = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` links: root is the smallest node it is connected with.

    A hub of many links reaches its shuffle as one minimum per task; the join that brings the minimum back
    is split by adaptive execution. Each round is stored in the shared folder, so that its lineage ends;
    rounds grow with the logarithm of the longest chain.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    print_of = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    last = tuple(now.agg(*print_of).first())
    while last[0]:
        now = stored(_star(_star(now, True), False), "links")
        seen = tuple(now.agg(*print_of).first())
        if seen == last:
            break
        last = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
