"""Connected components of a list of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.workspace import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and the least node (``component``) that it reaches, for nodes with links (``a``, ``b``).

    Each round hangs a node's larger neighbours, then its smaller ones, on the least of
    them, until nothing changes; rounds grow with the logarithm of the longest chain. A
    round is written to the shared folder, so a lost executor costs that round at most.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = materialize(now, "links")
    mark = None
    while True:
        now = materialize(_hang_smaller(_hang_larger(now)), "round")
        stars = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(stars) == mark or not stars[0]:
            break
        mark = tuple(stars)
    own = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return own.unionByName(tops.join(own, "node", "left_anti"))


def _hang_larger(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _hang_smaller(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
