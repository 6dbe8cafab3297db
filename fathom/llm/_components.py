"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm._store import keep


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root on another node."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("hangs")).union(edges.select("b", F.lit(0)))
    seen = ends.groupBy("v").agg(F.sum("hangs").alias("hangs"), F.count("*").alias("n"))
    return seen.filter("hangs > 1 or hangs > 0 and n > hangs").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a long, b long); root is the smallest node reachable.

    Each round hangs neighbours on the smallest one, until all hang on roots; rounds grow with the logarithm of the
    components' depth. The edge table is written after each, so lost executors cost one
    round. Edges of a node to itself are dropped; a node without others is not listed.
    """
    now = keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _settled(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = keep(both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(down, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = keep(hung.filter("a <> b").distinct())
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
