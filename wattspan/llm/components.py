"""Connected components of links, by rounds of joins on the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspan.llm.frames import scratch


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in the links (``a``, ``b``).

    Large-star and small-star rounds: each node first ties its larger neighbours to its smallest one, then itself
    and its smaller ones. Edges never outnumber the links, and the rounds grow with the logarithm of the largest
    component. Every round is written, so a lost executor costs one round at most.
    """
    edges = scratch(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after = scratch(small.filter("u <> v").distinct(), "edges")
        # Done when every edge leads from a leaf to its one root.
        twice = after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
        inner = after.join(after.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").select("u")
        if twice.union(inner).isEmpty():
            roots = after.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return after.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
        edges = after
