"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.staging import stage


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u long, v long); root is the smallest node reachable.

    Links go both ways; self-links and repeats are ignored; an empty table gives an empty one.
    Each round is two joins with a table of one row per node. Where a hub's rows all meet, in the large star, that table is written, so that
    the adaptive skew join can split them (which it can't where the table is an aggregation by the join's key); the rounds grow with the
    logarithm of the longest chain.
    """
    edges = stage(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    seen = _digest(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest-neighbours")
        large = both.filter("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))  # no hubs here: what a node points to now are minima
        small = large.join(low, "u").select(F.explode(F.expr("array(struct(u, m as v), struct(v as u, m as v))")).alias("e"))
        edges = stage(small.select("e.u", "e.v").filter("u <> v").distinct(), "small-star")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    low = edges.groupBy("u").agg(F.min("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return low.withColumnRenamed("u", "node").unionByName(roots.join(low, roots.node == low.u, "left_anti"))
