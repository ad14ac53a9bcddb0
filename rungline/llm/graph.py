"""Connected components of a distributed edge list."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rungline.llm import common


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the component's smallest node.

    Alternating stars: every node hands the smallest node it knows to its larger neighbours, then to its smaller
    ones, until nothing changes; the number of rounds grows with the logarithm of the longest chain. Each round is a written table.
    No edges: no rows.
    """
    now = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = common.written(now, "edges")
    seen = _sum(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # each row keeps its own node's link and passes the minimum on to the smaller neighbour
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        now = common.written(small, "edges")
        before, seen = seen, _sum(now)
        if seen == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
