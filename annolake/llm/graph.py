"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node id reachable.

    Each step points nodes at the smallest neighbour and halves chains, so the number of steps grows with the
    logarithm of the longest chain. A hub with very many neighbours is a join key, never a collected group. Every
    step is written to the shared folder. Self links are ignored; no edges: no rows.
    """
    e = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    while True:
        # done when every edge leads from a node with no other edge straight to a root
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), (F.col("u") != F.col("v")).cast("int")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty():
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u or v = m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        e = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(small.select("u", F.col("m").alias("v"))).distinct()
        e = stored(e, "edges")
    up = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return up.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
