"""Connected components by alternating large-star and small-star steps, as joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm._common import written


def components(edges: DataFrame, at: str, max_rounds: int = 50) -> DataFrame:
    """edges (a, b) of longs -> (node, component): the smallest node that each node reaches.

    Every step hangs each node's neighbours on its smallest one. Nodes of any degree are handled by
    a partial minimum and a join; no neighbour list is built. Loops, repeats and no edges are fine.
    """
    links = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{at}/0")
    for k in range(1, max_rounds + 1):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(lower.select("a", F.col("m").alias("b"))).distinct()
        links = written(small, f"{at}/{k}")
        # done when every node hangs on one root and no root hangs on another
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("root")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("root")))
        if ends.groupBy("node").agg(F.sum("hangs").alias("h"), F.max("root").alias("r")).where("h > 1 or (h = 1 and r = 1)").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
