"""Connected components by alternating large-star and small-star, each round written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amplicore.llm._common import stored


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id that an edge (a, b) with different ends names.

    Large-star ties each node's larger neighbours to its smallest neighbour, small-star its smaller ones; both only need a
    minimum by node, which is partly aggregated before its shuffle. Rounds go on until the edges no longer change, at
    the latest after about the square of the logarithm of the longest path.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = stored(e, "edges"), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
