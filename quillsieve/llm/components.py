"""Connected components of an edge table, by alternating large and small stars.

Every round is aggregations and joins on the edges left (no node's neighbours are collected);
each round's edges are written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.tables import Scratch


def connected(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node with an edge the smallest node it can reach.

    Self loops, repeated edges and both directions are allowed; an edge with a null is none.
    An empty table gives an empty one.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = scratch.cut(e, "edges")
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen or not now[0]:
            break
        seen = tuple(now)
        both = e.select(F.col("u").alias("n"), F.col("v").alias("m")).union(e.select("v", "u"))
        low = both.groupBy("n").agg(F.min("m").alias("low")).select("n", F.least("n", "low").alias("low"))
        large = both.join(low, "n").where("m > n").select(F.col("m").alias("u"), F.col("low").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("low"))
        pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct(F.col("u").alias("u"), F.col("low").alias("v"))))
        after = large.join(small, "u").select(pairs.alias("p")).select("p.u", "p.v").where("u != v").distinct()
        before, e = e, scratch.cut(after, "edges")
        scratch.drop(before)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())
