"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))), F.bit_xor(F.xxhash64("v", "u"))).head())


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node, root for every node of links(u, v); root is the least node of its component.

    Large star: each node passes its larger neighbours to the least node around it. Small star: each node
    passes its smaller neighbours and itself to the least of them. Both keep components and end in stars
    around the least nodes, after a number of rounds that grows with the logarithm of the diameter. Every
    step is a minimum by key (summed within tasks first) and a join, which adaptive execution splits at a
    hot node; each round is written to the shared folder.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stage(edges, "edges")
    before = _state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.withColumnRenamed("m", "v")).where("u <> v").distinct()
        edges = stage(small, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
