"""Chains given a pattern: parallel groups, a branch, a repeated step or a plain sequence.

A made chain is an array of groups of nodes in order; the nodes of a group run side by side. Everything is
keyed by the chain, whose steps are few; of a node's neighbours only the two least are ever kept. Edges may be given
as nodes(node, domain), where all of a domain are joined (see graph.in_domains).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomspark.operators import graph as G

PATTERNS = ("sequential", "parallel", "branch_and_merge", "iterative")


def _singles(nodes: Column) -> Column:
    return F.transform(nodes, lambda x: F.array(x))


def sequences(grouped: DataFrame) -> DataFrame:
    """grouped(chain, groups) with each node in a group of its own."""
    return grouped.select("chain", _singles(F.flatten("groups")).alias("groups"))


def _paths(steps: DataFrame) -> DataFrame:
    return steps.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("step", "node")))["node"].alias("path"))


def parallel(steps: DataFrame, edges: DataFrame) -> DataFrame:
    """Each run of steps that may go together (see graph.parallel_runs) as one group."""
    named = steps.select("chain", "step", "node").join(G.parallel_runs(steps, edges), ["chain", "step"])
    each = named.groupBy("chain", "run").agg(F.array_sort(F.collect_list(F.struct("step", "node")))["node"].alias("nodes"))
    return each.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("run", "nodes")))["nodes"].alias("groups"))


def branched(steps: DataFrame, edges: DataFrame, seed: int = 42) -> DataFrame:
    """The first step whose node has a neighbour besides the next node branches: that neighbour joins the next node.

    Of several the least is taken. Where no step has one, a step with any neighbour, by the hash of chain, step
    and seed, is joined by its least neighbour; a chain without neighbours stays as it is.
    """
    along = Window.partitionBy("chain").orderBy("step")
    following = steps.select("chain", "step", "node", F.lead("node").over(along).alias("next"), F.lead("step").over(along).alias("next_step"))
    options = following.join(G.two_least(edges), "node", "left").withColumn("other", F.get(F.filter("near", lambda x: x != F.col("next")), F.lit(0)))
    lot = F.md5(F.concat_ws(":", F.col("chain").cast("string"), F.col("step").cast("string"), F.lit(str(seed))).cast("binary"))
    branch = F.min(F.when(F.col("other").isNotNull(), F.struct("step", F.col("next_step").alias("at"), "other")))
    spare = F.min(F.when(F.col("near").isNotNull(), F.struct(lot.alias("lot"), F.col("step").alias("at"), F.get("near", F.lit(0)).alias("other"))))
    per = options.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("step", "node"))).alias("s"), branch.alias("b"), spare.alias("f"))
    per = per.select("chain", "s", F.coalesce("b.at", "f.at").alias("at"), F.coalesce("b.other", "f.other").alias("other"))
    groups = F.transform("s", lambda x: F.when(x["step"] == F.col("at"), F.array(x["node"], F.col("other"))).otherwise(F.array(x["node"])))
    return per.select("chain", groups.alias("groups"))


def as_pattern(steps: DataFrame, edges: DataFrame, pattern: str, seed: int = 42) -> DataFrame:
    """chain, groups of steps(chain, step, node; for parallel also domain, params, outputs) in the pattern asked for."""
    if pattern == "parallel":
        return parallel(steps, edges)
    if pattern == "branch_and_merge":
        return branched(steps, edges, seed)
    if pattern not in PATTERNS:
        raise ValueError(f"unknown pattern {pattern!r}: one of {', '.join(PATTERNS)}")
    paths = _paths(steps)
    made = G.repeat_step(paths, seed) if pattern == "iterative" else paths
    return made.select("chain", _singles(F.col("path")).alias("groups"))
