"""Tool chains and the diversity of runs: entropy, coverage, pairs, repetition, comparison."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomspark.functions.text import pattern_hash
from loomspark.operators import graph as G


def chains(steps: DataFrame) -> DataFrame:
    """steps(chain, step, tool): one row for each chain with its tools in order, the set of them and its hash."""
    ordered = steps.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("step", "tool"))).alias("s"))
    out = ordered.select("chain", F.transform("s", lambda x: x["tool"]).alias("path"))
    out = out.withColumn("tools", F.array_sort(F.array_distinct("path")))
    return out.withColumns({"n_steps": F.size("path").cast("long"), "n_tools": F.size("tools").cast("long"), "pattern": pattern_hash(F.col("tools"))})


def entropy(used: DataFrame) -> DataFrame:
    """used(tool): -sum p log2 p; 0 for no rows."""
    counts = used.groupBy("tool").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log2("n")).alias("nl"), F.count("*").alias("distinct_tools"))
    return total.select("distinct_tools", F.coalesce(F.log2("t") - F.col("nl") / F.col("t"), F.lit(0.0)).alias("entropy"))


def pairs(chain_table: DataFrame) -> DataFrame:
    """Distinct unordered tool pairs that chains use together."""
    a = chain_table.select("chain", F.posexplode("tools").alias("i", "a"), "tools")
    return a.select("a", F.explode(F.slice("tools", F.col("i") + 2, F.greatest(F.size("tools") - F.col("i") - 1, F.lit(0)))).alias("b")).distinct()


def metrics(steps: DataFrame) -> DataFrame:
    """One row: chains, tools, entropy, distinct tool sets, repetition, pairs and their share of all pairs."""
    c = chains(steps)
    per = steps.select("chain", "tool").distinct()
    e = entropy(per.select("tool"))
    sets = c.agg(F.count("*").alias("n_chains"), F.countDistinct("pattern").alias("n_patterns"), F.avg(F.when(F.col("n_steps") >= 3, 1.0).otherwise(0.0)).alias("multi_step_rate"), F.avg(F.when(F.col("n_tools") >= 2, 1.0).otherwise(0.0)).alias("multi_tool_rate"))
    p = pairs(c).agg(F.count("*").alias("n_pairs"))
    one = e.join(sets, F.lit(True)).join(p, F.lit(True))
    possible = F.col("distinct_tools") * (F.col("distinct_tools") - 1) / 2
    return one.select("n_chains", "distinct_tools", "entropy", "n_patterns", (1 - F.col("n_patterns") / F.greatest("n_chains", F.lit(1))).alias("repetition"), "n_pairs", F.when(possible > 0, F.col("n_pairs") / possible).otherwise(0.0).alias("pair_ratio"), "multi_step_rate", "multi_tool_rate")


def coverage(used: DataFrame, known: DataFrame) -> DataFrame:
    """Share of known(domain) that used(domain) has."""
    hit = known.distinct().join(used.distinct().withColumn("hit", F.lit(1)), "domain", "left")
    return hit.agg(F.count("hit").alias("used_domains"), F.count("*").alias("known_domains")).withColumn("coverage", F.col("used_domains") / F.greatest("known_domains", F.lit(1)))


def underrepresented(used: DataFrame, known: DataFrame) -> DataFrame:
    """Known tools used as often as the median tool or less, unused ones included."""
    counts = known.join(used.groupBy("tool").agg(F.count("*").alias("uses")), "tool", "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
    median = counts.agg(F.percentile("uses", 0.5).alias("median"))
    return counts.join(F.broadcast(median), F.col("uses") <= F.col("median")).select("tool", "uses")


def steering_weight(uses: Column, decay: float = 1.0) -> Column:
    return 1 / (1 + uses * decay)


def repeated(steps: DataFrame) -> DataFrame:
    """Chains that return to a tool: iterative patterns."""
    return steps.groupBy("chain", "tool").agg(F.count("*").alias("n")).groupBy("chain").agg(F.max("n").alias("most")).select("chain", (F.col("most") > 1).alias("iterative"))


def reward(chain_table: DataFrame, low: int, high: int) -> DataFrame:
    """1 for a length within bounds (else -.5) and .5 for each distinct tool."""
    fits = F.col("n_steps").between(low, high)
    return chain_table.select("chain", (F.when(fits, 1.0).otherwise(-0.5) + 0.5 * F.col("n_tools")).alias("reward"))


def satisfies(chain_table: DataFrame, low: int, high: int, least_tools: int, excluded: list) -> DataFrame:
    ok = F.col("n_steps").between(low, high) & (F.col("n_tools") >= least_tools)
    if excluded:
        ok = ok & ~F.arrays_overlap("tools", F.array(*[F.lit(x) for x in excluded]))
    return chain_table.where(ok)


def duplicates(chain_table: DataFrame) -> DataFrame:
    """Chains whose tool set an earlier chain has."""
    w = Window.partitionBy("pattern").orderBy("chain")
    return chain_table.withColumn("r", F.row_number().over(w)).where("r > 1").select("chain", "pattern")


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two rows of metrics side by side, one row for each metric."""
    names = [c for c in a.columns]
    long = lambda df, col: df.select(F.explode(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("double"))])).alias("metric", col))
    both = long(a, "a").join(long(b, "b"), "metric")
    delta = F.col("b") - F.col("a")
    return both.select("metric", "a", "b", delta.alias("delta"), F.when(delta > 1e-9, "up").when(delta < -1e-9, "down").otherwise("same").alias("direction"))


def steering(domain_uses: DataFrame, available: DataFrame, most: int = 3) -> DataFrame:
    """One row with text: the first domains of available(domain) that domain_uses(domain, uses) has at most as often as the median one."""
    counts = available.distinct().join(domain_uses, "domain", "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
    median = counts.agg(F.percentile("uses", 0.5).alias("median"))
    few = counts.join(F.broadcast(median), F.col("uses") <= F.col("median")).select("domain").orderBy("domain").limit(most)
    picked = few.agg(F.array_sort(F.collect_list("domain")).alias("d"))
    many = F.concat(F.lit("Focus this conversation on tools from these domains: "), F.array_join("d", ", "), F.lit("."))
    one = F.concat(F.lit("Focus this conversation on the "), F.element_at("d", 1), F.lit(" domain."))
    return picked.select(F.when(F.size("d") == 0, "").when(F.size("d") == 1, one).otherwise(many).alias("text"))


def markdown(compared: DataFrame) -> str:
    """The report table of compare(): one line for each metric."""
    rows = [f"| {r['metric']} | {r['a']:.4f} | {r['b']:.4f} | {r['delta']:+.4f} |" for r in compared.orderBy("metric").collect()]  # as many rows as there are metrics
    return "\n".join(["| Metric | Run A | Run B | Delta |", "| --- | --- | --- | --- |", *rows])


def full_reward(steps: DataFrame, edges: DataFrame, low: int, high: int, least_tools: int, required: list, excluded: list) -> DataFrame:
    """steps(chain, step, node, tool, domain): chain, reward: 1 for a length within bounds, .5 for each tool, .3 for each domain, .2 for each
    step along an edge (see graph.in_domains); less .5 for each excluded tool that is there, each required one that isn't, a length out of bounds, too few tools."""
    w = Window.partitionBy("chain").orderBy("step")
    if G.in_domains(edges):
        moved = G.placed(steps, edges).select("chain", "node", F.lead("node").over(w).alias("after"), "_domains", F.lead("_domains").over(w).alias("_after"))
        along = moved.where((F.col("node") != F.col("after")) & F.arrays_overlap("_domains", "_after"))
    else:
        pair = edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct()
        moved = steps.withColumn("after", F.lead("node").over(w)).withColumns({"u": F.least("node", "after"), "v": F.greatest("node", "after")})
        along = moved.where("after IS NOT NULL").join(pair, ["u", "v"])
    walked = along.groupBy("chain").agg(F.count("*").alias("linked"))
    has = lambda t: F.max((F.col("tool") == t).cast("int"))
    faults = sum((has(t) for t in excluded), F.lit(0)) + sum((1 - has(t) for t in required), F.lit(0))
    placed = F.when(F.coalesce(F.col("domain").cast("string"), F.lit("")) != "", F.col("domain"))
    per = steps.groupBy("chain").agg(F.count("*").alias("n"), F.count_distinct("tool").alias("tools"), F.count_distinct(placed).alias("domains"), faults.alias("faults")).join(walked, "chain", "left")
    fits = F.col("n").between(low, high)
    score = F.when(fits, 1.0).otherwise(-0.5) + 0.5 * F.col("tools") + 0.3 * F.col("domains") + 0.2 * F.coalesce("linked", F.lit(0)) - 0.5 * F.col("faults") - F.when(F.col("tools") < least_tools, 0.5).otherwise(0.0)
    return per.select("chain", score.alias("reward"))


def full_constraints(steps: DataFrame, low: int, high: int, least_tools: int, required: list, excluded: list, domains: list | None = None) -> DataFrame:
    """The chains of steps(chain, tool, domain) of an allowed length, with enough tools, all required and no excluded ones, in the domains only."""
    per = steps.groupBy("chain").agg(F.count("*").alias("n"), F.collect_set("tool").alias("tools"), F.collect_set(F.coalesce(F.col("domain").cast("string"), F.lit(""))).alias("domains"))
    listed = lambda values: F.array(*[F.lit(v) for v in values])
    ok = F.col("n").between(low, high) & (F.size("tools") >= least_tools)
    if required:
        ok = ok & (F.size(F.array_except(listed(required), F.col("tools"))) == 0)
    if excluded:
        ok = ok & ~F.arrays_overlap("tools", listed(excluded))
    if domains:
        ok = ok & (F.size(F.array_except("domains", listed([str(d) for d in domains]))) == 0)
    return per.where(ok).select("chain")


#: What steering says, by whether it is domains or tools and one or several.
STEER = {("domain", False): "Focus this conversation on the {} domain.", ("domain", True): "Focus this conversation on tools from these domains: {}.", ("tool", False): "Try to use the {} tool in this conversation.", ("tool", True): "Try to incorporate these tools: {}."}


def steering_prompt(domain_uses: DataFrame, available: DataFrame, tool_uses: DataFrame, known_tools: DataFrame, most: int = 3) -> DataFrame:
    """One row with text: as steering() for the domains; if none is rarely used, the same for tools; else empty.

    domain_uses(domain, uses), available(domain), tool_uses(tool, uses), known_tools(tool). Medians are over the available
    domains, unused ones included, and over the tools that were used.
    """

    def rare(kind: str, uses: DataFrame, known: DataFrame, of_used: bool) -> DataFrame:
        counts = known.distinct().join(uses, kind, "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
        median = (uses if of_used else counts).agg(F.coalesce(F.percentile("uses", 0.5), F.lit(0.0)).alias("median"))
        few = counts.join(F.broadcast(median), F.col("uses") <= F.col("median")).select(F.col(kind).cast("string").alias("x")).orderBy("x").limit(most)  # one row
        names = F.array_sort(F.collect_list("x"))
        said = [F.concat(*[F.array_join(names, ", ") if part == "{}" else F.lit(part) for part in re.split(r"({})", STEER[kind, several])]) for several in (False, True)]
        return few.agg(F.when(F.size(names) == 0, F.lit("")).when(F.size(names) == 1, said[0]).otherwise(said[1]).alias(f"{kind}_text"))

    both = rare("domain", domain_uses, available, False).join(rare("tool", tool_uses, known_tools, True), F.lit(True))
    return both.select(F.when(F.col("domain_text") != "", F.col("domain_text")).otherwise(F.col("tool_text")).alias("text"))


def analysis(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with text: what run b has over run a; both are one row with entropy, distinct_tools, n_patterns and mean_score."""
    names = ("entropy", "distinct_tools", "n_patterns", "mean_score")
    both = a.select(*[F.col(c).alias(f"a_{c}") for c in names]).join(b.select(*[F.col(c).alias(f"b_{c}") for c in names]), F.lit(True))
    gap = lambda c: F.col(f"b_{c}") - F.col(f"a_{c}")
    span = lambda c, f: F.format_string(f"({f} -> {f})", f"a_{c}", f"b_{c}")
    moved = lambda verb, c, f, end: F.concat(F.lit(f"{verb} "), F.format_string(f, F.abs(gap(c))), F.lit(" "), span(c, f), F.lit(end))
    entropy = F.when(gap("entropy") > 0.001, moved("Steering increased tool entropy by", "entropy", "%.4f", ", indicating a more uniform tool distribution.")).when(gap("entropy") < -0.001, moved("Steering decreased tool entropy by", "entropy", "%.4f", ".")).otherwise("Tool entropy was identical between runs.")
    count = lambda c, word, kind: F.concat(F.format_string(f"Steering {word[0]} %d {word[1]} unique {kind} ", F.abs(gap(c))), span(c, "%d"), F.lit("."))
    tools = F.when(gap("distinct_tools") > 0, count("distinct_tools", ("used", "more"), "tools")).when(gap("distinct_tools") < 0, count("distinct_tools", ("used", "fewer"), "tools"))
    combos = F.when(gap("n_patterns") > 0, count("n_patterns", ("produced", "more"), "tool combinations"))
    quality = F.when(gap("mean_score") < -0.01, moved("Quality decreased by", "mean_score", "%.2f", " \u2014 diversity-quality tradeoff observed.")).when(gap("mean_score") > 0.01, moved("Quality increased by", "mean_score", "%.2f", " \u2014 no tradeoff.")).otherwise("Quality was identical \u2014 no tradeoff observed.")
    return both.select(F.concat_ws("\n", entropy, tools, combos, quality).alias("text"))


def run_metrics(steps: DataFrame, records: DataFrame) -> DataFrame:
    """metrics() with the means of records(the four scores; null: not scored; turns, calls): mean_score, each score, avg_turns, avg_tool_calls."""
    dims = ("tool_correctness", "argument_grounding", "task_completion", "naturalness")
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    scored = records.agg(*[mean(d).alias(d) for d in dims], F.round(mean("turns"), 2).alias("avg_turns"), F.round(mean("calls"), 2).alias("avg_tool_calls"))
    scored = scored.withColumn("mean_score", F.round(sum((F.col(d) for d in dims), F.lit(0.0)) / 4, 2)).withColumns({d: F.round(d, 2) for d in dims})
    return metrics(steps).join(scored, F.lit(True))
