"""The three jobs: build a catalogue and its graph, generate conversations, evaluate them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions import inference as I
from loomspark.functions import text as X
from loomspark.operators import conversation as C
from loomspark.operators import graph as G
from loomspark.operators import registry as R
from loomspark.operators import sampler, scoring
from loomspark.operators import toolcalls as T
from loomspark.sources import catalogue as S


def build(spark: SparkSession, source: str, out: str, least_score: float = 0.0, endpoint_range: tuple[int, int] = (1, 100), most_edges: int = 50, semantic: float | None = None, most_tools: int | None = None, strict: bool = False) -> DataFrame:
    """Reads JSON definitions below source and saves tools, endpoints, parameters, nodes and edges; returns the manifest.

    Definitions are parsed once; all else reads what is written, what is nested as VARIANT. Types that a definition
    doesn't give are inferred from all that it says. With semantic, endpoints whose texts have this cosine are linked too.
    """

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/_parsed/{name}")
        return spark.read.parquet(f"{out}/_parsed/{name}")

    tools = written(S.tools(S.records(S.scan(spark, source, strict)), most_tools), "tools")
    endpoints = written(S.endpoints(tools), "endpoints")
    parameters = written(S.parameters(endpoints), "parameters")
    guess = I.combine([I.from_name(F.col("name")), I.from_description(F.col("description")), I.from_default(F.col("default")), I.from_enum(F.col("enum_values")), I.from_place(F.col("location"))])
    parameters = parameters.withColumn("_guess", guess).withColumn("type", F.when(F.col("inferred") & (F.col("_guess.confidence") >= 0.3), F.col("_guess.type")).otherwise(F.col("type"))).drop("_guess")
    ends = endpoints.select(F.col("endpoint_id").alias("endpoint"), F.col("tool_id").alias("tool"), "name", "description", "method", "path", F.col("response.has_schema").alias("has_schema"))
    pars = parameters.select(F.col("endpoint_id").alias("endpoint"), "name", "description", "type", "required", "default")
    scored = scoring.tool_scores(tools.select(F.col("tool_id").alias("tool"), "name", "description", "domain"), ends, pars)
    kept = scored.where(F.col("n_endpoints").between(*endpoint_range) & (F.col("score") >= least_score))
    scored_ends = scoring.endpoint_scores(ends, pars).join(kept.select("tool", "domain", F.col("name").alias("tool_name")), "tool")
    tier = X.graph_tier(F.col("score"))
    end_nodes = written(scored_ends.select(F.col("endpoint").alias("node"), F.lit("endpoint").alias("node_type"), "tool", "domain", "name", tier.alias("tier")), "nodes")
    tool_nodes = kept.select(F.col("tool").alias("node"), F.lit("tool").alias("node_type"), "tool", "domain", "name", tier.alias("tier"))
    within = G.same_domain_edges(end_nodes.where("domain <> ''").select("node", "domain", "tier")).withColumn("edge_type", F.lit("same_domain"))
    own = end_nodes.select(F.col("tool").alias("src"), F.col("node").alias("dst"), F.lit(1.0).alias("weight"), F.lit("same_tool").alias("edge_type"))
    edges = own.unionByName(within.select("src", "dst", "weight", "edge_type"))
    more = {}
    if semantic is not None:
        names = parameters.groupBy("endpoint_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "name"))), lambda x: x["name"]).alias("parameters"))
        described = scored_ends.join(names, F.col("endpoint") == F.col("endpoint_id"), "left").select(F.col("endpoint").alias("node"), X.endpoint_text(F.col("name"), F.col("description"), F.col("tool_name"), F.col("method"), F.col("path"), F.coalesce("parameters", F.array().cast("array<string>"))).alias("text"))
        vectors = written(G.embedded(described, "node"), "embeddings")
        linked = G.semantic_edges(vectors, semantic).withColumn("edge_type", F.lit("semantic_similarity"))
        edges, more = edges.unionByName(linked.select("src", "dst", "weight", "edge_type")), {"embeddings": vectors}
    edges = G.prune_by_degree(edges.select("src", "dst", "edge_type", "weight"), most_edges)
    ids = kept.select(F.col("tool").alias("tool_id"))
    kept_ends = endpoints.join(ids, "tool_id", "left_semi")
    S.save(out, tools=kept, endpoints=kept_ends.select("endpoint_id", "tool_id", "name", "description", "method", "path", "response"), parameters=parameters.join(kept_ends.select("endpoint_id"), "endpoint_id", "left_semi"), nodes=end_nodes.unionByName(tool_nodes), edges=edges, **more)
    return S.info(spark, out)


MESSAGES = "array<struct<role:string,content:string,endpoint:string,arguments:map<string,string>>>"


def _sampled(spark: SparkSession, built: str, count: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Chains of the saved graph, and its endpoints with the names that their calls need."""
    named = S.load(spark, built, "nodes").where("node_type = 'endpoint'")
    number = named.select("node", F.xxhash64("node").alias("id"))  # the sampler walks numbers
    edges = S.load(spark, built, "edges").where("edge_type = 'same_domain'").select("src", "dst", "weight")
    a, b = number.toDF("src", "u"), number.toDF("dst", "v")
    numbered = edges.join(a, "src").join(b, "dst").select(F.col("u").alias("src"), F.col("v").alias("dst"), "weight")
    chains = sampler.sample_chains(spark, numbered, named.select(F.xxhash64("node").alias("node"), "domain"), count, seed)
    names = S.load(spark, built, "parameters").where("required").groupBy("endpoint_id").agg(F.array_sort(F.collect_set("name")).alias("parameters"))
    ends = named.join(names, F.col("node") == F.col("endpoint_id"), "left").select(F.xxhash64("node").alias("node"), X.humanize(F.col("name")).alias("name"), F.coalesce("parameters", F.array().cast("array<string>")).alias("parameters"))
    return chains, ends


def _conversations(messages: DataFrame, *keys: str) -> DataFrame:
    """conversation_id, the further keys, and messages in order."""
    turn = F.to_json(F.struct("pos", "role", "content", "endpoint", "arguments")).alias("m")  # maps can't be sorted
    lines = messages.groupBy("chain", *keys).agg(F.array_sort(F.collect_list(F.struct("pos", turn))).alias("ms"))
    return lines.select(F.format_string("chain_%05d", "chain").alias("conversation_id"), *keys, F.transform("ms", lambda x: F.from_json(x["m"], "role string, content string, endpoint string, arguments map<string,string>")).alias("messages"))


def generate(spark: SparkSession, built: str, out: str, count: int, seed: int = 42) -> DataFrame:
    """Samples `count` chains of the saved graph and writes their conversations as JSON lines; returns the messages."""
    S.write_records(_conversations(sampler.generate(*_sampled(spark, built, count, seed), seed)), out, "overwrite")
    return spark.read.schema(f"conversation_id string, messages {MESSAGES}").json(out)


def generate_attempts(spark: SparkSession, built: str, out: str, count: int, seed: int = 42, retries: int = 3) -> DataFrame:
    """As generate(), with retries + 1 conversations for each chain: conversation_id, attempt (from 1), messages.

    Attempt k has the seed seed + k - 1. All are made side by side, as waiting for a verdict would cost a job
    for each round; repair() then takes the first that passes.
    """
    chains, ends = _sampled(spark, built, count, seed)
    made = None
    for k in range(retries + 1):
        one = sampler.generate(chains, ends, seed + k).withColumn("attempt", F.lit(k + 1))
        made = one if made is None else made.unionByName(one)
    S.write_records(_conversations(made, "attempt"), out, "overwrite")
    return spark.read.schema(f"conversation_id string, attempt int, messages {MESSAGES}").json(out)


def repair(attempts: DataFrame, threshold: float = 3.0) -> DataFrame:
    """conversation_id, attempt, passed, reason, messages: the first attempt that is valid and passes, else the last one."""
    keyed = attempts.withColumn("_key", F.struct("conversation_id", "attempt"))
    judged = evaluate(keyed.select(F.col("_key").alias("conversation_id"), "messages"), threshold).select(F.col("conv").alias("_key"), "passed")
    each = keyed.join(judged, "_key", "left").withColumn("passed", F.coalesce("passed", F.lit(False)))
    order = F.struct(~F.col("passed"), F.when(F.col("passed"), F.col("attempt")).otherwise(-F.col("attempt")))
    best = each.groupBy("conversation_id").agg(F.min_by(F.struct("attempt", "passed", "messages"), order).alias("x"))
    return best.select("conversation_id", "x.attempt", "x.passed", F.when(~F.col("x.passed"), "max_retries_exceeded").alias("reason"), "x.messages")


def evaluate(records: DataFrame, threshold: float = 3.0) -> DataFrame:
    """records(conversation_id, messages of generate): errors, the four scores, their average and passed."""
    m = records.select(F.col("conversation_id").alias("conv"), F.posexplode("messages").alias("pos", "m")).select("conv", "pos", "m.*").withColumnRenamed("content", "text")
    call = (F.col("role") == "assistant") & F.col("endpoint").isNotNull()
    said = m.where(call).select("conv", "pos", F.explode(F.map_values("arguments")).alias("value"))
    shown = m.where("role = 'tool'").select("conv", "pos", F.explode(F.regexp_extract_all("text", F.lit("=([^;]*)"), F.lit(1))).alias("value"))
    scores = T.rubric(m.select("conv", "pos", "role", "text", F.when(call, F.array("endpoint")).alias("tools")), T.grounded_messages(said, shown))
    order = T.order_errors(m.select("conv", "pos", "role", F.when(call, 1).alias("n_calls")))
    structure = C.errors(m.select("conv", "pos", "role", "text"))
    valid = structure.join(order, "conv").select("conv", "errors", "calls", (F.col("valid") & (F.col("calls") > 0) & (F.col("unanswered") == 0) & (F.col("lone_results") == 0)).alias("valid"))
    return T.evaluate(scores, valid, threshold)


def report(evaluated: DataFrame) -> DataFrame:
    """How often each dimension has each score, zeros included."""
    return C.histogram(evaluated, ["tool_correctness", "argument_grounding", "task_completion", "naturalness"])


def subset(tools: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """A sample of tools(tool, domain, ...) that gives each domain the same number, and what is left of `most` to any."""
    return R.spread_sample(tools, "domain", "tool", most, seed)
