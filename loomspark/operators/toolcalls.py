"""Tool calls within conversations: validity against the catalogue, order of calls and results, the full rubric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomspark.functions import responses as Q


def call_errors(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """calls(conv, pos, endpoint, arguments map) against registry(endpoint, required array): errors of each call.

    An unknown endpoint is one error; of a known one, each required argument that is missing is an error.
    """
    known = registry.select("endpoint", "required", F.lit(True).alias("_known"))
    missing = F.filter(F.coalesce("required", F.array().cast("array<string>")), lambda p: ~F.coalesce(F.map_contains_key("arguments", p), F.lit(False)))
    listed = F.when(F.col("_known").isNull(), F.array(F.lit("unknown endpoint"))).otherwise(F.transform(missing, lambda p: F.concat(F.lit("missing "), p)))
    return calls.join(known, "endpoint", "left").select("conv", "pos", "endpoint", F.array_join(listed, "; ").alias("errors"))


def order_errors(messages: DataFrame) -> DataFrame:
    """messages(conv, pos, role, n_calls; null: not a call): errors of order, counted for each conversation.

    lone_results: tool messages without a call before them in the same turn. unanswered: calls that follow a
    call without a result in between. empty_calls: calls of nothing. calls: messages that call.
    """
    w = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    calls = (F.col("role") == "assistant") & (F.coalesce("n_calls", F.lit(0)) > 0)
    tool = F.col("role") == "tool"
    turn = F.last(F.when(calls, 1).when(F.col("role") == "user", 0), ignorenulls=True).over(w)
    m = messages.select("conv", "pos", "role", "n_calls", calls.alias("calls"), turn.alias("turn"), F.count_if(tool).over(w).alias("results"))
    m = m.withColumn("results_then", F.last(F.when(F.col("calls"), F.col("results")), ignorenulls=True).over(w))
    return m.groupBy("conv").agg(
        F.count_if((F.col("role") == "tool") & (F.coalesce("turn", F.lit(0)) == 0)).alias("lone_results"),
        F.count_if(F.col("calls") & (F.col("results") == F.col("results_then"))).alias("unanswered"),
        F.count_if((F.col("role") == "assistant") & (F.col("n_calls") == 0)).alias("empty_calls"),
        F.count_if("calls").alias("calls"),
    )


def grounded_messages(arguments: DataFrame, outputs: DataFrame) -> DataFrame:
    """arguments(conv, pos, value) and outputs(conv, pos, value): how many messages have a value that an earlier output has."""
    first = outputs.groupBy("conv", "value").agg(F.min("pos").alias("first"))
    return arguments.join(first, ["conv", "value"]).where("first < pos").groupBy("conv").agg(F.countDistinct("pos").alias("grounded"))


def rubric(messages: DataFrame, grounded: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """The four rule-based scores, each from 1 to 5, for messages(conv, pos, role, text, tools array; null or empty: no calls).

    stats(conv, grounded_args) is what the conversations' metadata counts; more than none gives a point.
    """
    point = lambda c: F.when(c, 1).otherwise(0)
    clamp = lambda c: F.greatest(F.lit(1), F.least(F.lit(5), c)).cast("int")
    calls = (F.col("role") == "assistant") & (F.size(F.coalesce("tools", F.array().cast("array<string>"))) > 0)
    asks = (F.col("role") == "assistant") & F.coalesce(F.col("text").contains("?"), F.lit(False)) & ~calls
    tools = F.size(F.array_distinct(F.flatten(F.collect_list(F.when(calls, F.col("tools"))))))
    per = messages.groupBy("conv").agg(F.count_if(calls).alias("calls"), tools.alias("tools"), F.count("*").alias("n"), F.max_by(F.struct("role", calls.alias("calls")), "pos").alias("last"), F.min_by("role", "pos").alias("first"), F.count_if(F.col("role") == "user").alias("users"), F.count_if(asks).alias("asks"))
    per = per.join(grounded, "conv", "left").withColumn("grounded", F.coalesce("grounded", F.lit(0)))
    if stats is not None:
        more = stats.groupBy("conv").agg(F.max(F.col("grounded_args") > 0).alias("counted"))
        per = per.join(more, "conv", "left").withColumn("grounded", F.col("grounded") + point(F.coalesce("counted", F.lit(False))))
    closed = (F.col("last.role") == "assistant") & ~F.col("last.calls")
    scores: dict[str, Column] = {
        "tool_correctness": 3 + point(F.col("calls") >= 2) + point(F.col("tools") >= 2),
        "argument_grounding": 2 + F.col("grounded"),
        "task_completion": 3 + point(closed) + point(F.col("n") >= 3),
        "naturalness": 2 + point(F.col("first") == "user") + point(F.col("users") > 1) + point(F.col("asks") > 0),
    }
    out = per.select("conv", *[clamp(c).alias(k) for k, c in scores.items()])
    return out.withColumn("average", sum((F.col(k) for k in scores), F.lit(0)) / 4.0)


def evaluate(scores: DataFrame, errors: DataFrame, threshold: float = 3.0) -> DataFrame:
    """scores(conv, average) and errors(conv, valid): passed if valid and the average reaches the threshold."""
    return scores.join(errors, "conv").withColumn("passed", F.col("valid") & (F.col("average") >= threshold))


def latest_values(outputs: DataFrame) -> DataFrame:
    """outputs(conv, step, key, value): the value of each key, by last writer, and of each step_N.key."""
    last = outputs.groupBy("conv", "key").agg(F.max_by("value", "step").alias("value"))
    by_step = outputs.select("conv", F.concat(F.lit("step_"), F.col("step").cast("string"), F.lit("."), F.col("key")).alias("key"), "value")
    return last.unionByName(by_step)


def executed(calls: DataFrame, registry: DataFrame, *seed: str) -> DataFrame:
    """calls(conv, pos, endpoint, arguments map) against registry(endpoint, name, method, path, domain, keys array): status, error, data, ids, taken.

    An unknown endpoint is 404. data is the mock response as JSON, in which the arguments come back; ids are its identifiers
    (a key with id, a value like ABC-1234), taken is what later calls may use, with the ids.
    """
    # What is used more than once is a column, as each use of an expression would parse or make it again
    c = calls.join(registry.withColumn("_known", F.lit(True)), "endpoint", "left")
    key = [F.col(x) for x in ("conv", "pos", *seed)]
    made = Q.response(F.col("name"), F.col("method"), F.col("path"), F.col("domain"), F.col("keys"), *key)
    c = c.withColumn("_given", F.coalesce(F.transform_values("arguments", lambda k, v: v.cast("variant")), F.create_map().cast("map<string,variant>")))
    c = c.withColumn("_made", F.when(F.col("_known"), F.try_variant_get(F.parse_json(made), "$", "map<string,variant>")))
    given = F.col("_given")
    data = F.when(F.col("_known"), F.map_concat(F.map_filter("_made", lambda k, v: ~F.map_contains_key(given, k)), given))
    c = c.withColumn("data", F.to_json(data)).withColumn("_data", F.parse_json("data"))
    texts = F.try_variant_get("_data", "$", "map<string,string>")
    c = c.withColumn("ids", F.map_filter(texts, lambda k, v: F.contains(F.lower(k), F.lit("id")) & F.coalesce(v.rlike("^[A-Z]+-[0-9]+$"), F.lit(False))))
    c, ids = c.withColumn("_taken", Q.extracted(F.col("_data"), F.coalesce("keys", F.array().cast("array<string>")))), F.col("ids")
    all_ = F.map_concat(F.map_filter("_taken", lambda k, v: ~F.map_contains_key(ids, k)), ids)
    status, error = F.when(F.col("_known"), 200).otherwise(404), F.when(F.col("_known").isNull(), F.concat(F.lit("Endpoint "), F.col("endpoint").cast("string"), F.lit(" not found")))
    return c.select("conv", "pos", "endpoint", status.alias("status"), error.alias("error"), "data", "ids", all_.alias("taken"))
