"""Conversations: structural validation, judging, metadata, reports, role transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

ROLES = ("user", "assistant", "tool")


def structure(messages: DataFrame) -> DataFrame:
    """messages(conv, pos, role, text): the role and position before, and the nearest user message before (as of)."""
    w = Window.partitionBy("conv").orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return messages.select("conv", "pos", "role", F.lag("role").over(w).alias("previous_role"), F.last(F.when(F.col("role") == "user", F.col("pos")), ignorenulls=True).over(before).alias("user_before"))


def errors(messages: DataFrame) -> DataFrame:
    """Errors of each conversation, in a fixed order; valid if there are none."""
    s = structure(messages).join(messages.select("conv", "pos", "text"), ["conv", "pos"])
    per = s.groupBy("conv").agg(
        F.count("*").alias("n"), F.min_by("role", "pos").alias("first"), F.max_by("role", "pos").alias("last"),
        F.count_if(F.col("role") == "assistant").alias("assistants"),
        F.count_if(~F.col("role").isin(*ROLES)).alias("unknown"),
        F.count_if((F.col("role") == "user") & (F.col("previous_role") == "user")).alias("user_runs"),
        F.count_if((F.col("role") == "user") & (F.trim(F.coalesce("text", F.lit(""))) == "")).alias("empty"),
    )
    listed = F.array_compact(F.array(F.when(F.col("first") != "user", F.lit("first message is not from the user")), F.when(F.col("last") != "assistant", F.lit("last message is not from the assistant")), F.when(F.col("assistants") == 0, F.lit("no assistant message")), F.when(F.col("unknown") > 0, F.lit("unknown role")), F.when(F.col("user_runs") > 0, F.lit("consecutive user messages")), F.when(F.col("empty") > 0, F.lit("empty user message"))))
    return per.select("conv", F.array_join(listed, "; ").alias("errors"), (F.size(listed) == 0).alias("valid"))


def metadata(messages: DataFrame) -> DataFrame:
    return messages.groupBy("conv").agg(F.count("*").alias("n_turns"), F.countDistinct("role").alias("n_roles"), F.sum(F.length("text")).cast("long").alias("n_chars"), F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))


def call_metadata(messages: DataFrame, calls: DataFrame) -> DataFrame:
    """conv with num_turns, num_tool_calls, tools_used, domains and endpoints (sorted, by comma) and num_distinct_tools.

    messages(conv), calls(conv, tool, domain, endpoint): a row for each call; a null or empty domain isn't listed.
    """
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c).cast("string"), F.lit("")))), ",").alias
    per = calls.groupBy("conv").agg(F.count("*").alias("num_tool_calls"), F.count_distinct("tool").alias("num_distinct_tools"), listed("tool")("tools_used"), listed("domain")("domains"), listed("endpoint")("endpoints"))
    out = messages.groupBy("conv").agg(F.count("*").alias("num_turns")).join(per, "conv", "left")
    return out.fillna(0, ["num_tool_calls", "num_distinct_tools"]).fillna("", ["tools_used", "domains", "endpoints"])


def judge(messages: DataFrame) -> DataFrame:
    """The rule-based scores of task completion and naturalness, from 1 to 5, without tool calls."""
    per = messages.groupBy("conv").agg(F.count("*").alias("n"), F.min_by("role", "pos").alias("first"), F.max_by("role", "pos").alias("last"), F.count_if(F.col("role") == "user").alias("users"), F.count_if((F.col("role") == "assistant") & F.col("text").contains("?")).alias("asks"))
    point = lambda c: F.when(c, 1).otherwise(0)
    clamp = lambda c: F.greatest(F.lit(1), F.least(F.lit(5), c)).cast("int")
    return per.select("conv", clamp(3 + point(F.col("last") == "assistant") + point(F.col("n") >= 3)).alias("task_completion"), clamp(2 + point(F.col("first") == "user") + point(F.col("users") > 1) + point(F.col("asks") > 0)).alias("naturalness"))


def histogram(scores: DataFrame, dimensions: list[str]) -> DataFrame:
    """How often each dimension has each score from 1 to 5, zeros included."""
    long = scores.select(F.explode(F.create_map(*[x for d in dimensions for x in (F.lit(d), F.col(d).cast("int"))])).alias("dimension", "score"))
    grid = scores.sparkSession.createDataFrame([(d, s) for d in dimensions for s in range(1, 6)], "dimension string, score int")
    return F.broadcast(grid).join(long.groupBy("dimension", "score").agg(F.count("*").alias("n")), ["dimension", "score"], "left").select("dimension", "score", F.coalesce("n", F.lit(0)).alias("n"))


def grounded(calls: DataFrame, outputs: DataFrame) -> DataFrame:
    """calls(key, at, value) that an earlier output(key, at, value) of the same key has."""
    first = outputs.groupBy("key", "value").agg(F.min("at").alias("first_at"))
    return calls.join(first, ["key", "value"]).where("first_at < at").select(*calls.columns)


def transitions(messages: DataFrame) -> DataFrame:
    """How often each role follows each, from `start`."""
    s = structure(messages)
    return s.groupBy(F.coalesce("previous_role", F.lit("start")).alias("from_role"), F.col("role").alias("to_role")).agg(F.count("*").alias("n"))


def rounded_mean(c: Column) -> Column:
    """Half to even, as an integer."""
    return F.bround(F.avg(c), 0).cast("int")
