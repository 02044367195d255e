"""Reports on runs: evaluation totals, batches, repairs, replies of a judge, where a conversation went wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.operators.conversation import rounded_mean

#: Fixed names of the four scores, in order.
DIMENSIONS = ("tool_correctness", "argument_grounding", "task_completion", "naturalness")


def evaluation(results: DataFrame, *by: str) -> DataFrame:
    """results(passed, the four scores; null: not scored): total, passed, failed, pass_rate and the rounded mean scores."""
    out = results.groupBy(*by).agg(F.count("*").alias("total"), F.count_if("passed").alias("passed"), *[rounded_mean(F.col(d)).alias(d) for d in DIMENSIONS if d in results.columns])
    return out.withColumn("failed", F.col("total") - F.col("passed")).withColumn("pass_rate", F.col("passed") / F.greatest("total", F.lit(1)))


def batch(conversations: DataFrame, failed: int = 0, steering: bool = False) -> DataFrame:
    """conversations(turns, calls, milliseconds, tools array, domains array): one row of totals and means; zeros for none."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    sums = conversations.agg(F.count("*").alias("total_generated"), mean("turns").alias("average_turns"), mean("calls").alias("average_tool_calls"), mean("milliseconds").alias("average_generation_time_ms"))
    distinct = lambda c, name: conversations.select(F.explode(c).alias("x")).agg(F.count_distinct("x").alias(name))
    one = sums.join(distinct("tools", "tools_coverage"), F.lit(True)).join(distinct("domains", "domain_coverage"), F.lit(True))
    return one.withColumns({"total_failed": F.lit(failed), "steering_enabled": F.lit(steering)})


def repairs(attempts: DataFrame, retries: int = 3) -> DataFrame:
    """attempts(conversation_id, attempt from 1, passed), all that were made: attempts (of repair: 0 to retries), repaired, discarded conversations.

    A conversation that passes at attempt k + 1 was repaired in k attempts.
    """
    first = attempts.groupBy("conversation_id").agg(F.min(F.when(F.col("passed"), F.col("attempt"))).alias("first"))
    used = first.select(F.coalesce(F.col("first") - 1, F.lit(retries)).cast("int").alias("attempts"), F.col("first").isNotNull().alias("ok"))
    return used.groupBy("attempts").agg(F.count("*").alias("n"), F.count_if(F.col("ok") & (F.col("attempts") > 0)).alias("repaired"), F.count_if(~F.col("ok")).alias("discarded"))


def problem_turn(messages: DataFrame, scores: DataFrame, low: int = 2) -> DataFrame:
    """conv, turn: the first user message if naturalness is low, else the first call if grounding is, else the last message if completion is.

    messages(conv, pos, role, calls boolean), scores(conv, the scores). Null if no score is low or there is no such message.
    """
    per = messages.groupBy("conv").agg(F.min(F.when(F.col("role") == "user", F.col("pos"))).alias("user"), F.min(F.when((F.col("role") == "assistant") & F.col("calls"), F.col("pos"))).alias("call"), F.max("pos").alias("last"))
    turn = F.coalesce(F.when(F.col("naturalness") <= low, F.col("user")), F.when(F.col("argument_grounding") <= low, F.col("call")), F.when(F.col("task_completion") <= low, F.col("last")))
    return scores.join(per, "conv").select("conv", turn.alias("turn"))


def judge_reply(text: Column) -> Column:
    """struct of the four scores and the reasoning in a judge's reply: JSON, or else what looks like it; 1 where there is none, and within 1 to 5."""
    reply = F.try_parse_json(text)
    clamp = lambda c: F.greatest(F.lit(1), F.least(F.lit(5), F.coalesce(c, F.lit(1))))
    found = lambda d: F.regexp_extract(text, rf'"{d}"\s*:\s*(\d+)', 1).try_cast("int")
    score = lambda d: F.when(reply.isNotNull(), F.try_variant_get(reply, f"$.{d}", "int")).otherwise(found(d))
    said = F.when(reply.isNotNull(), F.try_variant_get(reply, "$.reasoning", "string")).otherwise(F.nullif(F.regexp_extract(text, r'"reasoning"\s*:\s*"([^"]*)"', 1), F.lit("")))
    nothing = F.coalesce(*[score(d) for d in DIMENSIONS]).isNull() & said.isNull()
    reasoning = F.when(nothing, "Failed to parse judge response").otherwise(F.coalesce(said, F.lit("")))
    return F.struct(*[clamp(score(d)).alias(d) for d in DIMENSIONS], reasoning.alias("reasoning"))


def as_json(report: DataFrame) -> DataFrame:
    """Each row of a report as a line of JSON, nulls included."""
    return report.select(F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"}).alias("json"))
