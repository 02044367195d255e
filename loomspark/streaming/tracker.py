"""Streaming forms: usage counts by tool, windowed events with late data, and the dialogue state machine."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Fixed legal transitions: state -> event -> state.
MOVES = {
    "init": {"start": "user_turn"},
    "user_turn": {"user_message": "assistant_turn", "max_turns_reached": "complete", "chain_complete": "complete", "error": "failed"},
    "assistant_turn": {
        "assistant_tool_call": "tool_execution", "assistant_disambiguate": "disambiguation", "assistant_final": "complete", "assistant_text": "user_turn",
        "max_turns_reached": "complete", "chain_complete": "complete", "error": "failed",
    },
    "tool_execution": {"tool_result": "user_turn", "chain_complete": "complete", "error": "failed"},
    "disambiguation": {"user_clarification": "assistant_turn", "max_turns_reached": "complete", "error": "failed"},
}


def valid_events(state: str) -> list[str]:
    return list(MOVES.get(state, {}))


def usage(stream: DataFrame) -> DataFrame:
    """stream(tool): running counts; partial sums per task keep the state one row for each tool."""
    return stream.groupBy("tool").agg(F.count("*").alias("uses"))


def tracked(chains: DataFrame) -> DataFrame:
    """chains(tools array, domains array, pattern), a table or a stream: kind (tool, domain, pair, pattern), key and how many chains have it.

    A chain counts once for each of its distinct tools, domains and unordered pairs of tools; the state is a row for each key.
    """
    tools, domains = (F.array_sort(F.array_distinct(F.transform(F.col(c), lambda x: x.cast("string")))) for c in ("tools", "domains"))
    pairs = F.flatten(F.transform(tools, lambda a, i: F.transform(F.slice(tools, i + 2, F.greatest(F.size(tools) - i - 1, F.lit(0))), lambda b: F.concat(a, F.lit("|"), b))))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("keys")) for k, v in (("tool", tools), ("domain", domains), ("pair", pairs), ("pattern", F.array(F.col("pattern"))))])
    each = chains.select(F.explode(kinds).alias("x")).select("x.kind", F.explode("x.keys").alias("key"))
    return each.groupBy("kind", "key").agg(F.count("*").alias("n"))


def windowed(stream: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """stream(ts, event_type, value): tumbling counts and sums; rows later than `late` are left out."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def follow(stream: DataFrame) -> DataFrame:
    """stream(conv, pos, event): each conversation's state after its events; `invalid` once a move is illegal."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, n = state.get if state.exists else ("init", 0)
        for event in pd.concat(list(batches)).sort_values("pos")["event"]:
            now, n = MOVES.get(now, {}).get(event, "invalid"), n + 1
        state.update((now, n))
        yield pd.DataFrame({"conv": [key[0]], "state": [now], "events": [n]})

    kind = stream.schema["conv"].dataType.simpleString()
    return stream.groupBy("conv").applyInPandasWithState(step, f"conv {kind}, state string, events long", "state string, events long", "update", GroupStateTimeout.NoTimeout)
