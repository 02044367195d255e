"""Chains sampled from the tool graph and conversations generated from chains.

A chain depends only on its seed and number, so that any task can make any chain, runs repeat, and a lost
task is made again alike. The search is Monte Carlo tree search: descend by UCB1, expand one step, play out
at random, pass the reward up. The graph's endpoints are a catalogue (its size is checked before it is sent).
"""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.arguments import FAMILIES

#: Edges that may be sent to every task; beyond it sample_chains raises, as a graph that large isn't a catalogue's (prune it, or sample it by domain).
MOST_EDGES = 2_000_000


@dataclass(frozen=True)
class Constraints:
    """What a chain must be: its length, tools it must and mustn't have, domains it may be in (none: any), how many tools at least."""

    low: int = 2
    high: int = 5
    min_tools: int = 1
    required: frozenset = frozenset()
    excluded: frozenset = frozenset()
    domains: frozenset = frozenset()


class Graph:
    """Neighbours in both directions, and the tool and domain of each node."""

    def __init__(self, neighbours: dict[int, list[int]], tool: dict[int, object], domain: dict[int, object]):
        self.neighbours, self.tool, self.domain = neighbours, tool, domain

    def allowed(self, node: int, c: Constraints) -> bool:
        return self.tool.get(node) not in c.excluded and (not c.domains or self.domain.get(node) in c.domains)

    def starts(self, c: Constraints) -> list[int]:
        return [n for n in sorted(self.neighbours) if self.allowed(n, c)]

    def steps(self, path: list[int], c: Constraints) -> list[int]:
        return [n for n in self.neighbours[path[-1]] if n not in path and self.allowed(n, c)] if len(path) < c.high else []


def adjacency(edges: DataFrame, most: int = MOST_EDGES) -> dict[int, list[int]]:
    """Neighbours of each node in both directions; refuses a graph that is too large to send."""
    if edges.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} edges: prune the graph, or sample it by domain")
    out: dict[int, set[int]] = {}
    for r in edges.select("src", "dst").toLocalIterator():
        out.setdefault(r.src, set()).add(r.dst)
        out.setdefault(r.dst, set()).add(r.src)
    return {k: sorted(v) for k, v in out.items()}


def reward(path: list[int], g: Graph, c: Constraints) -> float:
    """1 for a length within bounds; .5 for each tool, .3 for each domain, .2 for each step along an edge; less .5 for each
    excluded tool that is there, each required one that isn't, a length out of bounds, too few tools. -1 for no steps."""
    if not path:
        return -1.0
    tools = {g.tool.get(n) for n in path}
    fits = c.low <= len(path) <= c.high
    linked = sum(b in g.neighbours.get(a, ()) for a, b in zip(path, path[1:]))
    faults = len(c.excluded & tools) + len(c.required - tools) + (not fits) + (len(tools) < c.min_tools)
    return fits + 0.5 * len(tools) + 0.3 * len({d for n in path if (d := g.domain.get(n)) not in (None, "")}) + 0.2 * linked - 0.5 * faults


def satisfied(path: list[int], g: Graph, c: Constraints) -> bool:
    tools = {g.tool.get(n) for n in path}
    return c.low <= len(path) <= c.high and all(g.allowed(n, c) for n in path) and len(tools) >= c.min_tools and c.required <= tools


class _Node:
    def __init__(self, path: list[int], open_: list[int]):
        self.path, self.open, self.children, self.visits, self.total = path, open_, [], 0, 0.0

    def best(self, c: float) -> _Node:
        return max(self.children, key=lambda k: k.total / k.visits + c * math.sqrt(math.log(self.visits) / k.visits))


def search(g: Graph, c: Constraints, rng: random.Random, rounds: int, explore: float = 1.4) -> list[int]:
    """A chain of distinct endpoints by tree search from a random start; empty without a start.

    It follows the most visited child from the root; if that chain doesn't satisfy the constraints, it is the most rewarded
    one that was played out.
    """
    starts = g.starts(c)
    if not starts:
        return []
    start = rng.choice(starts)
    root = _Node([start], g.steps([start], c))
    found, most = [start], reward([start], g, c)
    for _ in range(rounds):
        node, line = root, [root]
        while not node.open and node.children:
            node = node.best(explore)
            line.append(node)
        if node.open:
            path = [*node.path, node.open.pop(rng.randrange(len(node.open)))]
            child = _Node(path, g.steps(path, c))
            node.children.append(child)
            line.append(child)
            node = child
        path = list(node.path)
        for _ in range(3):
            if not (after := g.steps(path, c)):
                break
            path.append(rng.choice(after))
        got = reward(path, g, c)
        if got > most:
            found, most = path, got
        for n in line:
            n.visits += 1
            n.total += got
    node = root
    while node.children:
        node = max(node.children, key=lambda k: k.visits)
    return node.path if satisfied(node.path, g, c) else found


#: Of a thousand chains of a batch, how many have just two steps (of any number of tools), and just three.
SHORT, MEDIUM = 300, 400


def of_length(c: Constraints, roll: int) -> Constraints:
    """The constraints of a batch's chain whose lot below 1000 is `roll`."""
    if roll < SHORT:
        return replace(c, low=2, high=2, min_tools=1)
    return replace(c, low=3, high=3) if roll < SHORT + MEDIUM else c


def random_walk(g: Graph, c: Constraints, rng: random.Random, walks: int = 50) -> list[int]:
    """The first of some uniform walks that satisfies the constraints, or an empty one."""
    starts = g.starts(c)
    for _ in range(walks if starts else 0):
        path = [rng.choice(starts)]
        while after := g.steps(path, c):
            path.append(rng.choice(after))
        if satisfied(path, g, c):
            return path
    return []


def sample_chains(spark: SparkSession, edges: DataFrame, nodes: DataFrame, count: int, seed: int = 42, low: int = 2, high: int = 5, rounds: int = 60, candidates: int = 3, constraints: Constraints | None = None, buckets: bool = False) -> DataFrame:
    """chain, path, pattern of `count` chains over nodes(node, domain[, tool]); without tools each node is its own.

    Of each chain's candidates the first whose tool set no earlier chain has (by number, then candidate) is
    taken, else its first one: the diversity that steering asks for, as one window over hashes. With constraints a
    candidate that doesn't satisfy them is a random walk that does; chains that find none are left out. With buckets
    the chains' lengths are spread as those of a batch are (see of_length).
    """
    neighbours = adjacency(edges)
    c = constraints or Constraints(low, high)
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()  # as bounded as the edges are
    known = {r.node: r for r in nodes.join(ends, "node", "left_semi").toLocalIterator()}
    has_tools = "tool" in nodes.columns
    graph = Graph(neighbours, {n: r.tool if has_tools else n for n, r in known.items()}, {n: r.domain for n, r in known.items()})
    shared = spark.sparkContext.broadcast((graph, c, constraints is not None))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g, all_of_them, strict = shared.value
        for batch in batches:
            rows = []
            for chain in batch["id"] if g.neighbours else []:
                c = of_length(all_of_them, int.from_bytes(hashlib.sha256(f"{seed}:{chain}:length".encode()).digest()[:8], "big") % 1000) if buckets else all_of_them
                for k in range(candidates):
                    rng = random.Random(int.from_bytes(hashlib.sha256(f"{seed}:{chain}:{k}".encode()).digest()[:8], "big"))
                    path = search(g, c, rng, rounds)
                    if strict and not satisfied(path, g, c):
                        path = random_walk(g, c, rng)
                    if path:
                        rows.append((chain, k, path))
            yield pd.DataFrame(rows, columns=["chain", "candidate", "path"])

    made = spark.range(count).mapInPandas(run, "chain long, candidate int, path array<long>")
    tools = F.array_sort(F.array_distinct("path"))
    made = made.withColumn("pattern", F.substring(F.sha2(F.array_join(tools.cast("array<string>"), ",").cast("binary"), 256), 1, 16))
    first = made.groupBy("pattern").agg(F.min(F.struct("chain", "candidate")).alias("first"))
    fresh = made.join(first, "pattern").withColumn("seen", F.struct("chain", "candidate") != F.col("first"))
    return fresh.groupBy("chain").agg(F.min_by(F.struct("path", "pattern"), F.struct("seen", "candidate")).alias("x")).select("chain", "x.path", "x.pattern")


OPENERS = ("I need help with {}.", "Could you {} for me?", "Please {}.", "I want to {}.")
QUESTIONS = ("Could you tell me {}?", "Before I start, what is {}?", "Which values should I use for {}?")
REPLIES = ("Please use {}.", "It should be {}.", "Take {}.")
CLOSERS = ("Done: {}.", "Here is what I found: {}.", "All steps are complete: {}.", "Finished. {}.")


def at_hand(name: str, known: dict[str, str]) -> str | None:
    """The value for a parameter among those that earlier results hold: its own, one of a name that contains it or is in it, one of its family."""
    if name in known:
        return known[name]
    low = name.lower()
    for key, value in known.items():
        if low in key.lower() or key.lower() in low:
            return value
    for asks, offers, kind in FAMILIES:
        if kind == "string" and any(w in low for w in asks.split()):
            for key, value in known.items():
                if any(w in key.lower() for w in offers.split()):
                    return value
    return None


def conversation(chain: int, steps: list[dict], seed: int, clarify: float = 0.3, most_messages: int | None = None) -> list[dict]:
    """Messages of one chain: request, a call and its result for each step, follow-ups, a summary.

    Once most_messages is reached the steps that are left are passed over and the summary is given.

    With probability `clarify` the assistant asks once, before the first call, for what that call needs, and
    the call takes the user's values.

    Arguments take a value that an earlier result holds (see at_hand), else a fresh one; results echo
    their arguments and add an id, so later steps are grounded.
    """
    rng = random.Random(int.from_bytes(hashlib.sha256(f"{seed}:{chain}".encode()).digest()[:8], "big"))
    out: list[dict] = []
    known: dict[str, str] = {}

    def say(role: str, content: str | None = None, **more) -> None:
        out.append({"chain": chain, "pos": len(out), "role": role, "content": content, "endpoint": None, "arguments": None} | more)

    say("user", rng.choice(OPENERS).format(" and ".join(s["name"] for s in steps[:3]) or "this"))
    if steps and rng.random() < clarify:
        asked = steps[0]["parameters"]
        say("assistant", rng.choice(QUESTIONS).format("the " + " and ".join(p.replace("_", " ") for p in asked) if asked else "your preference"))
        known |= {p: f"{p}-{rng.randrange(1000, 9999)}" for p in asked}
        say("user", rng.choice(REPLIES).format(" and ".join(known[p] for p in asked) or "whatever fits"))
    for i, s in enumerate(steps):
        if most_messages is not None and len(out) + 3 > most_messages:
            break
        needed = {p: at_hand(p, known) or f"{p}-{rng.randrange(1000, 9999)}" for p in s["parameters"]}
        say("assistant", endpoint=s["endpoint"], arguments=needed)
        known |= needed | {f"{s['endpoint']}_id": f"id-{rng.randrange(1000, 9999)}", "id": f"id-{i}-{rng.randrange(1000, 9999)}"}
        say("tool", "; ".join(f"{k}={v}" for k, v in sorted(known.items())), endpoint=s["endpoint"])
        if i + 1 < len(steps) and rng.random() < 0.6:
            say("assistant", "That worked. Shall I go on?")
            say("user", f"Yes, now {steps[i + 1]['name']}.")
    say("assistant", rng.choice(CLOSERS).format(", ".join(s["name"] for s in steps)))
    return out


def generate(chains: DataFrame, endpoints: DataFrame, seed: int = 42, clarify: float = 0.3, most_messages: int | None = None) -> DataFrame:
    """Messages (chain, pos, role, content, endpoint, arguments) for chains(chain, path).

    endpoints(node, name, parameters array<string>) are joined in Spark; only the dialogue itself is Python.
    """
    steps = chains.select("chain", F.posexplode("path").alias("at", "node")).join(endpoints, "node")
    each = steps.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("at", "node", "name", "parameters"))).alias("steps"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [m for chain, s in zip(batch["chain"], batch["steps"], strict=True) for m in conversation(int(chain), [{"endpoint": str(x["node"]), "name": x["name"], "parameters": list(x["parameters"])} for x in s], seed, clarify, most_messages)]
            yield pd.DataFrame(rows, columns=["chain", "pos", "role", "content", "endpoint", "arguments"])

    return each.mapInPandas(run, "chain long, pos long, role string, content string, endpoint string, arguments map<string,string>")
