"""Ingest, arguments, responses, reports: queries against SQL, and what SQL doesn't reach."""

import json
import random

import pytest
from pyspark.sql import functions as F

from loomspark.functions import arguments as A
from loomspark.functions import responses as Q
from loomspark.functions import text as X
from loomspark.operators import diversity as D
from loomspark.operators import graph as G
from loomspark.operators import registry as R
from loomspark.operators import reports as P
from loomspark.operators import sampler
from loomspark.plans import catalog, jobs, more
from loomspark.sources import catalogue as S
from loomspark.streaming import tracker
from tests.oracle import compare

NAMES = sorted(n for n, f in catalog.QUERIES.items() if f.__module__ == more.__name__)


def value(spark, column):
    return spark.range(1).select(column.alias("x")).head()[0]


@pytest.mark.parametrize("name", [*NAMES, "node_importance"])
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, catalog.QUERIES[name], catalog.ORACLES[name])


@pytest.mark.parametrize("raw,want", [
    ({"schema": {"a": 1, "b": 2}}, (True, 200, "", ["a", "b"])), ({"schema": {}, "response": {"status_code": 201, "description": "x"}}, (True, 201, "x", [])), ({"output": []}, (True, 200, "", [])),
    ({"response": None, "responses": "yes"}, (True, 200, "", [])), ({"schema": {"a": 1}, "statuscode": 0}, (True, 200, "", ["a"])), ({"x": 1}, (False, None, "", [])), ({"response": {"code": 404}}, (True, 404, "", [])),
])
def test_response_schema(spark, raw, want):
    got = value(spark, S.response_schema(F.parse_json(F.lit(json.dumps(raw)))))
    assert (got.has_schema, got.status, got.description, sorted(got["keys"])) == want


def test_parameters_of_all_kinds(spark):
    listed = ["bare", {"name": "n", "type": "zzz"}, {"key": "count", "default": 3}, {"param_name": "opt", "is_required": "yes", "optional": True}, {"name": "e", "enum": [1, "b"], "in": "formData"}, 7, {"name": "f", "default": [1]}, {"name": "g", "schema": {"type": "int"}}, {"name": "size", "default": None, "example": True}]
    tool = {"name": "T", "endpoints": [{"path": "/x", "parameters": listed}]}
    raw = spark.createDataFrame([("f", 0, json.dumps(tool))], "file string, position int, text string").select("file", "position", F.parse_json("text").alias("raw"))
    got = [(r.name, r.type, r.inferred, r.required, r.location, r.enum_values) for r in S.parameters(S.endpoints(S.tools(raw))).orderBy("ordinal").collect()]
    assert got == [
        ("bare", "string", False, True, "query", None), ("n", "unknown", False, False, "query", None), ("count", "integer", True, False, "query", None), ("opt", "string", True, False, "query", None),
        ("e", "string", True, False, "form", ["1", "b"]), ("f", "array", True, False, "query", None), ("g", "integer", False, False, "query", None), ("size", "boolean", True, False, "query", None),
    ]


def test_build_has_both_ends(spark, tmp_path):
    for i in range(3):
        ends = [{"name": f"find{w}", "path": f"/{w}/{i}", "description": f"Finds {w} near a city", "schema": {"id": "x"}, "parameters": [{"name": "city_ids"}]} for w in ("hotels", "flights")]
        (tmp_path / f"{i}.json").write_text(json.dumps({"name": f"Tool {i}", "domain": "Travel", "description": "All about travel", "endpoints": ends}))
    out = str(tmp_path / "b")
    jobs.build(spark, str(tmp_path / "*.json"), out, semantic=0.6, most_tools=2)
    nodes, edges = S.load(spark, out, "nodes"), S.load(spark, out, "edges")
    names = {r.node for r in nodes.collect()}
    assert nodes.where("node_type = 'tool'").count() == 2 and nodes.count() == 6
    assert all({r.src, r.dst} <= names for r in edges.collect())
    assert edges.where("edge_type = 'semantic_similarity'").count() > 0 and S.load(spark, out, "embeddings").count() == 4
    assert {r.type for r in S.load(spark, out, "parameters").collect()} == {"array"}
    assert all(r.response.has_schema for r in S.load(spark, out, "endpoints").collect())


def test_header_settings_and_registry(spark, tmp_path):
    path = str(tmp_path / "run")
    S.write_header(spark, path, {"seed": 7})
    records = spark.createDataFrame([("a", '{"seed": 3}')], "conversation_id string, metadata string")
    S.write_records(records, path)
    assert S.run_settings(spark, path) == {"seed": 7} and S.record_count(spark, path) == 1
    assert S.with_settings(records, {"b": 1, "a": 2}).head().run_config == '{"a": 2, "b": 1}'
    (tmp_path / "plain.jsonl").write_text('{"conversation_id": "x", "metadata": {"seed": 5}}')
    assert S.run_settings(spark, str(tmp_path / "plain.jsonl")) == {"seed": 5}
    tools = spark.createDataFrame([("t", "Tool", "d")], "tool_id string, name string, domain string")
    ends = spark.createDataFrame([("e", "t", "find", "GET", "/x")], "endpoint_id string, tool_id string, name string, method string, path string")
    pars = spark.createDataFrame([("e", 0, "q", "string", True)], "endpoint_id string, ordinal int, name string, type string, required boolean")
    lines = S.registry_json(tools, ends, pars)
    again = S.tools(S.registry_of_json(lines))
    assert again.head().tool_id == "t" and S.parameters(S.endpoints(again)).head().name == "q"
    S.cache_put(spark.createDataFrame([("k", "v")], "key string, response string"), str(tmp_path / "cache"), F.lit("2024-01-01"))
    S.cache_put(spark.createDataFrame([("k", "w")], "key string, response string"), str(tmp_path / "cache"), F.lit("2024-01-02"))
    assert S.cached(spark.createDataFrame([("k",)], "key string"), spark.read.parquet(str(tmp_path / "cache")), F.lit("2024-01-03").cast("timestamp")).head().response == "w"
    (tmp_path / "bad.json").write_text("{nope")
    with pytest.raises(Exception):
        S.scan(spark, str(tmp_path / "bad.json"), strict=True).collect()


def test_texts(spark):
    assert value(spark, X.template_path(F.lit("a%20b/%zz/:id"))) == "/a%20b/%zz/{id}" and value(spark, X.template_path(F.lit("/caf%C3%A9+x/"))) == "/café+x"
    assert value(spark, X.description(F.lit("caf\\u00e9 &amp; more"), F.lit("n"))) == "café & more"
    assert [X.file_size(n) for n in (5, 2048, 3 << 20)] == ["5 B", "2.0 KB", "3.0 MB"]
    assert value(spark, X.chain_text(F.array().cast("array<struct<run:int,text:string>>"))) == "(empty chain)"
    assert value(spark, X.task(F.array().cast("array<struct<tool:string,text:string>>"), F.lit(False))) == "help me with a task"


def test_arguments(spark):
    none = F.array().cast("array<struct<key:string,value:string,kind:string>>")
    assert value(spark, A.matched_key(F.lit("x"), none)) is None and value(spark, A.grounded(F.lit("x"), none)) is None
    assert value(spark, A.available_text(F.array().cast("array<struct<key:string,shown:string,endpoint:string,step:int>>"))).startswith("No values")
    assert value(spark, A.coerced(F.lit("1e3"), F.lit("number"))) == "1000.0" and value(spark, A.coerced(F.lit("nope"), F.lit("number"))) is None
    assert value(spark, A.prompt_value(F.parse_json(F.lit("null")))) == "null" and value(spark, A.prompt_value(F.lit(None).cast("variant"))) == "null"


def test_responses(spark):
    made = json.loads(value(spark, Q.response(F.lit("e"), F.lit("GET"), F.lit("/rows"), F.lit("Travel"), F.lit(None).cast("array<string>"), F.lit(1))))
    assert made["count"] == len(made["results"]) and 2 <= made["count"] <= 5 and all("city" in r for r in made["results"])
    assert value(spark, Q.field_pool(F.lit("city_name"), F.lit(""))) == "city" and value(spark, Q.field_pool(F.lit("city_name"), F.lit("d"))) == "name"
    assert value(spark, Q.extracted(F.parse_json(F.lit("{}")), F.array().cast("array<string>"))) == {}


def test_registry(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    assert R.added(a, spark.createDataFrame([(3, "z")], "id int, name string"), "id").count() == 3
    for bad in ([(2, "q")], [(4, "q"), (4, "r")]):
        with pytest.raises(Exception, match="id is there already"):
            R.added(a, spark.createDataFrame(bad, "id int, name string"), "id").collect()
    assert R.drawn(a.limit(0), "id").collect() == []


def test_reports_of_nothing(spark):
    none = spark.createDataFrame([], "turns int, calls int, milliseconds int, tools array<int>, domains array<int>")
    r = P.batch(none).head()
    assert (r.total_generated, r.average_turns, r.tools_coverage) == (0, 0.0, 0)
    m = spark.createDataFrame([(1, 0, "assistant", False)], "conv int, pos int, role string, calls boolean")
    s = spark.createDataFrame([(1, 1, 1, 5)], "conv int, naturalness int, argument_grounding int, task_completion int")
    assert P.problem_turn(m, s).head().turn is None


def test_steering_falls_back(spark):
    uses = spark.createDataFrame([("a", 3), ("b", 1)], "domain string, uses int")
    tools = uses.withColumnRenamed("domain", "tool")
    ask = lambda d: D.steering_prompt(uses, d, tools, tools.select("tool")).head().text
    assert ask(uses.select("domain")) == "Focus this conversation on the b domain." and ask(uses.select("domain").limit(0)) == "Try to use the b tool in this conversation."


def small_graph():
    nodes = {i: (i % 4, "ab"[i % 2]) for i in range(12)}
    near = {i: sorted({(i + k) % 12 for k in (1, 2, 11, 10)}) for i in range(12)}
    return sampler.Graph(near, {n: t for n, (t, _) in nodes.items()}, {n: d for n, (_, d) in nodes.items()}), nodes, near


def test_constrained_search():
    g, _, _ = small_graph()
    c = sampler.Constraints(3, 4, 2, required=frozenset({1}), excluded=frozenset({2}))
    for seed in range(30):
        rng = random.Random(seed)
        path = sampler.random_walk(g, c, rng)
        assert path and sampler.satisfied(path, g, c) and len(set(path)) == len(path)
        assert all(g.tool[n] != 2 for n in sampler.search(g, c, rng, 40))
    only = sampler.Constraints(domains=frozenset({"a"}))
    assert {g.domain[n] for n in sampler.search(g, only, random.Random(1), 40)} == {"a"}
    assert sampler.search(g, sampler.Constraints(domains=frozenset({"z"})), random.Random(1), 9) == [] and sampler.random_walk(g, sampler.Constraints(domains=frozenset({"z"})), random.Random(1)) == []
    assert sampler.reward([], g, c) == -1.0
    assert sampler.reward([0, 1], g, sampler.Constraints(2, 5)) == pytest.approx(1 + 0.5 * 2 + 0.3 * 2 + 0.2)
    assert sampler.reward([2], g, c) == pytest.approx(0.5 + 0.3 - 0.5 * 4)


def test_constrained_chains(spark):
    _, nodes, near = small_graph()
    e = spark.createDataFrame([(a, b, 1.0) for a, bs in near.items() for b in bs if a < b], "src long, dst long, weight double")
    n = spark.createDataFrame([(i, t, d) for i, (t, d) in nodes.items()], "node long, tool int, domain string")
    c = sampler.Constraints(3, 4, 2, required=frozenset({1}))
    rows = sampler.sample_chains(spark, e, n, 20, constraints=c).collect()
    assert len(rows) == 20 and all(3 <= len(r.path) <= 4 and any(nodes[x][0] == 1 for x in r.path) for r in rows)
    assert sampler.sample_chains(spark, e, n, 5, constraints=sampler.Constraints(required=frozenset({99}))).collect() == []


def test_conversation_limits_and_grounding():
    steps = [{"endpoint": str(i), "name": f"step {i}", "parameters": ["hotel_id", "city"]} for i in range(6)]
    whole, short = (sampler.conversation(1, steps, 5, 0.0, most) for most in (None, 6))
    assert len(short) <= 8 and short[-1]["role"] == "assistant" and sum(m["endpoint"] is not None for m in whole) == 12
    calls = [m["arguments"] for m in whole if m["arguments"]]
    assert all(c["city"] == calls[0]["city"] for c in calls)
    assert sampler.at_hand("booking_id", {"id": "7"}) == "7" and sampler.at_hand("place", {"destination": "Rome"}) == "Rome" and sampler.at_hand("x", {"y": "1"}) is None


def test_pruned_equals_prune(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("abc") if i % 9 else None, rng.choice(["high", "medium", "low", "odd"])) for i in range(70)]
    n = spark.createDataFrame(rows, "node long, domain string, tier string")
    for k in (1, 3, 100):
        assert sorted(G.same_domain_pruned(n, k).collect()) == sorted(G.prune(G.same_domain_edges(n), k).collect())
    a, b = G.same_domain_stats(n).head(), G.stats(n, G.same_domain_edges(n)).head()
    assert a.n_edges == b.n_edges and a.n_nodes == b.n_nodes and a.mean_weight == pytest.approx(b.mean_weight) and a.density == pytest.approx(b.density)
    want = {r.node: r.component for r in G.components(n.select("node"), G.same_domain_edges(n)).collect()}
    assert {r.node: r.component for r in G.components(n.select("node"), G.same_domain_stars(n)).collect()} == want


def test_late_events(spark, tmp_path):
    """An event that is later than the watermark allows is left out, one within it counts."""
    source, schema = tmp_path / "in", "ts timestamp, event_type string, value double"
    source.mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    for i, rows in enumerate([[("10:00", 1.0), ("12:30", 2.0)], [("12:25", 4.0)], [("10:30", 8.0), ("15:00", 16.0)], [("18:00", 32.0)]]):
        (source / f"{i}.json").write_text("\n".join(json.dumps({"ts": f"2024-01-01T{t}:00Z", "event_type": "a", "value": v}) for t, v in rows))
        import os

        os.utime(source / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    q = tracker.windowed(stream).writeStream.format("memory").queryName("late_events").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["window"].start.hour: (r.n, r.total) for r in spark.table("late_events").collect()}
    assert got[10] == (1, 1.0) and got[12] == (2, 6.0)


def test_lengths_of_a_batch(spark):
    c = sampler.Constraints(2, 5, 2)
    assert [(x.low, x.high, x.min_tools) for x in (sampler.of_length(c, r) for r in (0, 299, 300, 699, 700))] == [(2, 2, 1), (2, 2, 1), (3, 3, 2), (3, 3, 2), (2, 5, 2)]
    _, nodes, near = small_graph()
    e = spark.createDataFrame([(a, b, 1.0) for a, bs in near.items() for b in bs if a < b], "src long, dst long, weight double")
    n = spark.createDataFrame([(i, t, d) for i, (t, d) in nodes.items()], "node long, tool int, domain string")
    lengths = [len(r.path) for r in sampler.sample_chains(spark, e, n, 200, constraints=c, buckets=True).collect()]
    assert len(lengths) == 200 and 35 <= lengths.count(2) and 55 <= lengths.count(3) and max(lengths) <= 5


def test_tracked_stream(spark, tmp_path):
    from pyspark.sql.types import StructType

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"tools": ["b", "a", "a"], "domains": ["x"], "pattern": "p"}\n{"tools": ["a"], "domains": [], "pattern": "q"}')
    schema = StructType.fromDDL("tools array<string>, domains array<string>, pattern string")
    q = tracker.tracked(spark.readStream.schema(schema).json(str(tmp_path / "in"))).writeStream.format("memory").queryName("tracked").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.kind, r.key): r.n for r in spark.table("tracked").collect()} == {("tool", "a"): 2, ("tool", "b"): 1, ("domain", "x"): 1, ("pair", "a|b"): 1, ("pattern", "p"): 1, ("pattern", "q"): 1}


def test_parameter_fields_by_column(spark):
    """The same fields as the expression gives, with the raw parameter taken once for each field and not for each use."""
    rows = ['{"name": "", "param_name": " a! ", "type": "int64", "in": "path", "is_required": true, "default": 7}', '{"key": "k", "data_type": "bool", "default": "yes", "enum": ["x"]}', '{"type": "list", "default": 0, "default_value": "[1]", "description": "the k"}', "{}", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i long, r string").select("i", F.parse_json("r").alias("r"))
    got = S.with_parameter_fields(df, "r", "x")
    assert got.columns == ["i", "r", "x"] and got.select("i", "x").orderBy("i").collect() == df.select("i", S.parameter_fields(F.col("r")).alias("x")).orderBy("i").collect()
    uses = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get")
    assert 4 * uses(got.select("x.type", "x.default")) < uses(df.select(S.parameter_fields(F.col("r")).alias("x")).select("x.type", "x.default"))
