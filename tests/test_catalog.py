"""Every query with SQL against DuckDB, and the operators' literal cases."""

import json

import pytest
from pyspark.sql import functions as F

from loomspark.functions import text as X
from loomspark.operators import conversation as C
from loomspark.operators import diversity as D
from loomspark.operators import graph as G
from loomspark.operators import sampler as S2
from loomspark.plans import catalog, detail  # noqa: F401 (adds its queries)
from loomspark.sources import catalogue as S
from loomspark.streaming import tracker
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, catalog.QUERIES[name], catalog.ORACLES[name])


def test_khop_all_starts_everywhere(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, sf, catalog.QUERIES["khop_all"], catalog.ORACLES["khop_all"]) == 196
    assert catalog.QUERIES["khop_all"](spark, sf).where("origin > 20").count() > 0


def value(spark, column, **inputs):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()]).select(column).head()[0]


@pytest.mark.parametrize("f,x,want", [
    (X.slug, "  Wéather API! v2 ", "wéather_api_v2"), (X.parameter_name, " user-id? ", "user_id"), (X.parameter_name, "??", "unknown"),
    (X.path_of, "https://a.b/c/d?x=1", "/c/d"), (X.path_of, "http://a.b", "/"), (X.path_of, "/keep?q", "/keep?q"),
    (X.template_path, "users/:id/posts/<pid>/?q=1", "/users/{id}/posts/{pid}"), (X.base_url, "//api.x.com/", "https://api.x.com"), (X.base_url, "api.x.com", "https://api.x.com"),
    (X.method, "post", "POST"), (X.method, "weird", "GET"), (X.parameter_type, " Int ", "integer"), (X.parameter_type, "zzz", "unknown"),
    (X.humanize, "/getUserName_v2", "get user name v2"), (X.clean_name, "a  b!c", "a bc"), (X.function_name, "a b/c", "a_b_c"), (X.identifier, " My Tool! ", "my_tool"),
])
def test_text(spark, f, x, want):
    assert value(spark, f(F.col("x")), x=x) == want


def test_path_parameters_and_ids(spark):
    assert value(spark, X.path_parameters(F.col("x")), x="/a/{b}/:c/<d>/{b}") == ["b", "c", "d"]
    ids = {value(spark, X.endpoint_id(F.lit("t"), F.lit("GET"), F.col("x")), x=p) for p in ("/u/{id}", "/u/:id", "/u/<id>")}
    assert len(ids) == 1 and ids.pop().startswith("t/GET/")


def test_entropy_and_pairs(spark):
    steps = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "b"), (2, 2, "a"), (3, 1, "c"), (3, 2, "d")], "chain int, step int, tool string")
    m = D.metrics(steps).head()
    assert m.n_pairs == 2 and m.repetition == pytest.approx(1 / 3)
    assert m.entropy == pytest.approx(1.9182958340544896)  # a and b twice, c and d once
    assert D.entropy(spark.createDataFrame([(t,) for t in "abcd"], "tool string")).head().entropy == 2.0
    assert D.entropy(steps.limit(0).select("tool")).head().entropy == 0.0


def test_page_rank(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0), ("c", "a", 1.0)], "src string, dst string, weight double")
    assert all(r["rank"] == pytest.approx(1 / 3) for r in G.page_rank(edges).collect())


def test_semantic_edges_blocks(spark):
    v = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(30)], "node long, embedding array<double>")
    a, b = ({(r.src, r.dst) for r in G.semantic_edges(v, 0.99, block).collect()} for block in (4, 1000))
    assert a == b == {(i, j) for j in range(30) for i in range(j) if i % 3 == j % 3}


def test_validator(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "ok"), (2, 0, "assistant", "x"), (2, 1, "user", " "), (2, 2, "user", "y")]
    out = {r.conv: r for r in C.errors(spark.createDataFrame(rows, "conv int, pos int, role string, text string")).collect()}
    assert out[1].valid and not out[2].valid and "consecutive user messages" in out[2].errors and "empty user message" in out[2].errors


FILES = {
    "tools/Weather_Data/a.json": {"tool_name": "Weather", "home_url": "api.w.com", "api_list": [{"name": "now", "url": "https://api.w.com/v1/now", "method": "get", "required_parameters": [{"name": "city", "type": "STRING"}], "optional_parameters": [{"name": "page_size"}]}]},
    "tools/Weather_Data/b.json": {"tools": [{"name": "T1", "endpoints": [{"path": "/x", "parameters": ["q", {"name": "limit", "type": "int", "required": "yes"}]}]}, "junk", {}]},
    "c.json": [{"tool_id": "weather", "name": "later"}, {"name": "Bad", "endpoints": "text"}],
    "d.json": {"openapi": "3.0", "paths": {}},
}


def test_ingest(spark, tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(json.dumps(content))
    (tmp_path / "bad.json").write_text("{nope")
    files = S.scan(spark, str(tmp_path))
    assert files.count() == 5 and files.where("raw IS NULL").count() == 1
    tools = S.tools(S.records(files))
    got = {r.tool_id: (r.name, r.domain, r.base_url) for r in tools.collect()}
    assert got.keys() == {"weather", "t1", "bad"}
    endpoints = S.endpoints(tools)
    e = {r.name: (r.method, r.path) for r in endpoints.collect()}
    assert e["/x"] == ("GET", "/x")
    p = {r.name: (r.type, r.required) for r in S.parameters(endpoints).collect()}
    assert p["limit"] == ("integer", True) and p["q"] == ("string", True)  # a bare name is required


def test_records_and_manifest(spark, tmp_path):
    lines = [{"__metadata__": True, "run": 1}, {"conversation_id": "a", "messages": [{"role": "user", "content": "hi"}], "judge_scores": {"naturalness": 4}}]
    (tmp_path / "r.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n\n")
    df = S.read_records(spark, str(tmp_path / "r.jsonl"))
    assert [r.conversation_id for r in df.collect()] == ["a"]
    S.save(str(tmp_path / "out"), records=spark.range(5))
    assert S.load(spark, str(tmp_path / "out"), "records").count() == 5
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "out/records"))
    with pytest.raises(ValueError):
        S.load(spark, str(tmp_path / "out"), "records")


def test_streams(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = tracker.usage(source().select(F.col("event_type").alias("tool"))).writeStream.outputMode("complete").format("memory").queryName("uses").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("uses").agg(F.sum("uses")).head()[0] == events.count()
    messages = spark.createDataFrame([(1, 0, "start"), (1, 1, "user_message"), (1, 2, "assistant_tool_call"), (1, 3, "tool_result"), (2, 0, "tool_result")], "conv int, pos int, event string")
    messages.coalesce(1).write.parquet(str(tmp_path / "m"))
    stream = spark.readStream.schema(messages.schema).parquet(str(tmp_path / "m"))
    q = tracker.follow(stream).writeStream.outputMode("update").format("memory").queryName("states").start()
    q.processAllAvailable()
    q.stop()
    assert {r.conv: r.state for r in spark.table("states").collect()} == {1: "user_turn", 2: "invalid"}


def test_sampled_chains_and_conversations(spark, sf):
    a, b = ({r.chain: tuple(r.path) for r in catalog.sampled_chains(spark, "/root/testdata/sf0.01").collect()} for _ in range(2))
    assert a == b and len(a) == 200
    edges = {frozenset((r.src, r.dst)) for r in catalog.edges(spark, "/root/testdata/sf0.01").collect()}
    for path in a.values():
        assert 1 <= len(path) <= 5 and len(set(path)) == len(path)
        assert all(frozenset(p) in edges for p in zip(path, path[1:]))
    pruned = G.prune(catalog.edges(spark, "/root/testdata/sf0.01"), 5)
    once = S2.sample_chains(spark, pruned, catalog.nodes(spark, "/root/testdata/sf0.01"), 200, candidates=1)
    assert len({frozenset(p) for p in a.values()}) >= once.select("pattern").distinct().count()  # domains of about four endpoints allow few sets
    m = catalog.generated_conversations(spark, "/root/testdata/sf0.01")
    checked = C.errors(m.select(F.col("chain").alias("conv"), "pos", "role", F.col("content").alias("text")))
    assert checked.count() == 200 and checked.where("NOT valid").count() == 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
