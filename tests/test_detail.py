"""Literal cases of type inference, completeness, tool calls, pruning, components and chain patterns."""

import pytest
from pyspark.sql import functions as F

from loomspark.functions import inference as I
from loomspark.functions import text as X
from loomspark.operators import diversity as D
from loomspark.operators import graph as G
from loomspark.operators import scoring as P
from loomspark.operators import toolcalls as T
from loomspark.streaming import tracker


def value(spark, column):
    return spark.range(1).select(column.alias("x")).head()[0]


@pytest.mark.parametrize("name,want", [("uuid", ("string", 0.95)), ("LIMIT", ("integer", 0.95)), ("user_ids", ("array", 0.9)), ("created_at", ("datetime", 0.8)), ("price", ("number", 0.85)), ("total", ("integer", 0.85)), ("zzz", None)])
def test_from_name(spark, name, want):
    assert value(spark, I.from_name(F.lit(name))) == want


def test_evidence(spark):
    array = lambda *v: F.array(*[F.lit(x) for x in v]).cast("array<string>")
    assert [value(spark, I.from_enum(array(*v)))[0] for v in (("1", "2"), ("1", "2.5"), ("true", "FALSE"), ("a", "1"))] == ["integer", "number", "boolean", "string"]
    assert value(spark, I.from_enum(array())) is None and value(spark, I.from_default(F.lit(None).cast("string"))) is None
    assert value(spark, I.combine([I.from_default(F.lit("5")), I.from_name(F.lit("limit")), I.from_place(F.lit("query"))])) == ("integer", 1.0)
    assert value(spark, I.combine([I.from_place(F.lit("body"))], 0.5)) == ("string", 0.4)
    assert value(spark, I.combine([I.from_name(F.lit("zzz"))])) == ("string", 0.0)


@pytest.mark.parametrize("args,want", [
    (("getWeather", "Weather Hub", "weather", "Current forecast for a city."), "current forecast for a city"),
    (("tg", "xx", "Movie_Data", None), "look up movie data information"), (("tg", "Weather Hub", "Movies", ""), "use weather hub for movies data"),
    (("tg", "Weather Hub", "", None), "get data from weather hub"), (("tg", "xx", None, None), "look up some information"),
    (("weatherNow", "Weather Hub", "w", None), "weather now"), (("listCities", "Weather Hub", "w", None), "use weather hub to list cities"),
])
def test_describe_step(spark, args, want):
    assert value(spark, X.describe_step(*[F.lit(a).cast("string") for a in args])) == want


def test_text_values(spark):
    assert value(spark, X.enum_values(F.lit(" a, b,,c "))) == ["a", "b", "c"] and value(spark, X.enum_values(F.lit(" "))) is None
    assert [value(spark, X.required_flag(F.lit(x).cast("string"))) for x in ("yes", "optional", None, "1")] == [True, False, False, True]
    assert [value(spark, X.extractable(F.lit(x))) for x in ("paid", "title", "href", "created", "count", "state", "x")] == ["id", "name", "url", "date", "count", "status", "none"]
    assert value(spark, X.parameter_type(F.lit("date-time"))) == "datetime" and value(spark, X.location(F.lit("formData"))) == "form"
    assert value(spark, X.tool_text(F.lit("W"), F.lit(""), F.lit("d"), F.array(F.lit("a"), F.lit("b")))) == "W. Domain: d. Endpoints: a, b."
    assert value(spark, X.clean_description(F.lit(None).cast("string"))) is False


def test_scores(spark):
    p = spark.createDataFrame([("e", "q", "the search phrase", "string", True, None)], "endpoint string, name string, description string, type string, required boolean, default string")
    assert P.parameter_scores(p).head().score == pytest.approx(0.85)
    e = spark.createDataFrame([("e", "t", "find", "Finds all the rows", "/find", True), ("f", "t", "none", None, "/", False)], "endpoint string, tool string, name string, description string, path string, has_schema boolean")
    got = {r.endpoint: r.score for r in P.endpoint_scores(e, p).collect()}
    assert got == {"e": pytest.approx(0.65 + 0.35 * 0.85), "f": pytest.approx(0.15)}
    t = spark.createDataFrame([("t", "Tool", None, "d"), ("u", "Other", None, None)], "tool string, name string, description string, domain string")
    tools = {r.tool: (r.n_endpoints, r.tier) for r in P.tool_scores(t, e, p).collect()}
    assert tools == {"t": (2, "good"), "u": (0, "minimal")}


def test_calls(spark):
    m = spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", 1), (1, 2, "assistant", 1), (1, 3, "tool", None), (1, 4, "user", None), (1, 5, "tool", None), (1, 6, "assistant", 0)], "conv int, pos int, role string, n_calls int")
    r = T.order_errors(m).head()
    assert (r.lone_results, r.unanswered, r.empty_calls, r.calls) == (1, 1, 1, 2)
    calls = spark.createDataFrame([(1, 0, "a", {"x": "1"}), (1, 1, "b", None), (1, 2, "a", None)], "conv int, pos int, endpoint string, arguments map<string,string>")
    got = [r.errors for r in T.call_errors(calls, spark.createDataFrame([("a", ["x", "y"])], "endpoint string, required array<string>")).orderBy("pos").collect()]
    assert got == ["missing y", "unknown endpoint", "missing x; missing y"]
    v = spark.createDataFrame([(1, 1, "id", "p"), (1, 2, "id", "q")], "conv int, step int, key string, value string")
    assert {(r.key, r.value) for r in T.latest_values(v).collect()} == {("id", "q"), ("step_1.id", "p"), ("step_2.id", "q")}


def test_prune_and_components(spark):
    e = spark.createDataFrame([("t", "a", "same_tool", 1.0), ("a", "b", "same_domain", 0.9), ("a", "c", "same_domain", 0.5), ("c", "d", "same_domain", 0.1)], "src string, dst string, edge_type string, weight double")
    assert {(r.src, r.dst) for r in G.prune_by_degree(e, 2).collect()} == {("t", "a"), ("a", "b"), ("c", "d")}
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40)], "src long, dst long")
    got = {r.node: r.component for r in G.components(spark.range(0, 60).toDF("node"), chain).collect()}
    assert all(got[i] == 0 for i in range(21)) and got[50] == 40 and got[30] == 30


def test_patterns(spark):
    rows = [("p", 1, 1, 1, "a", "GET", "x"), ("p", 2, 2, 2, "b", "GET", "x"), ("p", 3, 3, 3, "c", "GET", "y"), ("i", 1, 9, 9, "a", "GET", "x"), ("i", 2, 10, 9, "b", "GET", "y"), ("s", 1, 9, 9, "a", "GET", "x"), ("s", 2, 10, 8, "b", "GET", "y"), ("b", 1, 5, 5, "a", "GET", "x"), ("b", 2, 6, 6, "b", "GET", "y")]
    s = spark.createDataFrame(rows, "chain string, step int, node long, tool long, endpoint string, method string, domain string")
    s = s.withColumns({"params": F.lit(None).cast("array<string>"), "outputs": F.lit(None).cast("array<string>")})
    e = spark.createDataFrame([(5, 7)], "src long, dst long")
    assert {r.chain: r.pattern for r in G.chain_patterns(s, e).collect()} == {"p": "parallel", "i": "iterative", "s": "sequential", "b": "branch_and_merge"}
    assert [(r.step, r.run) for r in G.parallel_runs(s.where("chain = 'p'"), e).orderBy("step").collect()] == [(1, 1), (2, 1), (3, 3)]


def test_steering_and_report(spark):
    used = spark.createDataFrame([("a", 5), ("b", 1)], "domain string, uses long")
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "domain string")
    assert D.steering(used, known).head().text == "Focus this conversation on tools from these domains: b, c."
    assert D.steering(used, known.limit(0)).head().text == ""
    table = D.markdown(spark.createDataFrame([("entropy", 1.0, 1.5, 0.5)], "metric string, a double, b double, delta double"))
    assert table.splitlines()[-1] == "| entropy | 1.0000 | 1.5000 | +0.5000 |"


def test_moves():
    assert tracker.valid_events("disambiguation") == ["user_clarification", "max_turns_reached", "error"]
    assert sum(len(v) for v in tracker.MOVES.values()) == 18


def test_more_evidence(spark):
    examples = lambda *v: value(spark, I.from_examples(F.array(*[F.lit(x) for x in v]).cast("array<string>")))
    assert examples("a", "1", "2") == ("integer", 0.85) and examples("a", "1") == ("string", 0.85) and examples() is None
    said = lambda t: value(spark, I.from_description(F.lit(t)))
    assert said("True or false") == ("boolean", 0.75) and said("A comma separated LIST") == ("array", 0.7) and said("interest") is None


def test_descriptions(spark):
    said = lambda t, n="": value(spark, X.description(F.lit(t).cast("string"), F.lit(n)))
    assert said("caf\u00c3\u00a9  &amp; bar") == "caf\u00e9 & bar" and said("caf\u00e9 \u4e2d") == "caf\u00e9 \u4e2d" and said("caf\u00e9") == "caf\u00e9"
    assert said("The Weather", "weather") == "" and said(None) == ""


def test_page_rank_known(spark):
    e = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 3.0), ("b", "c", 1.0)], "src string, dst string, weight double")
    want = {"a": 1 / 3, "b": 1 / 3, "c": 1 / 3}
    for _ in range(200):  # brute force
        base = 0.05 + 0.85 * want["c"] / 3
        want = {"a": base, "b": base + 0.85 * want["a"] / 4, "c": base + 0.85 * (want["a"] * 3 / 4 + want["b"])}
    got = {r.node: r["rank"] for r in G.page_rank(e).collect()}
    assert got == {k: pytest.approx(v, abs=1e-5) for k, v in want.items()} and G.page_rank(e.limit(0)).count() == 0


def test_repeat_step(spark):
    p = spark.createDataFrame([(i, [1, 2, 3]) for i in range(9)] + [(99, [])], "chain long, path array<int>")
    for r in G.repeat_step(p).collect():
        twice = [a for a, b in zip(r.path, r.path[1:]) if a == b]
        assert (r.path == []) if r.chain == 99 else (len(r.path) == 4 and len(twice) == 1 and [x for i, x in enumerate(r.path) if i == 0 or x != r.path[i - 1]] == [1, 2, 3])


def test_parameters_of_endpoints(spark):
    """Equal parameters of different keys count once for an endpoint, as the whole texts made distinct do; no texts go with the endpoints."""
    fields = "name string, description string, type string, required boolean, default string"
    p = spark.createDataFrame([(1, "a", "about the a", "string", True, None), (2, "a", "about the a", "string", True, None), (3, "b", None, None, None, "x"), (4, None, "long enough text", "unknown", False, None), (5, "b", None, None, None, "x")], f"k long, {fields}")
    owned = spark.createDataFrame([(10, 1), (10, 2), (10, 2), (10, 4), (11, 3), (11, 5), (11, 1), (12, 9)], "endpoint long, k long")
    e = spark.createDataFrame([(i, 1, "n", "d", "/p", True) for i in (10, 11, 12)], "endpoint long, tool long, name string, description string, path string, has_schema boolean")
    got, whole = P.of_endpoints(owned, p, "k"), owned.join(p, "k").drop("k").distinct()
    assert not {"name", "description"} & set(got.columns)
    assert sorted(P.documented(got).collect()) == sorted(P.documented(whole).collect()) == [(10, 2, 2), (11, 1, 2)]
    assert sorted(P.endpoint_scores(e, got).collect()) == sorted(P.endpoint_scores(e, whole).collect())


def test_executed_parses_once(spark):
    """The response of a call and its data are parsed once each; every use parsed them again before."""
    calls = spark.createDataFrame([(1, 1, 5, {"order_id": "ORD-1"}), (1, 2, 6, None)], "conv long, pos long, endpoint long, arguments map<string,string>")
    known = spark.createDataFrame([(5, "n", "GET", "/item", "", ["hotel_id"])], "endpoint long, name string, method string, path string, domain string, keys array<string>")
    out = T.executed(calls, known)
    assert [(r.status, r.ids, r.taken and sorted(r.taken)) for r in out.orderBy("pos").collect()] == [(200, {"order_id": "ORD-1"}, ["hotel_id", "order_id"]), (404, None, None)]
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("parse_json") + out._jdf.queryExecution().optimizedPlan().toString().count("parseJson") <= 2
