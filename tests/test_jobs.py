"""The jobs from files to report, record checks, configuration, cache, nested schemas."""

import json

import pytest
from pyspark.sql import functions as F

from loomspark.functions import schema as Y
from loomspark.plans import jobs
from loomspark.sources import catalogue as S


def definition(i):
    names = ("listItems", "getItem", "findPrice")
    return {"tool_name": f"Tool {i}", "description": "Data on goods and prices", "category": f"D{i % 2}", "api_list": [{"name": f"{n}{i}", "url": f"https://t{i}.com/v1/{n}", "method": "GET", "description": "Finds rows of a kind", "required_parameters": [{"name": "item_id", "type": "STRING"}]} for n in names]}


def test_build_generate_evaluate(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(6):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(definition(i)))
    (tmp_path / "in" / "none.json").write_text(json.dumps({"name": "Empty", "endpoints": []}))
    built = {r.name: r.rows for r in jobs.build(spark, str(tmp_path / "in"), str(tmp_path / "b")).collect()}
    assert built == {"tools": 6, "endpoints": 18, "parameters": 18, "nodes": 6 + 18, "edges": 18 + 2 * 36}  # tools are nodes too
    records = jobs.generate(spark, str(tmp_path / "b"), str(tmp_path / "c"), 12)
    assert records.count() == 12
    first = {r.conversation_id: r.messages for r in records.collect()}
    again = {r.conversation_id: r.messages for r in jobs.generate(spark, str(tmp_path / "b"), str(tmp_path / "d"), 12).collect()}
    assert first == again
    done = jobs.evaluate(records)
    rows = done.collect()
    assert len(rows) == 12 and all(r.valid and r.passed for r in rows)
    assert {(r.dimension, r.score): r.n for r in jobs.report(done).collect()}["tool_correctness", 1] == 0
    assert jobs.subset(S.load(spark, str(tmp_path / "b"), "tools"), 4).count() == 4


def test_record_files(spark, tmp_path):
    path = str(tmp_path / "r.jsonl")
    good = {"conversation_id": "a", "messages": [{"role": "user", "content": "x"}], "metadata": {}, "judge_scores": None}
    (tmp_path / "r.jsonl").write_text("\n".join([json.dumps({"__metadata__": True, "run": 3}), json.dumps(good), "", "{bad"]))
    assert S.read_header(spark, path)["run"] == 3 and S.record_count(spark, path) == 1
    bad = [json.dumps(good), "{", json.dumps({"messages": [{"role": "x", "tool_calls": 3}], "judge_scores": 4}), json.dumps({"conversation_id": "b", "messages": [], "metadata": {}})]
    got = [r.errors for r in S.record_errors(spark.createDataFrame([(b,) for b in bad], "value string").coalesce(1)).collect()]
    assert got == [[], ["not JSON"], ["no conversation_id", "unknown role", "tool_calls is not a list", "judge_scores is not an object", "metadata is not an object"], ["no messages"]]
    (tmp_path / "e.jsonl").write_text("")
    assert S.read_header(spark, str(tmp_path / "e.jsonl")) is None


def test_config_and_cache(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"a": {"x": 2}}))
    base = {"a": {"x": 1, "y": 1}, "b": 0}
    assert S.load_config(str(tmp_path / "c.json"), base, {"a__y": 5, "a__z": 9, "q__r": 1, "b": None}) == {"a": {"x": 2, "y": 5}, "b": 0}
    assert S.load_config(None, base) == base
    cache = spark.sql("SELECT 'k' AS key, 'old' AS response, timestamp'2024-01-01 00:00:00' AS cached_at UNION ALL SELECT 'k', 'new', timestamp'2024-01-01 01:00:00'")
    keys = spark.createDataFrame([("k",), ("z",)], "key string")
    ask = lambda at, ttl: {r.key: r.response for r in S.cached(keys, cache, F.lit(at).cast("timestamp"), ttl).collect()}
    assert ask("2024-01-01 01:10:00", 3600) == {"k": "new", "z": None} and ask("2024-01-02 00:00:00", 3600)["k"] is None and ask("2030-01-01 00:00:00", None)["k"] == "new"
    assert len(spark.range(1).select(S.prompt_key(F.struct(F.lit("p").alias("a")))).head()[0]) == 16


def test_nested_schemas(spark):
    schema = {"properties": {"id": {"type": "string"}, "owner": {"type": "object", "properties": {"full_name": {"type": "string"}}}, "rows": {"type": "array", "items": {"properties": {"url": {}}}}}}
    df = spark.createDataFrame([(1, json.dumps(schema)), (2, "{}")], "k int, s string").select("k", F.parse_json("s").alias("schema"))
    got = {(r.k, r.path): (r.type, r.extracts) for r in Y.flatten(df, "k", 3).collect()}
    assert got == {(1, "id"): ("string", "id"), (1, "owner"): ("object", "none"), (1, "owner.full_name"): ("string", "name"), (1, "rows"): ("array", "none"), (1, "rows.[].url"): ("any", "url")}
    with pytest.raises(Exception, match="deeper than 1 levels"):
        Y.flatten(df, "k", 1).collect()
    one = df.where("k = 1").select(Y.resolve(F.col("schema"), "owner.full_name").isNotNull(), Y.resolve(F.col("schema"), "rows.0.url").isNotNull(), Y.resolve(F.col("schema"), "no.way").isNull()).head()
    assert all(one)


def test_responses(spark):
    r = spark.range(3).select(*[Y.value_for(F.lit(n), F.col("id")).alias(n) for n in ("user_id", "title", "link", "created", "state", "colour")])
    assert r.collect() == r.collect() and r.head().user_id.startswith("user_id-") and r.head().state == "active"
    shape = lambda m, p: spark.range(1).select(Y.response_shape(F.lit(m), F.lit(p))).head()[0]
    assert [shape("DELETE", "/x"), shape("POST", "/xs"), shape("GET", "/xs/"), shape("GET", "/x")] == ["status", "object", "list", "object"]
    ok = lambda m, *k: spark.range(1).select(Y.valid_response(F.lit(m), F.array(*[F.lit(x) for x in k]))).head()[0]
    assert [ok("DELETE", "status"), ok("POST", "name"), ok("GET", "a"), ok("GET")] == [True, False, True, False]
    assert spark.range(1).select(Y.draw(F.array(F.lit("a"), F.lit("b")), F.col("id"))).head()[0] in ("a", "b")
