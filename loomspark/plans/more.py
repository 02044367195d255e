"""Queries with SQL on ingest, arguments, mock responses, reports, registry and graph lookups.

Raw definitions are made from the tables as JSON texts and go through the whole ingest; SQL says what must come of
them from the tables alone. Suppliers stand for endpoints, nations for tools, parts for parameters, events for calls.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspark.functions import arguments as A
from loomspark.functions import inference as I
from loomspark.functions import responses as Q
from loomspark.functions import text as X
from loomspark.operators import diversity as D
from loomspark.operators import graph as G
from loomspark.operators import registry as R
from loomspark.operators import reports as P
from loomspark.operators import scoring
from loomspark.plans.catalog import _CHAINS, _EDGES, _PRUNED, _STEPS, ORACLES, endpoints, nodes, query, spread, steps, table
from loomspark.sources import catalogue as S

# ---- ingest: definitions as JSON


def _files(spark, sf):
    """A definition for each nation, in one of four formats, and one broken file for each region."""
    n = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 and 5 rows at any scale
    kind = F.col("s_suppkey") % 4
    city = F.struct(F.lit("city").alias("name"), F.lit("STRING").alias("type"), F.lit("Where").alias("description"))
    limit = F.struct(F.lit("page_size").alias("param_name"), F.lit("path").alias("in"), F.lit("10").alias("default"))
    flag = F.struct(F.lit("is_open").alias("key"), F.lit("true").alias("optional"), F.array(F.lit("a"), F.lit("b")).alias("enum"))
    call = F.struct(
        F.col("s_name").alias("api_name"), F.concat(F.lit("https://api.example.com/v1/"), F.col("s_suppkey"), F.lit("?q=1")).alias("url"), F.when(kind == 0, "post").otherwise("get").alias("http_method"),
        F.when(kind == 1, F.struct(F.lit("x").alias("id"), F.lit("y").alias("name"))).alias("schema"), F.when(kind == 1, 201).alias("statuscode"),
        F.when(kind == 2, F.struct(F.lit(404).alias("code"), F.lit("None").alias("description"))).alias("response"),
        F.when(kind < 2, F.array(city)).alias("required_parameters"), F.when(kind < 2, F.array(limit)).alias("optional_parameters"), F.when(kind >= 2, F.array(flag)).alias("parameters"),
    )
    calls = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct("s_suppkey", call.alias("c")))).alias("calls"))
    each = n.join(calls, F.col("n_nationkey") == F.col("k"), "left").withColumn("calls", F.coalesce(F.transform("calls", lambda x: x["c"]), F.array().cast(calls.select(F.transform("calls", lambda x: x["c"]).alias("x")).schema["x"].dataType)))
    tool = F.struct(F.col("n_name").alias("tool_name"), F.lit("").alias("description"), F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name")).alias("category"), F.lit("api.example.com/").alias("host"), F.col("calls").alias("api_list"))
    text = F.when(F.col("n_nationkey") % 3 == 0, F.to_json(tool)).when(F.col("n_nationkey") % 3 == 1, F.to_json(F.array(tool))).otherwise(F.to_json(F.struct(F.array(tool).alias("tools"))))
    file = F.concat(F.lit("/in/tools/Area_"), F.col("n_regionkey"), F.lit("/"), F.col("n_nationkey"), F.lit(".json"))
    bad = table(spark, sf, "region").select(F.concat(F.lit("/in/"), F.col("r_regionkey"), F.lit(".json")).alias("file"), F.when(F.col("r_regionkey") == 0, '{"openapi": "3.0"}').otherwise("{nope").alias("text"))
    return each.select(file.alias("file"), text.alias("text")).unionByName(bad).select("file", F.try_parse_json("text").alias("raw"))


_TOOL_ID = "trim(regexp_replace(lower(n_name), '[^a-z0-9_]+', '_', 'g'), '_')"
_ENDPOINT_ID = f"{_TOOL_ID} || '/' || CASE WHEN s_suppkey % 4 = 0 THEN 'POST' ELSE 'GET' END || '/' || substr(sha256(CASE WHEN s_suppkey % 4 = 0 THEN 'POST' ELSE 'GET' END || ':/v1/' || s_suppkey), 1, 8)"


@query("""SELECT '/in/tools/Area_' || n_regionkey || '/' || n_nationkey || '.json' AS file, ['single_tool', 'tool_list', 'toolbench_v1'][n_nationkey % 3 + 1] AS format FROM nation
UNION ALL SELECT '/in/' || r_regionkey || '.json', CASE WHEN r_regionkey = 0 THEN 'openapi' END FROM region""")
def ingest_formats(spark, sf):
    return _files(spark, sf).select("file", S.file_format(F.col("raw")).alias("format"))


@query(f"SELECT {_TOOL_ID} AS tool_id, n_name AS name, '' AS description, CASE WHEN n_nationkey % 2 = 0 THEN r_name ELSE 'Area ' || n_regionkey END AS domain, 'https://api.example.com' AS base_url FROM nation JOIN region ON n_regionkey = r_regionkey")
def ingest_tools(spark, sf):
    return S.tools(S.records(_files(spark, sf))).drop("endpoints")


@query(f"""SELECT {_ENDPOINT_ID} AS endpoint_id, {_TOOL_ID} AS tool_id, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'POST' ELSE 'GET' END AS method, '/v1/' || s_suppkey AS path,
s_suppkey % 4 IN (1, 2) AS has_schema, CASE s_suppkey % 4 WHEN 1 THEN 201 WHEN 2 THEN 404 END AS status, CASE WHEN s_suppkey % 4 = 1 THEN 'id,name' ELSE '' END AS keys FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def ingest_endpoints(spark, sf):
    e = S.endpoints(S.tools(S.records(_files(spark, sf))))
    return e.select("endpoint_id", "tool_id", "name", "method", "path", "response.has_schema", "response.status", F.array_join(F.array_sort("response.keys"), ",").alias("keys"))


@query(f"""WITH e AS (SELECT {_ENDPOINT_ID} AS endpoint_id, s_suppkey % 4 AS kind FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT endpoint_id, 0 AS ordinal, 'city' AS name, 'string' AS type, false AS inferred, true AS required, 'Where' AS description, CAST(NULL AS VARCHAR) AS "default", 'query' AS location, CAST(NULL AS VARCHAR) AS enum FROM e WHERE kind < 2
UNION ALL SELECT endpoint_id, 1, 'page_size', 'number', true, false, '', '10', 'path', NULL FROM e WHERE kind < 2
UNION ALL SELECT endpoint_id, 0, 'is_open', 'boolean', true, false, '', NULL, 'query', 'a,b' FROM e WHERE kind >= 2""")
def ingest_parameters(spark, sf):
    p = S.parameters(S.endpoints(S.tools(S.records(_files(spark, sf)))))
    return p.withColumn("enum", F.array_join("enum_values", ",")).drop("enum_values")


@query("SELECT (SELECT count(*) FROM nation) + (SELECT count(*) FROM region) AS files, (SELECT count(*) FROM region WHERE r_regionkey <> 0) AS failed_files, (SELECT count(*) FROM nation) AS tools, count(*) AS endpoints, sum(CASE WHEN s_suppkey % 4 < 2 THEN 2 ELSE 1 END)::BIGINT AS parameters, count(*) AS inferred_types FROM supplier")
def load_stats(spark, sf):
    files = _files(spark, sf)
    tools = S.tools(S.records(files))
    found = S.endpoints(tools)
    return S.load_stats(files, tools, found, S.parameters(found))


@query("""SELECT p_partkey, regexp_replace(trim(p_name), '[^A-Za-z0-9_\\s\\-]', '', 'g') AS name, CASE WHEN p_size % 3 = 0 THEN 'integer' WHEN p_size % 3 = 1 THEN 'boolean' ELSE 'string' END AS type, p_size % 3 <> 2 AS has_type,
CASE WHEN p_size % 2 = 0 THEN 'path' ELSE 'query' END AS location, p_size % 5 = 0 AS required, CASE WHEN p_size % 3 = 0 AND p_size % 4 > 0 THEN CAST(p_size AS VARCHAR) WHEN p_size % 3 = 1 AND p_size % 4 > 0 THEN CASE WHEN p_size = 1 THEN 'true' ELSE 'false' END WHEN p_size % 4 > 0 THEN CAST(p_size AS VARCHAR) END AS dflt FROM part""".replace("\\\\", "\\"))
def parameter_fields(spark, sf):
    kind = F.when(F.col("p_size") % 3 == 0, "int64").when(F.col("p_size") % 3 == 1, "bool").otherwise("")
    raw = F.struct(F.lit("").alias("name"), F.col("p_name").alias("param_name"), kind.alias("type"), F.when(F.col("p_size") % 2 == 0, "path").alias("in"), (F.col("p_size") % 5 == 0).alias("is_required"), F.when(F.col("p_size") % 4 == 0, 0).otherwise(F.col("p_size")).alias("default"))
    p = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), "p_partkey").withColumn("raw", F.parse_json(F.to_json(raw)))  # parsed once a row
    p = S.with_parameter_fields(p, "raw", "x")
    return p.select("p_partkey", "x.name", "x.type", "x.has_type", "x.location", "x.required", F.col("x.default").alias("dflt"))


@query("""SELECT s_suppkey, trim(regexp_replace(lower(s_name), '[^a-z0-9_]+', '_', 'g'), '_') AS tool_id, replace(s_name, '#', '') AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'Area' ELSE '' END AS domain, 'https://h.example' AS base_url,
'get' || s_suppkey AS endpoint, CASE WHEN s_suppkey % 3 = 0 THEN 'PUT' ELSE 'GET' END AS method, '/v/{id}' AS path FROM supplier""".replace("trim(regexp_replace(lower(s_name), '[^a-z0-9_]+', '_', 'g'), '_')", "lower(replace(s_name, '#', ''))"))
def composite_fields(spark, sf):
    tool = F.struct(F.lit("").alias("name"), F.col("s_name").alias("tool_name"), F.when(F.col("s_suppkey") % 2 == 0, "Area!").otherwise("").alias("category"), F.lit("//h.example/").alias("host"))
    call = F.struct(F.concat(F.lit("get"), F.col("s_suppkey").cast("string")).alias("operation_id"), F.when(F.col("s_suppkey") % 3 == 0, "put").otherwise("").alias("method"), F.lit("v/:id/?x").alias("api_url"))
    of = lambda s: F.parse_json(F.to_json(s))
    out = table(spark, sf, "supplier").select("s_suppkey", S.tool_fields(of(tool)).alias("t"), S.endpoint_fields(of(call)).alias("e"))
    return out.select("s_suppkey", "t.tool_id", "t.name", "t.domain", "t.base_url", F.col("e.name").alias("endpoint"), "e.method", "e.path")


@query("""SELECT p_partkey, raw, kind, CASE kind WHEN 'integer' THEN CASE WHEN regexp_matches(raw, '^[+-]?[0-9]+$') THEN CAST(CAST(raw AS HUGEINT) AS VARCHAR) END WHEN 'boolean' THEN CAST(lower(raw) IN ('true', '1', 'yes') AS VARCHAR) ELSE raw END AS value
FROM (SELECT p_partkey, ['007', 'Yes', '2.5', 'x', '-3', '1'][p_partkey % 6 + 1] AS raw, ['integer', 'boolean', 'string', 'array'][p_size % 4 + 1] AS kind FROM part)""")
def default_coerce(spark, sf):
    pick = lambda c, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (c % len(v) + 1).cast("int"))
    p = table(spark, sf, "part").select("p_partkey", pick(F.col("p_partkey"), "007", "Yes", "2.5", "x", "-3", "1").alias("raw"), pick(F.col("p_size"), "integer", "boolean", "string", "array").alias("kind"))
    return p.withColumn("value", A.coerced(F.col("raw"), F.col("kind")))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'integer' WHEN p_partkey % 3 = 0 THEN 'array' WHEN p_partkey % 3 = 1 THEN 'object' ELSE 'string' END AS type FROM part""")
def endpoint_inference(spark, sf):
    """Parameters with a type keep it; the rest are inferred from name, description and place."""
    name = F.when(F.col("p_partkey") % 3 == 0, "order_ids").when(F.col("p_partkey") % 3 == 1, "thing").otherwise("api_key")
    said = F.when(F.col("p_partkey") % 3 == 1, "a JSON object").otherwise("")
    guess = I.combine([I.from_name(name), I.from_description(said), I.from_place(F.lit("query"))])
    return table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, "integer").otherwise(guess["type"]).alias("type"))


# ---- arguments

_AT_HAND = [("user_id", "U-1", "string"), ("step_0.city", "Rome", "string"), ("hotel_name", "Ritz", "string"), ("created", "2024-05-05", "string"), ("total_cost", "12.5", "number"), ("status", "open", "string"), ("homepage_url", "http://x", "string"), ("step_1.zip", "00100", "string")]
_ASKED = ["user_id", "city", "zip", "name", "order_id", "start", "budget", "state", "link", "mail", "colour", "hotel", "place", "to"]
_VALUES = ", ".join(f"({i}, '{k}', '{v}', '{t}')" for i, (k, v, t) in enumerate(_AT_HAND))
_ASK = f"""v(ord, key, value, kind) AS (VALUES {_VALUES}),
p AS (SELECT p_partkey, {_ASKED}[p_partkey % {len(_ASKED)} + 1] AS name, ['integer', 'number', 'boolean', 'date', 'array', 'object', 'string'][p_size % 7 + 1] AS kind, CASE WHEN p_size % 5 = 0 THEN ['a', 'b', 'c'] END AS enum, CASE WHEN p_size % 3 = 0 THEN 'd' || p_size END AS dflt, p_size FROM part),
h AS (SELECT p.*, ord, key, value, v.kind AS vkind, string_split(key, '.')[-1] AS bare FROM p JOIN v ON (ord + p_size) % 3 > 0)"""
_LOT = "(CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) % {})"


def _asked(spark, sf):
    pick = lambda c, v: F.element_at(F.array(*[F.lit(x) for x in v]), (c % len(v) + 1).cast("int"))
    all_ = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(k).alias("key"), F.lit(v).alias("value"), F.lit(t).alias("kind")) for i, (k, v, t) in enumerate(_AT_HAND)])
    values = F.filter(all_, lambda v: (v["ord"] + F.col("p_size")) % 3 > 0)
    return table(spark, sf, "part").select(
        "p_partkey", "p_size", pick(F.col("p_partkey"), _ASKED).alias("name"), pick(F.col("p_size"), ["integer", "number", "boolean", "date", "array", "object", "string"]).alias("kind"),
        F.when(F.col("p_size") % 5 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("enum"), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("d"), F.col("p_size"))).alias("dflt"), values.alias("values"),
    )


_MATCH = _ASK + """,
m AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN key = name THEN 1 WHEN ends_with(key, '.' || name) THEN 2 ELSE 3 END, ord) AS r FROM h WHERE key = name OR ends_with(key, '.' || name) OR contains(bare, name) OR contains(name, bare))"""


@query(f"WITH {_MATCH} SELECT p.p_partkey, p.name, m.key FROM p LEFT JOIN m ON m.p_partkey = p.p_partkey AND m.r = 1")
def parameter_match(spark, sf):
    return _asked(spark, sf).select("p_partkey", "name", A.matched_key(F.col("name"), F.col("values")).alias("key"))


def _families(name: str, key: str) -> str:
    has = lambda text, words: "(" + " OR ".join(f"contains({text}, '{w}')" for w in words.split()) + ")"
    return " ".join(f"WHEN {has(name, asks)} AND {has(key, offers)} AND vkind = '{kind}' THEN {10 + i}" for i, (asks, offers, kind) in enumerate(A.FAMILIES))


_PLACE = f"""CASE kind WHEN 'integer' THEN CAST({_LOT.format("name || ':' || p_partkey", 99)} + 1 AS VARCHAR) WHEN 'number' THEN ((({_LOT.format("name || ':' || p_partkey", 9901)}) + 100) // 100) || '.' || lpad(CAST((({_LOT.format("name || ':' || p_partkey", 9901)}) + 100) % 100 AS VARCHAR), 2, '0')
 WHEN 'boolean' THEN CAST({_LOT.format("name || ':' || p_partkey", 2)} = 1 AS VARCHAR) WHEN 'date' THEN '2024-06-15' WHEN 'array' THEN '[]' WHEN 'object' THEN '{{}}' ELSE name || '_value' END"""
_ENUM = f"enum[({_LOT.format("name || ':' || p_partkey", 1 << 30)} % 3) + 1]"


@query(f"""WITH {_ASK},
c AS (SELECT *, CASE WHEN key = name THEN 1 WHEN contains(key, '.') THEN NULL WHEN contains(lower(key), lower(name)) OR contains(lower(name), lower(key)) THEN 2 {_families("lower(name)", "lower(key)")} END AS class FROM h),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY class, ord) AS r FROM c WHERE class IS NOT NULL) WHERE r = 1)
SELECT p.p_partkey, coalesce(g.value, {_ENUM.replace("name", "p.name").replace("p_partkey", "p.p_partkey").replace("enum", "p.enum")}, p.dflt, {_PLACE.replace("kind", "p.kind").replace("name", "p.name").replace("p_partkey", "p.p_partkey")}) AS value,
CASE WHEN g.value IS NOT NULL THEN 'grounded' WHEN p.enum IS NOT NULL THEN 'enum' WHEN p.dflt IS NOT NULL THEN 'default' ELSE 'placeholder' END AS source FROM p LEFT JOIN g ON g.p_partkey = p.p_partkey""")
def argument_resolve(spark, sf):
    a = _asked(spark, sf)
    return a.select("p_partkey", A.resolved(F.col("name"), F.col("kind"), F.col("enum"), F.col("dflt"), F.col("values"), F.col("p_partkey")).alias("x")).select("p_partkey", "x.value", "x.source")


@query(f"""WITH {_MATCH}
SELECT p.p_partkey, coalesce(m.value, {_ENUM.replace("name", "p.name").replace("p_partkey", "p.p_partkey").replace("enum", "p.enum")}, p.dflt,
 CASE WHEN contains(p.name, 'id') THEN upper(substr(p.name, 1, 3)) || '-' || ({_LOT.format("p.name || ':' || p.p_partkey", 8999)} + 1000) ELSE 'pool:' || CASE p.kind WHEN 'integer' THEN 'integer' WHEN 'number' THEN 'price' WHEN 'boolean' THEN 'boolean' WHEN 'date' THEN 'date' WHEN 'array' THEN 'description' WHEN 'object' THEN 'description' ELSE p.name END END) AS value,
 CASE WHEN m.value IS NOT NULL THEN 'grounded' WHEN p.enum IS NOT NULL THEN 'enum' WHEN p.dflt IS NOT NULL THEN 'default' ELSE 'fresh' END AS source
FROM p LEFT JOIN m ON m.p_partkey = p.p_partkey AND m.r = 1 WHERE p.p_size % 2 = 0 OR {_LOT.format("'optional:' || p.name || ':' || p.p_partkey", 1000)} < 500""")
def argument_generate(spark, sf):
    a = _asked(spark, sf)
    x = A.generated(F.col("name"), F.col("kind"), F.col("p_size") % 2 == 0, F.col("enum"), F.col("dflt"), F.col("values"), F.col("p_partkey"))
    return a.select("p_partkey", x.alias("x")).where("x IS NOT NULL").select("p_partkey", "x.value", "x.source")


@query("""SELECT s_suppkey, '{"type":"function","function":{"name":"' || regexp_replace(s_name, '[^a-zA-Z0-9_-]', '_', 'g') || '","description":"' || CASE WHEN s_suppkey % 2 = 0 THEN 'Finds rows' ELSE s_name END
|| '","parameters":{"type":"object","properties":{"user_id":{"type":"integer","description":"Who"},"when":{"type":"string"}},"required":["user_id"]}}}' AS schema FROM supplier""")
def tool_schemas(spark, sf):
    par = lambda n, t, d, r: F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(d).alias("description"), F.lit(r).alias("required"))
    said = F.when(F.col("s_suppkey") % 2 == 0, "Finds rows").otherwise("")
    return table(spark, sf, "supplier").select("s_suppkey", A.tool_schema(F.col("s_name"), F.col("s_name"), said, F.array(par("user id", "integer", "Who", True), par("when", "date", "", False))).alias("schema"))


_JSON_VALUES = ["null", "true", "2.5", "7", "[1, 2]", '["a", "b", "c", "d"]', '{"b": 1, "a": 2}', '"' + "x" * 60 + '"', '"short"']
_SHOWN = ["null", "true", "2.50", "7", "[1, 2]", "[a, b, c, ...]", "{a, b}", "x" * 50 + "...", "short"]


@query(f"SELECT p_partkey, {_SHOWN}[p_partkey % {len(_SHOWN)} + 1] AS shown FROM part")
def prompt_values(spark, sf):
    raw = F.element_at(F.array(*[F.lit(v) for v in _JSON_VALUES]), (F.col("p_partkey") % len(_JSON_VALUES) + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", A.prompt_value(F.parse_json(raw)).alias("shown"))


_LATEST = "e AS (SELECT user_id AS conv, event_id AS step, event_type AS key, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS value FROM events), l AS (SELECT conv, key, arg_max(value, step) AS value, max(step) AS step FROM e GROUP BY conv, key)"


def _latest(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("conv"), F.col("event_id").alias("step"), F.col("event_type").alias("key"), F.get_json_object("props", "$.k").alias("value"))
    return e.groupBy("conv", "key").agg(F.max_by("value", "step").alias("value"), F.max("step").alias("step"))


@query(f"""WITH {_LATEST} SELECT conv, 'Available values from prior tool calls:' || chr(10) || string_agg('- ' || key || ': ' || value || CASE WHEN key = 'click' THEN '' ELSE ' (from ep_' || key || ', step ' || step || ')' END, chr(10) ORDER BY key) AS text FROM l GROUP BY conv""")
def available_values_text(spark, sf):
    tracked = F.when(F.col("key") != "click", F.concat(F.lit("ep_"), F.col("key")))
    per = _latest(spark, sf).groupBy("conv").agg(F.collect_list(F.struct("key", F.col("value").alias("shown"), tracked.alias("endpoint"), "step")).alias("values"))
    return per.select("conv", A.available_text(F.col("values")).alias("text"))


@query(f"WITH {_LATEST}, n AS (SELECT conv, count(*) AS prior_tool_calls FROM e GROUP BY conv) SELECT conv, string_agg(key || '=' || value, ',' ORDER BY key) AS available_values, string_agg(CASE WHEN key = 'view' THEN key || '=' || value END, ',' ORDER BY key) AS generated_ids, max(step) AS current_step, any_value(prior_tool_calls) AS prior_tool_calls FROM l JOIN n USING (conv) GROUP BY conv")
def grounding_context(spark, sf):
    n = table(spark, sf, "events").groupBy(F.col("user_id").alias("conv")).agg(F.count("*").alias("prior_tool_calls"))
    pairs = lambda test: F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(test, F.concat_ws("=", "key", "value")))), ","), F.lit(""))
    per = _latest(spark, sf).groupBy("conv").agg(pairs(F.lit(True)).alias("available_values"), pairs(F.col("key") == "view").alias("generated_ids"), F.max("step").alias("current_step"))
    return per.join(n, "conv")


@query("""WITH e AS (SELECT user_id AS conv, event_id AS step, event_type AS key FROM events)
SELECT conv, key, arg_max('ep_' || (step % 7), step) AS endpoint, max(step) AS step FROM e GROUP BY conv, key UNION ALL SELECT conv, 'step_' || step || '.' || key, 'ep_' || (step % 7), step FROM e""")
def provenance(spark, sf):
    """Where each value is from: of a key the latest, and of each step."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("conv"), F.col("event_id").alias("step"), F.col("event_type").alias("key"))
    e = e.withColumn("endpoint", F.concat(F.lit("ep_"), (F.col("step") % 7).cast("string")))
    last = e.groupBy("conv", "key").agg(F.max_by("endpoint", "step").alias("endpoint"), F.max("step").alias("step"))
    return last.unionByName(e.withColumn("key", F.concat(F.lit("step_"), F.col("step").cast("string"), F.lit("."), F.col("key"))))


# ---- texts


@query("""SELECT s_suppkey, s_name || '.' || CASE WHEN s_suppkey % 2 = 0 THEN ' Rows of ' || n_name ELSE '' END || ' Tool: ' || n_name || '. Method: GET. Path: /v1.' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE ' Parameters: city, limit.' END AS text FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def endpoint_texts(spark, sf):
    listed = F.when(F.col("s_suppkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("city"), F.lit("limit")))
    said = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Rows  of "), F.col("n_name"))).otherwise("")
    return endpoints(spark, sf).select("s_suppkey", X.endpoint_text(F.col("s_name"), said, F.col("n_name"), F.lit("GET"), F.lit("/v1"), listed).alias("text"))


@query(f"""WITH {_STEPS}, r AS (SELECT chain, (step + 1) // 2 AS run, string_agg('T' || tool % 25 || ': e' || tool, ', ' ORDER BY step) AS t, count(*) AS n FROM st GROUP BY ALL)
SELECT chain, string_agg(CASE WHEN n > 1 THEN '[' || t || ']' ELSE t END, ' -> ' ORDER BY run) AS text FROM r GROUP BY chain""")
def chain_texts(spark, sf):
    each = steps(spark, sf).select("chain", "step", F.expr("(step + 1) div 2").alias("run"), F.concat(F.lit("T"), F.col("tool") % 25, F.lit(": e"), F.col("tool")).alias("text"))
    per = each.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("step", "run", "text"))).alias("s"))
    return per.select("chain", X.chain_text(F.transform("s", lambda x: F.struct(x["run"].alias("run"), x["text"].alias("text")))).alias("text"))


@query(f"""WITH {_STEPS}, s AS (SELECT *, tool % 25 AS t, row_number() OVER (PARTITION BY chain, tool % 25 ORDER BY step) AS seen FROM st),
k AS (SELECT chain, step, 'do ' || tool AS said FROM s WHERE step <= 2 OR seen = 1),
n AS (SELECT chain, said, row_number() OVER (PARTITION BY chain ORDER BY step) AS i, count(*) OVER (PARTITION BY chain) AS n FROM k),
a AS (SELECT chain, max(n) AS n, max(CASE WHEN i = 1 THEN said END) AS first, max(CASE WHEN i = 2 THEN said END) AS second, max(CASE WHEN i = n THEN said END) AS last, string_agg(CASE WHEN i > 1 AND i < n THEN said END, ', then ' ORDER BY i) AS middle FROM n GROUP BY chain)
SELECT chain, CASE WHEN n = 1 THEN first WHEN n = 2 THEN first || ' and then ' || last WHEN n > 4 AND chain % 2 = 0 THEN first || ', then ' || second || ', and a couple more things after that' ELSE first || ', then ' || middle || ', and finally ' || last END AS task FROM a""")
def task_descriptions(spark, sf):
    each = steps(spark, sf).groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("step", (F.col("tool") % 25).cast("string").alias("tool"), F.concat(F.lit("do "), F.col("tool")).alias("text")))).alias("s"))
    return each.select("chain", X.task(F.transform("s", lambda x: F.struct(x["tool"].alias("tool"), x["text"].alias("text"))), F.col("chain") % 2 == 0).alias("task"))


# ---- responses

_DRAW = lambda pool, *seed: f"'{pool}_' || ({_LOT.format(" || ':' || ".join([f"'{pool}'", *seed]), 900)} + 100)"
_RESP = "SELECT s_suppkey, s_name, ['GET', 'POST', 'DELETE', 'PUT'][s_suppkey % 4 + 1] AS method, CASE WHEN s_suppkey % 8 = 0 THEN '/v1/items/' ELSE '/v1/item' END AS path, ['Finance', 'Travel', 'Music', ''][s_suppkey % 5 % 4 + 1] AS domain, s_suppkey % 3 = 0 AS own, s_suppkey % 6 = 0 AS meta FROM supplier"


def _pair(name: str, expression: str) -> str:
    return f"""'"{name}":"' || {expression} || '"'"""


_OBJECT = " || ',' || ".join(_pair(n, _DRAW(p, f"'{n}'", "s_suppkey")) for n, p in (("id", "id"), ("name", "name"), ("status", "status"), ("created_at", "date")))
_MORE = " || ".join(f"CASE WHEN domain IN ({', '.join(repr(d) for d in ds)}) THEN ',' || {_pair(n, _DRAW(Q.FIELD_OF.get(n, n), f"'{n}'", 's_suppkey'))} ELSE '' END" for n, ds in Q.OBJECT_FIELDS.items())
_ITEM = " || ',' || ".join(_pair(p, _DRAW(p, "i", f"'{p}'", "s_suppkey")) for p in ("id", "name", "status"))
_ITEM_MORE = " || ".join(f"CASE WHEN domain IN ({', '.join(repr(d) for d in ds)}) THEN ',' || {_pair(n, _DRAW(n, f"'{n}'", 'i', 's_suppkey'))} ELSE '' END" for n, ds in Q.ITEM_FIELDS.items())
_ITEMS = f"({_LOT.format("'items:' || s_suppkey", 4)} + 2)"
_KEYED = [("hotel_id", "id"), ("unit_price", "price"), ("is_new", "boolean"), ("notes", "description")]
_FROM_SCHEMA = " || ',' || ".join(_pair(k, _DRAW(p, f"'{k}'", "s_suppkey")) for k, p in _KEYED)


@query(f"""WITH r AS ({_RESP}),
i AS (SELECT s_suppkey, string_agg('{{' || {_ITEM} || {_ITEM_MORE} || '}}', ',' ORDER BY i) AS items FROM (SELECT *, unnest(generate_series(1, {_ITEMS})) AS i FROM r) GROUP BY s_suppkey)
SELECT s_suppkey, CASE WHEN own AND NOT meta THEN '{{' || {_FROM_SCHEMA} || '}}' WHEN own THEN '{{' || {_OBJECT} || {_MORE} || '}}'
 WHEN method = 'DELETE' THEN '{{"status":"success","message":"' || s_name || ' completed successfully"}}' WHEN method = 'GET' AND path = '/v1/items/' THEN '{{"results":[' || items || '],"count":' || {_ITEMS} || '}}' ELSE '{{' || {_OBJECT} || {_MORE} || '}}' END AS response
FROM r JOIN i USING (s_suppkey)""")
def mock_responses(spark, sf):
    pick = lambda c, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (c + 1).cast("int"))
    k = F.col("s_suppkey")
    keys = F.when(k % 6 == 0, F.array(F.lit("type"), F.lit("properties"))).when(k % 3 == 0, F.array(*[F.lit(x) for x in ("hotel_id", "unit_price", "type", "is_new", "notes")]))
    path = F.when(k % 8 == 0, "/v1/items/").otherwise("/v1/item")
    made = Q.response(F.col("s_name"), pick(k % 4, "GET", "POST", "DELETE", "PUT"), path, pick(k % 5 % 4, "Finance", "Travel", "Music", ""), keys, k)
    return table(spark, sf, "supplier").select("s_suppkey", made.alias("response"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'ghost=1' ELSE 'order_id=' || s_suppkey || ',results_0_price=5,total=2' END AS taken FROM supplier""")
def extracted_values(spark, sf):
    data = F.struct(F.col("s_suppkey").cast("string").alias("order_id"), F.lit("1").alias("ghost"), F.lit(2).alias("total"), F.array(F.struct(F.lit("5").alias("price"), F.lit("z").alias("zzz")), F.struct(F.lit("6").alias("price"), F.lit("z").alias("zzz"))).alias("results"))
    keys = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("ghost"), F.lit("gone"))).otherwise(F.array().cast("array<string>"))
    taken = Q.extracted(F.parse_json(F.to_json(data)), keys)
    pairs = F.array_sort(F.transform(F.map_entries(taken), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return table(spark, sf, "supplier").select("s_suppkey", F.array_join(pairs, ",").alias("taken"))


@query("SELECT event_id FROM events WHERE 200 + event_id % 4 * 50 BETWEEN 200 AND 299 AND event_type <> 'purchase'")
def successful_responses(spark, sf):
    e = table(spark, sf, "events").select("event_id", (200 + F.col("event_id") % 4 * 50).alias("status"), F.when(F.col("event_type") == "purchase", "failed").alias("error"))
    return e.where(Q.success(F.col("status"), F.col("error"))).select("event_id")


# ---- reports

_SCORED = "s AS (SELECT lang, quality = 1 AS passed, 1 + doc_id % 5 AS tool_correctness, 1 + doc_id % 4 AS argument_grounding, 2 + doc_id % 3 AS task_completion, 1 + doc_id % 5 AS naturalness FROM labels JOIN documents USING (doc_id))"


def _scored(spark, sf):
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    i = F.col("doc_id")
    return j.select("lang", (F.col("quality") == 1).alias("passed"), (1 + i % 5).alias("tool_correctness"), (1 + i % 4).alias("argument_grounding"), (2 + i % 3).alias("task_completion"), (1 + i % 5).alias("naturalness"))


_REPORT = f"""WITH {_SCORED} SELECT lang, count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, round(count(*) FILTER (passed) / greatest(count(*), 1), 6) AS pass_rate,
{', '.join(f'CAST(round_even(avg({d}), 0) AS INTEGER) AS {d}' for d in P.DIMENSIONS)} FROM s GROUP BY lang"""


@query(_REPORT)
def evaluation_report(spark, sf):
    return P.evaluation(_scored(spark, sf), "lang").withColumn("pass_rate", F.round("pass_rate", 6))


@query(f"""SELECT '{{"lang":"' || lang || '","total":' || total || ',"passed":' || passed || ',"failed":' || failed || ',"note":null}}' AS json FROM ({_REPORT})""")
def report_json(spark, sf):
    return P.as_json(P.evaluation(_scored(spark, sf), "lang").select("lang", "total", "passed", "failed", F.lit(None).cast("string").alias("note")))


@query("""WITH c AS (SELECT l_orderkey, count(*) AS calls, list(DISTINCT l_suppkey) AS tools FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS total_generated, round(avg(calls * 2.0 + 2), 6) AS average_turns, round(avg(calls), 6) AS average_tool_calls, round(avg(o_totalprice), 2) AS average_generation_time_ms, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS tools_coverage,
(SELECT count(DISTINCT s_nationkey) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) AS domain_coverage, 3 AS total_failed, true AS steering_enabled FROM c JOIN orders ON l_orderkey = o_orderkey""")
def batch_stats(spark, sf):
    l = table(spark, sf, "lineitem").join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    per = l.groupBy("l_orderkey").agg(F.count("*").alias("calls"), F.collect_set("l_suppkey").alias("tools"), F.collect_set("s_nationkey").alias("domains"))
    made = per.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select((F.col("calls") * 2.0 + 2).alias("turns"), "calls", F.col("o_totalprice").alias("milliseconds"), "tools", "domains")
    out = P.batch(made, 3, True)
    return out.withColumns({"average_turns": F.round("average_turns", 6), "average_tool_calls": F.round("average_tool_calls", 6), "average_generation_time_ms": F.round("average_generation_time_ms", 2)})


@query("""WITH a AS (SELECT o_custkey AS c, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS attempt, o_totalprice > 150000 AS passed FROM orders), f AS (SELECT c, min(attempt) FILTER (passed) AS first FROM a WHERE attempt <= 4 GROUP BY c)
SELECT CAST(coalesce(first - 1, 3) AS INTEGER) AS attempts, count(*) AS n, count(*) FILTER (first > 1) AS repaired, count(*) FILTER (first IS NULL) AS discarded FROM f GROUP BY 1""")
def repair_stats(spark, sf):
    from pyspark.sql import Window

    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("conversation_id"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("attempt"), (F.col("o_totalprice") > 150000).alias("passed"))
    return P.repairs(a.where("attempt <= 4"), 3)


@query("""WITH p AS (SELECT conv_id AS conv, min(turn) FILTER (role = 'user') AS u, min(turn) FILTER (role = 'assistant' AND length(text) % 2 = 0) AS c, max(turn) AS l FROM conversations GROUP BY conv_id)
SELECT conv, coalesce(CASE WHEN conv % 4 + 1 <= 2 THEN u END, CASE WHEN conv % 3 + 1 <= 2 THEN c END, CASE WHEN conv % 5 + 1 <= 2 THEN l END) AS turn FROM p""")
def problem_turns(spark, sf):
    c = table(spark, sf, "conversations")
    m = c.select(F.col("conv_id").alias("conv"), F.col("turn").alias("pos"), "role", (F.length("text") % 2 == 0).alias("calls"))
    k = F.col("conv")
    return P.problem_turn(m, m.select("conv").distinct().withColumns({"naturalness": k % 4 + 1, "argument_grounding": k % 3 + 1, "task_completion": k % 5 + 1}))


@query("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 4 WHEN 1 THEN 5 ELSE 1 END AS tool_correctness, CASE s_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 1 END AS argument_grounding, 1 AS task_completion, CASE s_suppkey % 4 WHEN 1 THEN 2 ELSE 1 END AS naturalness,
CASE s_suppkey % 4 WHEN 0 THEN 'fine' WHEN 1 THEN 'so so' ELSE 'Failed to parse judge response' END AS reasoning FROM supplier""")
def judge_replies(spark, sf):
    replies = ['{"tool_correctness": 4, "argument_grounding": -2, "reasoning": "fine"}', 'Here: "tool_correctness": 9, "argument_grounding" : 3, "naturalness": 2, "reasoning": "so so" ...', "no scores", ""]
    reply = F.element_at(F.array(*[F.lit(r) for r in replies]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", P.judge_reply(reply).alias("x")).select("s_suppkey", "x.*")


# ---- registry

_RANKED = "t AS (SELECT n_nationkey AS tool, n_regionkey AS domain, count(s_suppkey) AS n_endpoints, ['minimal', 'poor', 'fair', 'good', 'excellent'][n_nationkey % 5 + 1] AS tier, n_nationkey % 5 AS rank, coalesce(bool_or(s_acctbal > 5000), false) AS has_schema FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL)"


def _tools(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    per = n.groupBy(F.col("n_nationkey").alias("tool"), F.col("n_regionkey").alias("domain")).agg(F.count("s_suppkey").alias("n_endpoints"), F.coalesce(F.bool_or(F.col("s_acctbal") > 5000), F.lit(False)).alias("has_schema"))
    return per.withColumn("tier", F.element_at(F.array(*[F.lit(t) for t in R.TIERS]), (F.col("tool") % 5 + 1).cast("int")))


@query(f"WITH {_RANKED} SELECT tool, tier FROM t WHERE rank >= 2")
def tools_by_quality(spark, sf):
    return R.at_least(_tools(spark, sf), "fair").select("tool", "tier")


@query(f"WITH {_RANKED} SELECT tool, domain, tier, n_endpoints, has_schema FROM t WHERE domain IN (0, 1, 3) AND rank >= 1 AND n_endpoints BETWEEN 1 AND 50 AND has_schema")
def tool_filter(spark, sf):
    return R.filter_tools(_tools(spark, sf), [0, 1, 3], "poor", 1, 50, True)


@query(f"WITH {_RANKED} SELECT tool FROM t WHERE domain = 2 ORDER BY md5(CAST(tool AS VARCHAR) || ':42'), tool LIMIT 1")
def random_tool(spark, sf):
    return R.drawn(R.filter_tools(_tools(spark, sf), [2]), "tool").select("tool")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey % 2 = 0 ORDER BY md5(CAST(s_suppkey AS VARCHAR) || ':42'), s_suppkey LIMIT 1")
def random_endpoint(spark, sf):
    return R.drawn(table(spark, sf, "supplier").where("s_nationkey % 2 = 0"), "s_suppkey").select("s_suppkey")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT -1 - s_suppkey, 'new ' || s_name FROM supplier WHERE s_suppkey % 2 = 0")
def registry_add(spark, sf):
    s = table(spark, sf, "supplier")
    more = s.where("s_suppkey % 2 = 0").select((-1 - F.col("s_suppkey")).alias("id"), F.concat(F.lit("new "), F.col("s_name")).alias("name"))
    return R.added(s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), more, "id")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def registry_remove(spark, sf):
    gone = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    return R.removed(table(spark, sf, "supplier"), gone, "s_nationkey").select("s_suppkey", "s_name")


@query("""SELECT n_nationkey, min(s_name) FILTER (s_suppkey = n_nationkey + 1) AS found, coalesce(string_agg(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, ',' ORDER BY s_suppkey), '') AS posts, CASE WHEN n_nationkey % 2 = 0 THEN 'integer' END AS kind FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey""")
def lookups(spark, sf):
    e = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct(F.col("s_suppkey").alias("endpoint_id"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, "POST").otherwise("GET").alias("method")))).alias("endpoints"))
    n = table(spark, sf, "nation").join(e, F.col("n_nationkey") == F.col("k"), "left")
    par = F.array(F.struct(F.when(F.col("n_nationkey") % 2 == 0, "limit").otherwise("q").alias("name"), F.lit("integer").alias("type")))
    posts = F.coalesce(F.array_join(F.transform(R.endpoints_by_method(F.col("endpoints"), "POST"), lambda x: x["name"]), ","), F.lit(""))
    return n.select("n_nationkey", R.endpoint(F.col("endpoints"), F.col("n_nationkey") + 1)["name"].alias("found"), posts.alias("posts"), R.parameter(par, "limit")["type"].alias("kind"))


@query("""WITH d AS (SELECT count(DISTINCT s_nationkey) AS n FROM supplier), r AS (SELECT s_suppkey, s_nationkey, md5(CAST(s_suppkey AS VARCHAR) || ':42') AS h, row_number() OVER (PARTITION BY s_nationkey ORDER BY md5(CAST(s_suppkey AS VARCHAR) || ':42'), s_suppkey) AS k FROM supplier)
SELECT s_suppkey, s_nationkey FROM r, d ORDER BY (k > greatest(1, 40 // greatest(1, n)))::INT, h, s_suppkey LIMIT 40""")
def stratified_fill(spark, sf):
    return R.spread_sample(table(spark, sf, "supplier"), "s_nationkey", "s_suppkey", 40).select("s_suppkey", "s_nationkey")


# ---- graph


def _owned(spark, sf):
    return G.same_tool_edges(table(spark, sf, "nation").select(F.col("n_nationkey").alias("tool")), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("endpoint"), F.col("s_nationkey").alias("tool")))


@query("SELECT 'tool:' || n_nationkey AS node, coalesce(string_agg('ep:' || s_suppkey, ',' ORDER BY 'ep:' || s_suppkey), '') AS endpoints FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey")
def endpoints_of_tools(spark, sf):
    t = table(spark, sf, "nation").select(F.concat(F.lit("tool:"), F.col("n_nationkey")).alias("node"))
    return G.endpoints_of(_owned(spark, sf), t).select("node", F.array_join("endpoints", ",").alias("endpoints"))


@query("SELECT 'ep:' || s_suppkey AS node, 'tool:' || s_nationkey AS tool FROM supplier UNION ALL SELECT 'ep:-' || n_nationkey, NULL FROM nation WHERE n_nationkey > 0")
def tools_of_endpoints(spark, sf):
    e = table(spark, sf, "supplier").select(F.concat(F.lit("ep:"), F.col("s_suppkey")).alias("node")).union(table(spark, sf, "nation").where("n_nationkey > 0").select(F.concat(F.lit("ep:-"), F.col("n_nationkey"))))
    return G.tool_of(_owned(spark, sf), e)


@query("SELECT s_suppkey AS node FROM supplier WHERE s_nationkey = 3")
def domain_endpoints(spark, sf):
    both = nodes(spark, sf).select("node", "domain", F.lit("endpoint").alias("node_type")).unionByName(table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_nationkey").alias("domain"), F.lit("tool").alias("node_type")))
    return G.endpoints_in(both, 3)


@query("""WITH w AS (SELECT p_partkey, unnest(list_filter(string_split_regex(lower(p_name), '[^a-z0-9_]+'), lambda x: x <> '')) AS w FROM part),
c AS (SELECT p_partkey, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 16 AS i, sum(CASE WHEN CAST('0x' || substr(md5(w), 9, 1) AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END) AS v FROM w GROUP BY ALL),
n AS (SELECT p_partkey, sqrt(sum(v * v)) AS norm FROM c GROUP BY p_partkey)
SELECT p_partkey, i, round(CASE WHEN norm > 0 THEN v / norm ELSE v END, 6) AS x FROM c JOIN n USING (p_partkey) WHERE v <> 0""")
def text_embeddings(spark, sf):
    e = G.embedded(table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("text")), "p_partkey", 16)
    return e.select("p_partkey", F.posexplode("embedding").alias("i", "x")).where("x <> 0").select("p_partkey", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@query(f"""WITH {_EDGES.strip()}, {_CHAINS}, d AS (SELECT chain, count(DISTINCT tool % 25) AS tools, count(DISTINCT tool % 5) AS domains, bool_or(tool % 25 = 3) AS bad, bool_or(tool % 25 = 4) AS wanted FROM st GROUP BY chain),
k AS (SELECT a.chain, count(*) AS linked FROM st a JOIN st b ON a.chain = b.chain AND b.step = a.step + 1 JOIN e ON e.src = least(a.tool, b.tool) AND e.dst = greatest(a.tool, b.tool) GROUP BY a.chain)
SELECT chain, CAST(round((n_steps BETWEEN 2 AND 5)::INT + 0.5 * tools + 0.3 * domains + 0.2 * coalesce(linked, 0) - 0.5 * (bad::INT + (NOT wanted)::INT + (NOT n_steps BETWEEN 2 AND 5)::INT + (tools < 2)::INT), 6) AS DOUBLE) AS reward FROM ch JOIN d USING (chain) LEFT JOIN k USING (chain)""")
def chain_reward_full(spark, sf):
    s = steps(spark, sf).select("chain", "step", F.col("tool").alias("node"), (F.col("tool") % 25).alias("tool"), (F.col("tool") % 5).alias("domain"))
    return D.full_reward(s, nodes(spark, sf), 2, 5, 2, [4], [3]).withColumn("reward", F.round("reward", 6))


@query(f"""WITH {_CHAINS}, d AS (SELECT chain, count(DISTINCT tool % 25) AS tools, bool_or(tool % 25 = 3) AS bad, bool_or(tool % 25 = 4) AS wanted, bool_and(tool % 5 IN (0, 1, 4)) AS placed FROM st GROUP BY chain)
SELECT chain FROM ch JOIN d USING (chain) WHERE n_steps BETWEEN 1 AND 5 AND tools >= 1 AND NOT bad AND wanted AND placed""")
def chain_constraints(spark, sf):
    s = steps(spark, sf).select("chain", "step", (F.col("tool") % 25).alias("tool"), (F.col("tool") % 5).alias("domain"))
    return D.full_constraints(s, 1, 5, 1, required=[4], excluded=[3], domains=[0, 1, 4])


# ---- further reports and scores


@query("SELECT a.vec_id, round(list_cosine_similarity(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE)), list_transform(b.embedding, lambda x: CAST(x AS DOUBLE))), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(spark, sf):
    v = table(spark, sf, "embeddings")
    b = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return v.join(b, "vec_id").select("vec_id", F.round(G.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


def _typed_graph(spark, sf):
    n = table(spark, sf, "supplier").select(F.concat(F.lit("ep:"), F.col("s_suppkey")).alias("node"), F.lit("endpoint").alias("node_type")).unionByName(table(spark, sf, "nation").select(F.concat(F.lit("tool:"), F.col("n_nationkey")).alias("node"), F.lit("tool").alias("node_type")))
    near = G.same_domain_pruned(nodes(spark, sf), 2).select(F.concat(F.lit("ep:"), F.col("src")).alias("src"), F.concat(F.lit("ep:"), F.col("dst")).alias("dst"), F.lit("same_domain").alias("edge_type"), "weight")
    return n, _owned(spark, sf).unionByName(near)


@query(f"""WITH {_PRUNED.replace("r <= 3", "r <= 2")} SELECT (SELECT count(*) FROM nation) AS tool_nodes, (SELECT count(*) FROM supplier) AS endpoint_nodes, (SELECT count(*) FROM p) AS same_domain, (SELECT count(*) FROM supplier) AS same_tool,
round(CAST((SELECT count(*) FROM p) + (SELECT count(*) FROM supplier) AS DOUBLE) / (((SELECT count(*) FROM supplier) + 25) * ((SELECT count(*) FROM supplier) + 24)), 9) AS density, 25 AS components""")
def typed_graph_stats(spark, sf):
    s = G.whole_stats(*_typed_graph(spark, sf))
    return s.select("tool_nodes", "endpoint_nodes", F.coalesce(F.col("edge_counts")["same_domain"], F.lit(0)).alias("same_domain"), F.col("edge_counts")["same_tool"].alias("same_tool"), F.round("density", 9).alias("density"), "components")


@query("SELECT 'tool:' || s_nationkey AS node, 'ep:' || s_suppkey AS neighbour, CAST(1 AS DOUBLE) AS weight FROM supplier UNION ALL SELECT 'ep:' || s_suppkey, 'tool:' || s_nationkey, 1 FROM supplier")
def neighbours_by_type(spark, sf):
    return G.neighbours(_typed_graph(spark, sf)[1], ["same_tool"])


_BROKEN = """e AS (SELECT s_nationkey AS tool, 0.05 + 0.1 + 0.05 + CASE WHEN s_suppkey % 2 = 0 THEN 0.3 ELSE 0 END AS score FROM supplier), m AS (SELECT tool, avg(CAST(score AS DOUBLE)) AS mean FROM e GROUP BY tool),
b AS (SELECT n_nationkey AS tool, n_nationkey % 3 > 0 AS described, n_nationkey % 2 = 0 AS placed, mean, (0.1 + CASE WHEN n_nationkey % 3 > 0 THEN 0.15 ELSE 0 END + CASE WHEN n_nationkey % 2 = 0 THEN 0.1 ELSE 0 END + CASE WHEN mean IS NOT NULL THEN 0.15 ELSE 0 END)::DOUBLE + round(0.5 * coalesce(mean, 0), 4) AS score FROM nation LEFT JOIN m ON m.tool = n_nationkey),
k AS (SELECT *, round(score, 4) AS total FROM b)"""


def _broken(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("tool"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 3 > 0, "Rows of all kinds").alias("description"), F.when(F.col("n_nationkey") % 2 == 0, "area").otherwise(" ").alias("domain"))
    e = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("endpoint"), F.col("s_nationkey").alias("tool"), F.col("s_name").alias("name"), F.lit("").alias("description"), F.lit("/x").alias("path"), (F.col("s_suppkey") % 2 == 0).alias("has_schema"))
    none = spark.createDataFrame([], "endpoint long, name string, description string, type string, required boolean, default string")
    return scoring.breakdown(n, e, none)


@query(f"""WITH {_BROKEN} SELECT tool, CAST(total AS DOUBLE) AS score, round(0.5 * coalesce(mean, 0), 4) AS endpoint_quality, array_to_string(list_filter([CASE WHEN NOT described THEN 'tool.description' END, CASE WHEN NOT placed THEN 'tool.domain' END, CASE WHEN mean IS NULL THEN 'tool.endpoints' END], lambda x: x IS NOT NULL), ',') AS missing,
(NOT described)::INT + (NOT placed)::INT + (mean IS NULL)::INT + coalesce(mean < 0.5, false)::INT AS n_recommended FROM k""")
def tool_breakdown(spark, sf):
    return _broken(spark, sf).select("tool", "score", F.col("components")["endpoint_quality"].alias("endpoint_quality"), F.array_join("missing", ",").alias("missing"), F.size("recommended").alias("n_recommended"))


@query(f"""WITH {_BROKEN}, i AS (SELECT unnest(list_filter([CASE WHEN NOT described THEN 'tool.description' END, CASE WHEN NOT placed THEN 'tool.domain' END, CASE WHEN mean IS NULL THEN 'tool.endpoints' END], lambda x: x IS NOT NULL)) AS issue FROM k), c AS (SELECT issue, count(*) AS n FROM i GROUP BY issue)
SELECT count(*) AS total_tools, round(avg(total), 4) AS average_score, count(*) FILTER (total >= 0.8) AS excellent, count(*) FILTER (total >= 0.6 AND total < 0.8) AS good, count(*) FILTER (total >= 0.4 AND total < 0.6) AS fair, count(*) FILTER (total >= 0.2 AND total < 0.4) AS poor, count(*) FILTER (total < 0.2) AS minimal,
(SELECT string_agg(issue, ',' ORDER BY n DESC, issue) FROM c) AS top_issues FROM k""")
def quality_report(spark, sf):
    r = scoring.quality_report(_broken(spark, sf))
    return r.select("total_tools", "average_score", *[F.col("tiers")[t].alias(t) for t in reversed(R.TIERS)], F.array_join("top_issues", ",").alias("top_issues"))


@query("""SELECT o_orderkey AS conv, CAST(o_orderkey % 3 + 1 AS BIGINT) AS num_turns, count(l_orderkey) AS num_tool_calls, count(DISTINCT l_suppkey) AS num_distinct_tools, coalesce(string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)), '') AS tools_used,
coalesce(string_agg(DISTINCT CASE WHEN l_suppkey % 5 > 0 THEN CAST(l_suppkey % 5 AS VARCHAR) END, ',' ORDER BY CASE WHEN l_suppkey % 5 > 0 THEN CAST(l_suppkey % 5 AS VARCHAR) END), '') AS domains, coalesce(string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)), '') AS endpoints
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def call_metadata(spark, sf):
    from loomspark.operators import conversation as C

    m = table(spark, sf, "orders").select(F.col("o_orderkey").alias("conv"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("o_orderkey") % 3)))
    calls = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("conv"), F.col("l_suppkey").alias("tool"), F.when(F.col("l_suppkey") % 5 > 0, (F.col("l_suppkey") % 5).cast("string")).otherwise("").alias("domain"), F.col("l_partkey").alias("endpoint"))
    return C.call_metadata(m, calls)


@query("""WITH u AS (SELECT l_suppkey AS tool, count(*) AS uses FROM lineitem GROUP BY l_suppkey), x AS (SELECT CAST(s_suppkey AS VARCHAR) AS x FROM supplier LEFT JOIN u ON tool = s_suppkey WHERE coalesce(uses, 0) <= (SELECT median(uses) FROM u) ORDER BY 1 LIMIT 3)
SELECT 'Try to incorporate these tools: ' || string_agg(x, ', ' ORDER BY x) || '.' AS text FROM x""")
def steering_tools(spark, sf):
    """No domain is at hand, so tools are steered to."""
    used = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("tool")).agg(F.count("*").alias("uses"))
    none = spark.createDataFrame([], "domain string, uses long")
    return D.steering_prompt(none, none.select("domain"), used, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("tool")))


def _run(label: str) -> str:
    return f"(WITH s AS (SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority = '{label}'), c AS (SELECT l_suppkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM s) GROUP BY l_suppkey), p AS (SELECT string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS k FROM s GROUP BY l_orderkey) SELECT (SELECT log2(sum(n)) - sum(n * log2(n)) / sum(n) FROM c) AS entropy, (SELECT count(*) FROM c) AS tools, (SELECT count(DISTINCT k) FROM p) AS patterns, round((SELECT avg(l_quantity) FROM s), 2) AS score)"


@query(f"""SELECT concat_ws(chr(10), CASE WHEN b.entropy - a.entropy > 0.001 THEN 'Steering increased tool entropy by ' || printf('%.4f', b.entropy - a.entropy) || printf(' (%.4f -> %.4f), indicating a more uniform tool distribution.', a.entropy, b.entropy) WHEN b.entropy - a.entropy < -0.001 THEN 'Steering decreased tool entropy by ' || printf('%.4f', a.entropy - b.entropy) || printf(' (%.4f -> %.4f).', a.entropy, b.entropy) ELSE 'Tool entropy was identical between runs.' END,
CASE WHEN b.tools > a.tools THEN printf('Steering used %d more unique tools (%d -> %d).', b.tools - a.tools, a.tools, b.tools) WHEN b.tools < a.tools THEN printf('Steering used %d fewer unique tools (%d -> %d).', a.tools - b.tools, a.tools, b.tools) END,
CASE WHEN b.patterns > a.patterns THEN printf('Steering produced %d more unique tool combinations (%d -> %d).', b.patterns - a.patterns, a.patterns, b.patterns) END,
CASE WHEN b.score - a.score < -0.01 THEN printf('Quality decreased by %.2f (%.2f -> %.2f) — diversity-quality tradeoff observed.', a.score - b.score, a.score, b.score) WHEN b.score - a.score > 0.01 THEN printf('Quality increased by %.2f (%.2f -> %.2f) — no tradeoff.', b.score - a.score, a.score, b.score) ELSE 'Quality was identical — no tradeoff observed.' END) AS text FROM {_run("1-URGENT")} a, {_run("5-LOW")} b""")
def run_analysis(spark, sf):
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    def run(label):
        mine = joined.where(F.col("o_orderpriority") == label)
        chains = mine.select(F.col("l_orderkey").alias("chain"), F.monotonically_increasing_id().alias("step"), F.col("l_suppkey").alias("tool"))
        return D.metrics(chains).join(mine.agg(F.round(F.avg("l_quantity"), 2).alias("mean_score")), F.lit(True))

    return D.analysis(run("1-URGENT"), run("5-LOW"))


@query("SELECT s_suppkey, substr(sha256('{\"a\":{\"x\":\"' || s_name || '\",\"y\":1},\"b\":' || s_suppkey || '}'), 1, 16) AS key FROM supplier")
def prompt_keys(spark, sf):
    prompt = F.struct(F.col("s_suppkey").alias("b"), F.struct(F.lit(1).alias("y"), F.col("s_name").alias("x")).alias("a"))
    return table(spark, sf, "supplier").select("s_suppkey", S.prompt_key(prompt).alias("key"))


# ---- calls executed, what a tracker counts, records


@query("""SELECT l_orderkey AS conv, CAST(l_linenumber AS BIGINT) AS pos, l_suppkey AS endpoint, l_partkey, CASE WHEN s_suppkey IS NULL THEN 404 ELSE 200 END AS status, CASE WHEN s_suppkey IS NULL THEN 'Endpoint ' || l_suppkey || ' not found' END AS error,
CASE WHEN s_suppkey IS NOT NULL THEN 'city=Rome,order_id=ORD-' || l_orderkey END AS given, CASE WHEN s_suppkey IS NOT NULL THEN 'order_id=ORD-' || l_orderkey END AS ids, CASE WHEN s_suppkey % 2 = 1 THEN 'id,name,order_id,status' WHEN s_suppkey % 2 = 0 THEN 'hotel_id,order_id' END AS taken
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 3 > 0) ON s_suppkey = l_suppkey""")
def executed_calls(spark, sf):
    from loomspark.operators import toolcalls as T

    arguments = F.create_map(F.lit("order_id"), F.concat(F.lit("ORD-"), F.col("l_orderkey")), F.lit("city"), F.lit("Rome"))
    calls = table(spark, sf, "lineitem").select(F.struct("l_orderkey", "l_partkey").alias("conv"), F.col("l_linenumber").cast("long").alias("pos"), F.col("l_suppkey").alias("endpoint"), arguments.alias("arguments"))
    keys = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("hotel_id"), F.lit("type")))
    known = table(spark, sf, "supplier").where("s_suppkey % 3 > 0").select(F.col("s_suppkey").alias("endpoint"), F.col("s_name").alias("name"), F.lit("GET").alias("method"), F.lit("/item").alias("path"), F.lit("").alias("domain"), keys.alias("keys"))
    out = T.executed(calls, known)
    told = lambda m: F.array_join(F.sort_array(F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    data = F.try_variant_get(F.parse_json("data"), "$", "map<string,string>")
    given = F.when(F.col("data").isNotNull(), told(F.map_filter(data, lambda k, v: k.isin("order_id", "city"))))
    return out.select(F.col("conv.l_orderkey").alias("conv"), "pos", "endpoint", F.col("conv.l_partkey").alias("l_partkey"), "status", "error", given.alias("given"), told(F.col("ids")).alias("ids"), F.array_join(F.sort_array(F.map_keys("taken")), ",").alias("taken"))


@query(f"""WITH {_CHAINS}, u AS (SELECT DISTINCT chain, CAST(tool AS VARCHAR) AS t FROM st)
SELECT 'tool' AS kind, t AS key, count(*) AS n FROM u GROUP BY t UNION ALL SELECT 'domain', d, count(*) FROM (SELECT DISTINCT chain, CAST(tool % 5 AS VARCHAR) AS d FROM st) GROUP BY d
UNION ALL SELECT 'pair', a.t || '|' || b.t, count(*) FROM u a JOIN u b ON a.chain = b.chain AND a.t < b.t GROUP BY ALL UNION ALL SELECT 'pattern', pattern, count(*) FROM ch GROUP BY pattern""")
def tracker_counts(spark, sf):
    from loomspark.streaming import tracker

    c = D.chains(steps(spark, sf))
    return tracker.tracked(c.select("tools", F.transform("tools", lambda t: t % 5).alias("domains"), "pattern"))


@query("""SELECT conv_id, '{"conversation_id":"conv_' || conv_id || '","n":' || count(*) || ',"roles":"' || string_agg(role, ',' ORDER BY turn) || '","chars":' || sum(length(text)) || '}' AS json FROM conversations GROUP BY conv_id""")
def conversation_records(spark, sf):
    """Records as JSON lines, read again: their messages are all there, in order."""
    c = table(spark, sf, "conversations")
    messages = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    record = F.to_json(F.struct(F.concat(F.lit("conv_"), F.col("conv_id")).alias("conversation_id"), F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")))
    again = messages.select("conv_id", F.from_json(record, S.RECORD).alias("r"))
    chars = F.aggregate("r.messages", F.lit(0).cast("long"), lambda s, x: s + F.length(x["content"]))
    told = F.to_json(F.struct("r.conversation_id", F.size("r.messages").alias("n"), F.array_join(F.transform("r.messages", lambda x: x["role"]), ",").alias("roles"), chars.alias("chars")))
    return again.select("conv_id", told.alias("json"))


# ---- PageRank, unrolled


def _rank_sql(rounds: int = 100) -> str:
    """As many rounds as the operator may make; the first whose change is small enough counts."""
    out = [f"""WITH {_PRUNED}, t AS (SELECT src, sum(weight) AS total FROM p GROUP BY src), sh AS MATERIALIZED (SELECT p.src, dst, weight / total AS p FROM p JOIN t ON t.src = p.src),
v AS MATERIALIZED (SELECT node, t.src IS NULL AS dangling FROM (SELECT src AS node FROM p UNION SELECT dst FROM p) LEFT JOIN t ON t.src = node), nn AS MATERIALIZED (SELECT count(*) AS n FROM v),
r0 AS MATERIALIZED (SELECT node, dangling, CAST(1.0 AS DOUBLE) / n AS rank, CAST(1 AS DOUBLE) AS change FROM v, nn)"""]
    for k in range(1, rounds + 1):
        out.append(f"""g{k} AS (SELECT dst AS node, sum(rank * sh.p) AS got FROM sh JOIN r{k - 1} ON r{k - 1}.node = src GROUP BY dst),
r{k} AS MATERIALIZED (SELECT r.node, r.dangling, (1 - 0.85) / n + 0.85 * (SELECT coalesce(sum(rank) FILTER (dangling), 0) FROM r{k - 1}) / n + 0.85 * coalesce(got, 0) AS rank, abs((1 - 0.85) / n + 0.85 * (SELECT coalesce(sum(rank) FILTER (dangling), 0) FROM r{k - 1}) / n + 0.85 * coalesce(got, 0) - r.rank) AS change FROM r{k - 1} r LEFT JOIN g{k} USING (node), nn)""")
    every = " UNION ALL ".join(f"SELECT {k} AS k, node, rank, change FROM r{k}" for k in range(1, rounds + 1))
    return ",\n".join(out) + f""", a AS MATERIALIZED ({every}), b AS (SELECT k, sum(change) AS change FROM a GROUP BY k)
SELECT node, round(rank, 6) AS rank FROM a WHERE k = (SELECT coalesce(min(k) FILTER (change < (SELECT n FROM nn) * 1e-6), {rounds}) FROM b)"""


ORACLES["node_importance"] = _rank_sql()
