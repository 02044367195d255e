"""Heterogeneous JSON tool definitions and JSON-lines records as tables.

Files are read whole and parsed to VARIANT, so that no schema is inferred; a file that isn't JSON counts as
failed and yields nothing. Aliases are resolved by the first value that isn't null; empty strings win.
"""

from __future__ import annotations

import copy
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions import text as X
from loomspark.functions.arguments import coerced

#: Fixed spellings of the fields, tried in this order.
TOOL = {"tool_id": "tool_id id api_id tool_name_id", "name": "name tool_name api_name title", "description": "description desc tool_description summary", "domain": "domain category category_name type", "base_url": "base_url api_host host server_url home_url"}
ENDPOINT = {"name": "name api_name operation_id summary", "description": "description api_description desc", "method": "method http_method request_method", "path": "path url api_url endpoint"}
PARAMETER = {"name": "name param_name parameter_name key", "description": "description desc parameter_description", "type": "type param_type data_type schema.type", "required": "required is_required optional", "default": "default default_value example", "location": "in location param_in"}
ENDPOINT_LISTS = "endpoints api_list apis operations paths"
#: Where a response's schema may stand besides `schema`; the formats that are told apart.
RESPONSES = "response response_schema responses output"
FORMATS = ("single_tool", "tool_list", "toolbench_v1", "toolbench_v2", "openapi")

RECORD = T.StructType(
    [
        T.StructField("conversation_id", T.StringType()),
        T.StructField("messages", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType()), T.StructField("tool_calls", T.StringType()), T.StructField("tool_call_id", T.StringType())]))),
        T.StructField("judge_scores", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("metadata", T.StringType()),
        T.StructField("__metadata__", T.StringType()),
    ]
)


def scan(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """file, raw (VARIANT, null if the file isn't JSON): one row for each .json file below path, which may be a file or a pattern.

    With strict a file that isn't JSON raises.
    """
    files = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    raw = F.parse_json("value") if strict else F.try_parse_json("value")
    return files.select(F.col("_metadata.file_path").alias("file"), raw.alias("raw"))


def _get(v: Column, names: str, kind: str = "string") -> Column:
    return F.coalesce(*[F.try_variant_get(v, f"$.{n}", kind) for n in names.split()])


def _is(v: Column, path: str, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith(kind), F.lit(False))


def _there(v: Column, name: str) -> Column:
    """Whether an object has this field with another value than null."""
    found = F.try_variant_get(v, f"$.{name}", "variant")
    return found.isNotNull() & ~F.is_variant_null(found)


def response_schema(raw: Column) -> Column:
    """struct(has_schema, status, description, keys) of an endpoint's definition.

    A `schema` object with fields wins, its keys are the response's; else the first of RESPONSES that isn't null counts as
    a schema, with status and description if it is an object.
    """
    fields = F.map_keys(F.try_variant_get(raw, "$.schema", "map<string,variant>"))
    own = _is(raw, "$.schema", "OBJECT") & (F.size(fields) > 0)
    status = lambda *paths: F.coalesce(*[F.nullif(F.try_variant_get(raw, p, "int"), F.lit(0)) for p in paths], F.lit(200))
    shape = lambda has, code, text, keys: F.struct(F.lit(has).alias("has_schema"), code.alias("status"), text.alias("description"), keys.alias("keys"))
    none = F.array().cast("array<string>")
    out = shape(False, F.lit(None).cast("int"), F.lit(""), none)
    for name in reversed(RESPONSES.split()):
        text = F.coalesce(F.try_variant_get(raw, f"$.{name}.description", "string"), F.lit(""))
        code = F.when(_there(raw, f"{name}.status_code"), status(f"$.{name}.status_code")).otherwise(status(f"$.{name}.code"))
        out = F.when(_there(raw, name), shape(True, code, text, none)).otherwise(out)
    return F.when(own, shape(True, status("$.statuscode"), F.lit(""), F.coalesce(fields, none))).otherwise(out)


def file_format(raw: Column) -> Column:
    top = F.schema_of_variant(raw)
    has = lambda name: F.try_variant_get(raw, f"$.{name}", "variant").isNotNull()
    named = has("name") | has("tool_name") | has("api_name") | has("title")
    single, array, v1, v2, openapi = FORMATS
    return (
        F.when(raw.isNull(), None).when(top.startswith("ARRAY"), array).when(has("openapi") | has("swagger"), openapi)
        .when(_is(raw, "$.tools", "ARRAY"), v1).when(_is(raw, "$.api_list", "ARRAY") & ~named, v2).when(top.startswith("OBJECT"), single)
    )


def records(files: DataFrame) -> DataFrame:
    """One row for each tool definition in the files, by format; members that aren't objects are dropped."""
    f = files.withColumn("format", file_format(F.col("raw"))).where("format IS NOT NULL AND format <> 'openapi'")
    members = F.when(F.col("format") == "tool_list", F.try_variant_get("raw", "$", "array<variant>")).when(F.col("format") == "toolbench_v1", F.try_variant_get("raw", "$.tools", "array<variant>")).otherwise(F.array("raw"))
    return f.select("file", "format", F.posexplode(members).alias("position", "raw")).where(F.schema_of_variant("raw").startswith("OBJECT"))


def tools(recs: DataFrame, most: int | None = None) -> DataFrame:
    """tool_id, name, description, domain, base_url, endpoints; the first of each id by file and position, the first `most` of all."""
    r = F.col("raw")
    name = _get(r, TOOL["name"])
    tool_id = F.coalesce(_get(r, TOOL["tool_id"]), F.nullif(X.slug(name), F.lit("")))
    domain = F.coalesce(_get(r, TOOL["domain"]), F.nullif(F.replace(F.regexp_extract("file", r"(?:^|/)tools/([^/]+)/", 1), F.lit("_"), F.lit(" ")), F.lit("")))
    listed = F.coalesce(*[F.try_variant_get(r, f"$.{n}", "array<variant>") for n in ENDPOINT_LISTS.split()], F.array().cast("array<variant>"))
    out = recs.select("file", "position", tool_id.alias("tool_id"), F.coalesce(name, tool_id).alias("name"), F.coalesce(_get(r, TOOL["description"]), F.lit("")).alias("description"), domain.alias("domain"), X.base_url(_get(r, TOOL["base_url"])).alias("base_url"), listed.alias("endpoints"))
    out = out.where("tool_id IS NOT NULL")
    least = out.groupBy("tool_id").agg(F.min(F.struct("file", "position")).alias("first"))
    out = out.join(least, "tool_id").where(F.struct("file", "position") == F.col("first"))
    if most is not None:
        out = out.orderBy("file", "position").limit(most)
    return out.drop("first", "file", "position")


def endpoints(tool_table: DataFrame) -> DataFrame:
    """endpoint_id, tool_id, ordinal, name, method, path, description, parameters, response (see response_schema)."""
    e = tool_table.select("tool_id", F.posexplode("endpoints").alias("ordinal", "raw")).where(F.schema_of_variant("raw").startswith("OBJECT"))
    r = F.col("raw")
    path = F.coalesce(X.path_of(_get(r, ENDPOINT["path"])), F.lit("/"))
    get = X.method(F.coalesce(_get(r, ENDPOINT["method"]), F.lit("GET")))
    empty = F.array().cast("array<variant>")
    of = lambda n: F.coalesce(F.try_variant_get(r, f"$.{n}", "array<variant>"), empty)
    needed, free = of("required_parameters"), of("optional_parameters")
    split = F.size(needed) + F.size(free) > 0
    mark = lambda a, flag: F.transform(a, lambda p: F.struct(F.lit(flag).cast("boolean").alias("forced"), p.alias("p")))
    parameters = F.when(split, F.concat(mark(needed, True), mark(free, False))).otherwise(F.concat(mark(of("parameters"), None), mark(of("params"), None)))
    out = e.select("tool_id", "ordinal", F.coalesce(_get(r, ENDPOINT["name"]), path).alias("name"), get.alias("method"), path.alias("path"), F.coalesce(_get(r, ENDPOINT["description"]), F.lit("")).alias("description"), parameters.alias("parameters"), response_schema(r).alias("response"))
    return out.withColumn("endpoint_id", X.endpoint_id(F.col("tool_id"), F.col("method"), F.col("path")))


def _default_type(default: Column, name: Column) -> Column:
    """As ingest infers it: from what kind of JSON the default is, else from the name."""
    shape = F.schema_of_variant(default)
    kinds = {"BOOLEAN": "boolean", "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "ARRAY": "array", "OBJECT": "object"}
    out = X.infer_type(name)
    for start, kind in kinds.items():
        out = F.when(shape.startswith(start), kind).otherwise(out)
    return out


def parameters(endpoint_table: DataFrame) -> DataFrame:
    """endpoint_id, ordinal, name, type, inferred, required, description, default (as text), location, enum_values.

    A parameter that is just a name is required unless listed as optional. Where a definition has the field `optional`,
    what it says of being required is turned round. Without a type it is inferred from the default, else the name.
    """
    p = endpoint_table.select("endpoint_id", F.posexplode("parameters").alias("ordinal", "x"))
    r = F.col("x.p")
    text = F.when(F.schema_of_variant(r) == "STRING", F.try_variant_get(r, "$", "string"))
    name = F.coalesce(text, _get(r, PARAMETER["name"]), F.lit("unknown"))
    given = F.trim(_get(r, PARAMETER["type"]))
    default = F.coalesce(*[F.when(_there(r, n), F.try_variant_get(r, f"$.{n}", "variant")) for n in PARAMETER["default"].split()])
    inferred = F.coalesce(given, F.lit("")) == ""
    kind = F.when(text.isNotNull(), "string").when(inferred, _default_type(default, name)).otherwise(X.parameter_type(given))
    said = X.truthy(_get(r, PARAMETER["required"]))
    optional = F.coalesce(F.array_contains(F.map_keys(F.try_variant_get(r, "$", "map<string,variant>")), "optional"), F.lit(False))
    required = F.coalesce(F.col("x.forced"), text.isNotNull() | F.coalesce(F.when(optional, ~said).otherwise(said), F.lit(False)))
    return p.where(F.schema_of_variant(r).startswith("OBJECT") | text.isNotNull()).select(
        "endpoint_id", "ordinal", X.parameter_name(name).alias("name"), kind.alias("type"), (inferred & text.isNull()).alias("inferred"), required.alias("required"),
        F.coalesce(_get(r, PARAMETER["description"]), F.lit("")).alias("description"), F.try_variant_get(default, "$", "string").alias("default"),
        X.location(F.coalesce(_get(r, PARAMETER["location"]), F.lit(""))).alias("location"), F.try_variant_get(r, "$.enum", "array<string>").alias("enum_values"),
    )


def load_stats(files: DataFrame, tool_table: DataFrame, endpoint_table: DataFrame, parameter_table: DataFrame) -> DataFrame:
    """One row: files, failed_files, tools, endpoints, parameters, inferred_types."""
    one = files.agg(F.count("*").alias("files"), F.count_if(F.col("raw").isNull()).alias("failed_files"))
    for table, name in ((tool_table, "tools"), (endpoint_table, "endpoints")):
        one = one.join(table.agg(F.count("*").alias(name)), F.lit(True))
    return one.join(parameter_table.agg(F.count("*").alias("parameters"), F.count_if("inferred").alias("inferred_types")), F.lit(True))


def _filled(*values: Column) -> Column:
    """The first of texts that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def _or(r: Column, names: str) -> Column:
    return _filled(*[F.try_variant_get(r, f"$.{n}", "string") for n in names.split()])


def tool_fields(raw: Column) -> Column:
    """struct of a raw tool's cleaned fields; empty values are passed over, where tools() lets them win."""
    name = X.clean_name(F.coalesce(_or(raw, "name tool_name"), F.lit("")))
    tool_id = _filled(X.identifier(_or(raw, "tool_id id")), X.slug(name))
    return F.struct(
        tool_id.alias("tool_id"), name.alias("name"), X.description(_or(raw, "description desc summary"), name).alias("description"),
        X.clean_name(F.coalesce(_or(raw, "domain category category_name"), F.lit(""))).alias("domain"), F.coalesce(X.base_url(_or(raw, "base_url api_host host")), F.lit("")).alias("base_url"),
    )


def endpoint_fields(raw: Column) -> Column:
    """struct of a raw endpoint's cleaned fields."""
    name = X.clean_name(F.coalesce(_or(raw, "name api_name operation_id"), F.lit("")))
    return F.struct(name.alias("name"), X.description(_or(raw, "description api_description desc"), name).alias("description"), X.method(F.coalesce(_or(raw, "method http_method"), F.lit("GET"))).alias("method"), X.template_path(F.coalesce(_or(raw, "path url api_url endpoint"), F.lit("/"))).alias("path"))


def parameter_fields(raw: Column) -> Column:
    """struct of a raw parameter's cleaned fields; a default of 0 or false is passed over as an empty one is."""
    said = _parameter_said(raw)
    return _parameter_cleaned(said, X.parameter_type(said["type"]))


def with_parameter_fields(df: DataFrame, raw: str, name: str) -> DataFrame:
    """df with the column parameter_fields(raw) under this name. Each step is a column, so that it is taken once a row and not for each use."""
    said = _parameter_said(F.col(raw))
    out = df.withColumns({f"_said_{k}": v for k, v in said.items()}).withColumn("_kind", X.parameter_type(F.col("_said_type")))
    return out.select(*df.columns, _parameter_cleaned({k: F.col(f"_said_{k}") for k in said}, F.col("_kind")).alias(name))


def _parameter_said(raw: Column) -> dict[str, Column]:
    empty = lambda c: F.when(c.isin("0", "0.0", "false", "[]", "{}"), F.lit(None)).otherwise(c)
    return {
        "name": F.coalesce(_or(raw, "name param_name key"), F.lit("")), "description": _or(raw, "description desc"), "type": F.coalesce(_or(raw, "type param_type data_type"), F.lit("")),
        "location": F.coalesce(_or(raw, "in location param_in"), F.lit("")), "required": F.coalesce(F.try_variant_get(raw, "$.required", "string"), F.try_variant_get(raw, "$.is_required", "string")),
        "default": _filled(*[empty(F.try_variant_get(raw, f"$.{n}", "string")) for n in ("default", "default_value")]), "enum": F.try_variant_get(raw, "$.enum", "array<string>"),
    }


def _parameter_cleaned(said: dict[str, Column], kind: Column) -> Column:
    name = X.clean_name(said["name"])
    return F.struct(
        name.alias("name"), X.description(said["description"], name).alias("description"), F.when(kind == "unknown", "string").otherwise(kind).alias("type"), (kind != "unknown").alias("has_type"),
        X.location(said["location"]).alias("location"), X.required_flag(said["required"]).alias("required"), coerced(said["default"], kind).alias("default"), said["enum"].alias("enum_values"),
    )


def read_records(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Conversation records of JSON lines; header lines are left out. DROPMALFORMED skips bad lines."""
    return spark.read.schema(RECORD).option("mode", mode).json(path).where("__metadata__ IS NULL").drop("__metadata__")


def write_records(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_header(spark: SparkSession, path: str, settings: dict, mode: str = "errorifexists") -> None:
    """A first file of JSON lines with the run's settings; read_records leaves it out, read_header and run_settings find it."""
    spark.createDataFrame([(json.dumps({"__metadata__": True, "run_config": settings}),)], "value string").coalesce(1).write.mode(mode).text(path)


def run_settings(spark: SparkSession, path: str) -> dict | None:
    """The settings that a run was made with: of its header, else the metadata of its first record; null for neither."""
    lines = spark.read.text(path).select("value", F.try_parse_json("value").alias("v"))
    head = lines.where(F.try_variant_get("v", "$.__metadata__", "boolean")).select("value").head()
    if head:
        return json.loads(head[0]).get("run_config")
    first = lines.where(F.try_variant_get("v", "$.metadata", "variant").isNotNull()).select(F.to_json(F.try_variant_get("v", "$.metadata", "variant"))).head()
    return json.loads(first[0]) if first else None


def with_settings(records: DataFrame, settings: dict) -> DataFrame:
    """records with the run's settings as JSON in each."""
    return records.withColumn("run_config", F.lit(json.dumps(settings, sort_keys=True)))


def registry_json(tool_table: DataFrame, endpoint_table: DataFrame, parameter_table: DataFrame) -> DataFrame:
    """tool_id, json: each tool with its endpoints and their parameters, in order."""
    per = lambda df, key, *order: df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in (key, *order)]))).alias("_list"))
    with_parameters = endpoint_table.join(per(parameter_table, "endpoint_id", "ordinal"), "endpoint_id", "left").withColumnRenamed("_list", "parameters")
    whole = tool_table.join(per(with_parameters, "tool_id", "endpoint_id"), "tool_id", "left").withColumnRenamed("_list", "endpoints")
    return whole.select("tool_id", F.to_json(F.struct(*whole.columns)).alias("json"))


def registry_of_json(lines: DataFrame) -> DataFrame:
    """lines(json) as records() gives them: file, format, position, raw; feed them to tools()."""
    return lines.select(F.lit("").alias("file"), F.lit(FORMATS[0]).alias("format"), F.xxhash64("json").alias("position"), F.try_parse_json("json").alias("raw")).where(F.schema_of_variant("raw").startswith("OBJECT"))


def cache_put(prompts: DataFrame, path: str, at: Column) -> None:
    """Appends prompts(key, response) to a cache table, with the time; cached() takes the latest."""
    prompts.select("key", "response", at.cast("timestamp").alias("cached_at")).write.mode("append").parquet(path)


def save(path: str, mode: str = "overwrite", **tables: DataFrame) -> None:
    """Each table as Parquet, with a manifest of row counts and checksums."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{path}/{name}")
        n, check = spark.read.parquet(f"{path}/{name}").agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64(*df.columns)), F.lit(0))).head()
        rows.append((name, n, check))
    spark.createDataFrame(rows, "name string, rows long, checksum long").coalesce(1).write.mode(mode).json(f"{path}/_manifest")


def load(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A saved table; fails if it doesn't match its manifest."""
    df = spark.read.parquet(f"{path}/{name}")
    want = spark.read.schema("name string, rows long, checksum long").json(f"{path}/_manifest").where(F.col("name") == name).head()
    n, check = df.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64(*df.columns)), F.lit(0))).head()
    if want is None or (want.rows, want.checksum) != (n, check):
        raise ValueError(f"{name} doesn't match its manifest")
    return df


def read_header(spark: SparkSession, path: str) -> dict | None:
    """The header of a JSON-lines file: its first line, if that is an object with __metadata__."""
    first = spark.read.text(path).head()
    try:
        found = json.loads(first[0]) if first else None
    except ValueError:
        return None
    return found if isinstance(found, dict) and found.get("__metadata__") else None


def record_count(spark: SparkSession, path: str) -> int:
    """Records of a JSON-lines file, without headers, blank and malformed lines."""
    v = F.try_parse_json("value")
    head = F.coalesce(F.try_variant_get(v, "$.__metadata__", "boolean"), F.lit(False))
    return spark.read.text(path).where(v.isNotNull() & ~head).count()


def info(spark: SparkSession, path: str) -> DataFrame:
    """name, rows, checksum of the saved tables, from the manifest alone."""
    return spark.read.schema("name string, rows long, checksum long").json(f"{path}/_manifest")


def record_errors(lines: DataFrame) -> DataFrame:
    """lines(value) of JSON: every violation of the record format, in a fixed order; valid if none."""
    v = F.try_parse_json("value")
    has = lambda name: F.try_variant_get(v, f"$.{name}", "variant").isNotNull()
    messages = F.coalesce(F.try_variant_get(v, "$.messages", "array<variant>"), F.array().cast("array<variant>"))
    role = lambda m: F.coalesce(F.try_variant_get(m, "$.role", "string"), F.lit(""))
    calls = lambda m: F.try_variant_get(m, "$.tool_calls", "variant")
    found = F.array(
        F.when(v.isNull(), "not JSON"),
        F.when(v.isNotNull() & ~has("conversation_id"), "no conversation_id"),
        F.when(v.isNotNull() & ~_is(v, "$.messages", "ARRAY"), "messages is not a list"),
        F.when(_is(v, "$.messages", "ARRAY") & (F.size(messages) == 0), "no messages"),
        F.when(F.exists(messages, lambda m: ~role(m).isin("user", "assistant", "tool", "system")), "unknown role"),
        F.when(F.exists(messages, lambda m: calls(m).isNotNull() & ~F.schema_of_variant(calls(m)).startswith("ARRAY")), "tool_calls is not a list"),
        F.when(has("judge_scores") & ~_is(v, "$.judge_scores", "OBJECT") & ~_is(v, "$.judge_scores", "VOID"), "judge_scores is not an object"),
        F.when(v.isNotNull() & ~_is(v, "$.metadata", "OBJECT"), "metadata is not an object"),
    )
    return lines.select("value", F.array_compact(found).alias("errors")).withColumn("valid", F.size("errors") == 0)


# ---- configuration and cached replies


def load_config(path: str | None, defaults: dict, overrides: dict | None = None) -> dict:
    """Settings of a JSON (or, with PyYAML, YAML) file over the defaults; overrides name their place as a__b.

    A path of None gives the defaults. Overrides of unknown places and of None are left out.
    """
    given: dict = {}
    if path:
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if path.endswith((".yaml", ".yml")):
            import yaml

            given = yaml.safe_load(text) or {}
        else:
            given = json.loads(text)

    def over(base: dict, more: dict) -> dict:
        return base | {k: over(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in more.items()}

    out = over(copy.deepcopy(defaults), given)
    for name, value in (overrides or {}).items():
        *parents, last = name.split("__")
        at = out
        for part in parents:
            at = at.get(part, {}) if isinstance(at, dict) else {}
        if value is not None and isinstance(at, dict) and last in at:
            at[last] = value
    return out


def canonical(prompt: Column) -> Column:
    """A struct or map as JSON with sorted keys at every level."""
    return F.to_json(F.parse_json(F.to_json(prompt)))  # a VARIANT keeps its keys in order


def prompt_key(prompt: Column) -> Column:
    """The 16 hex digits that a prompt is cached under, whatever the order of its keys."""
    return F.substring(F.sha2(canonical(prompt).cast("binary"), 256), 1, 16)


def cached(prompts: DataFrame, cache: DataFrame, now: Column, ttl_seconds: int | None = None) -> DataFrame:
    """prompts(key, ...) with the response of cache(key, response, cached_at), the latest that hasn't expired, or null."""
    fresh = cache if ttl_seconds is None else cache.where(F.col("cached_at").cast("double") + ttl_seconds >= now.cast("double"))
    latest = fresh.groupBy("key").agg(F.max_by("response", "cached_at").alias("response"))
    return prompts.join(latest, "key", "left")
