"""Nested response schemas and mock responses: flattening, paths, values by the name of a field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text as X

#: Levels of nesting that flatten() follows unless told otherwise.
DEPTH = 8


def flatten(schemas: DataFrame, key: str, depth: int = DEPTH) -> DataFrame:
    """schemas(key, schema VARIANT) of properties: key, path, name, type, description, extracts for each field at any level.

    Objects nest under `properties` and arrays under `items`, whose fields have `[]` in their path. One
    explode for each level; fields below `depth` levels raise, so that none is lost.
    """
    get = lambda path, kind="string": F.try_variant_get("field", path, kind)
    level = schemas.select(key, F.lit("").alias("prefix"), F.try_variant_get("schema", "$.properties", "map<string,variant>").alias("fields"))
    out = None
    for i in range(depth + 1):
        f = level.select(key, "prefix", F.explode("fields").alias("name", "field")).withColumn("path", F.concat("prefix", "name"))
        rows = f.select(key, "path", "name", F.lower(F.coalesce(get("$.type"), F.lit("any"))).alias("type"), get("$.description").alias("description"), X.extractable(F.col("name")).alias("extracts"))
        inside, items = get("$.properties", "map<string,variant>"), get("$.items.properties", "map<string,variant>")
        level = f.select(key, F.when(inside.isNotNull(), F.concat("path", F.lit("."))).otherwise(F.concat("path", F.lit(".[]."))).alias("prefix"), F.coalesce(inside, items).alias("fields")).where("fields IS NOT NULL")
        if i == depth:
            rows = rows.where(F.raise_error(F.concat(F.lit(f"schema deeper than {depth} levels: "), "path")).cast("boolean"))
        out = rows if out is None else out.unionByName(rows)
    return out


def resolve(schema: Column, path: str) -> Column:
    """The field (VARIANT) at a dotted path; a number or [] steps into an array's items; null if there is none."""
    at = "$"
    for step in path.split("."):
        at += ".items" if step == "[]" or step.isdigit() else f".properties.{step}"
    return F.try_variant_get(schema, at, "variant")


def draw(values: Column, *seed: Column) -> Column:
    """One of an array's values by the hash of the seed; null of an empty array."""
    return F.when(F.size(values) > 0, F.element_at(values, (F.pmod(F.xxhash64(*seed), F.size(values)) + 1).cast("int")))


def value_for(name: Column, *seed: Column) -> Column:
    """A made-up value for a field, by the kind that its name shows and the hash of the seed: reruns agree."""
    h = F.pmod(F.xxhash64(name, *seed), F.lit(9000)) + 1000
    day = F.date_add(F.lit("2024-01-01"), F.pmod(h, F.lit(365)).cast("int")).cast("string")
    kinds = {"id": F.concat(X.slug(name), F.lit("-"), h), "name": F.concat(F.lit("Item "), h), "url": F.concat(F.lit("https://example.com/"), h), "date": day, "count": (h % 100).cast("string"), "status": F.lit("active")}
    out, kind = F.concat(X.slug(name), F.lit("_"), h), X.extractable(name)
    for k, made in kinds.items():
        out = F.when(kind == k, made).otherwise(out)
    return out


def response_shape(method: Column, path: Column) -> Column:
    """What an endpoint without a schema answers with: status, object or list."""
    return F.when(method == "DELETE", "status").when(method.isin("POST", "PUT"), "object").when((method == "GET") & F.rtrim(path, F.lit("/")).endswith("s"), "list").otherwise("object")


def valid_response(method: Column, keys: Column) -> Column:
    """A response isn't empty; that of DELETE has status, that of POST an id."""
    needed = F.when(method == "DELETE", F.array_contains(keys, "status")).when(method == "POST", F.array_contains(keys, "id")).otherwise(F.lit(True))
    return (F.size(keys) > 0) & needed
