"""Mock responses: by the fields of a schema, else a list, an object or a status, with values drawn from pools by hash; and what is taken from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions import schema as Y
from loomspark.functions.pools import lot

#: What the name of a field contains and the pool its value is from, in order. `named` needs a domain, `named_city` has city too.
FIELD_POOLS = [
    ("id", "id"), ("title", "name"), ("name", "name"), ("email", "email"), ("phone", "phone"), ("url", "url"), ("link", "url"), ("price", "price"), ("cost", "price"), ("amount", "price"),
    ("date", "date"), ("time", "date"), ("status", "status"), ("rating", "rating"), ("score", "rating"), ("description", "description"), ("summary", "description"),
    ("count", "integer"), ("total", "integer"), ("quantity", "integer"), ("country", "country"), ("city", "city"), ("active", "boolean"), ("enabled", "boolean"),
]
#: Keys of a schema that are not fields of the response.
META_KEYS = "type properties required items additionalProperties".split()
#: Parts of keys whose values later calls may use.
EXTRACTABLE = "id name title url link date time price cost amount status email count total".split()
#: Further fields of a list's items and of an object, by domain.
ITEM_FIELDS = {"price": ("Finance", "Commerce"), "currency": ("Finance", "Commerce"), "rating": ("Music", "Entertainment"), "city": ("Travel", "Location")}
OBJECT_FIELDS = {"amount": ("Finance", "Commerce"), "currency": ("Finance", "Commerce"), "destination": ("Travel",), "rating": ("Music", "Entertainment")}
FIELD_OF = {"amount": "price", "destination": "city"}


def field_pool(key: Column, domain: Column) -> Column:
    """The pool of a field's value: of the first part that its name contains; without a domain a name is a person's, or a city's."""
    low, placed = F.lower(key), F.coalesce(domain, F.lit("")) != ""
    out = F.when(low.startswith("is_"), "boolean").otherwise("description")
    for part, pool in reversed(FIELD_POOLS):
        made = F.lit(pool)
        if part == "name":
            made = F.when(placed, "name").when(F.contains(low, F.lit("city")), "city").otherwise("person_name")
        out = F.when(F.contains(low, F.lit(part)), made).otherwise(out)
    return out


def drawn(pool: Column, *seed: Column) -> Column:
    """A value of a pool by hash, where pools hold numbered samples: its name and a number."""
    return F.concat(pool, F.lit("_"), (lot(900, pool, *seed) + 100).cast("string"))


def from_schema(keys: Column, domain: Column, *seed: Column) -> Column:
    """A map with a value for each key of the schema that isn't a meta key."""
    fields = F.filter(F.array_distinct(keys), lambda k: ~k.isin(META_KEYS))
    return F.map_from_arrays(fields, F.transform(fields, lambda k: drawn(field_pool(k, domain), k, *seed)))


def _extras(fields: dict[str, tuple[str, ...]], domain: Column, *seed: Column) -> list[Column]:
    return [F.when(domain.isin(list(domains)), drawn(F.lit(FIELD_OF.get(name, name)), F.lit(name), *seed)).alias(name) for name, domains in fields.items()]


def object_response(domain: Column, *seed: Column) -> Column:
    """JSON with id, name, status, created_at and the domain's fields."""
    first = [drawn(F.lit(pool), F.lit(name), *seed).alias(name) for name, pool in (("id", "id"), ("name", "name"), ("status", "status"), ("created_at", "date"))]
    return F.to_json(F.struct(*first, *_extras(OBJECT_FIELDS, domain, *seed)))


def list_response(domain: Column, *seed: Column) -> Column:
    """JSON with two to five results and their count."""
    n = (lot(4, F.lit("items"), *seed) + 2).cast("int")

    def item(i: Column) -> Column:
        own = [drawn(F.lit(pool), i, F.lit(pool), *seed).alias(pool) for pool in ("id", "name", "status")]
        return F.struct(*own, *_extras(ITEM_FIELDS, domain, i, *seed))

    return F.to_json(F.struct(F.transform(F.sequence(F.lit(1), n), item).alias("results"), n.alias("count")))


def status_response(name: Column) -> Column:
    return F.to_json(F.struct(F.lit("success").alias("status"), F.concat(name, F.lit(" completed successfully")).alias("message")))


def response(name: Column, method: Column, path: Column, domain: Column, keys: Column, *seed: Column) -> Column:
    """The mock response of a call as JSON: by the schema's keys if any are fields, else by method and path."""
    shape = Y.response_shape(method, path)
    made = from_schema(F.coalesce(keys, F.array().cast("array<string>")), domain, *seed)
    plain = F.when(shape == "status", status_response(name)).when(shape == "list", list_response(domain, *seed)).otherwise(object_response(domain, *seed))
    by_schema = F.coalesce(F.size(keys) > 0, F.lit(False))
    return F.when(by_schema & (F.size(made) > 0), F.to_json(made)).when(by_schema, object_response(domain, *seed)).otherwise(plain)


def success(status: Column, error: Column) -> Column:
    return status.between(200, 299) & error.isNull()


def extracted(data: Column, keys: Column) -> Column:
    """data (VARIANT object): the values of the schema's keys, or without a schema those whose keys have a part of EXTRACTABLE,
    and of the first of `results` as results_0_key. A map of texts."""
    useful = lambda k: F.exists(F.array(*[F.lit(x) for x in EXTRACTABLE]), lambda part: F.contains(F.lower(k), part))
    fields = lambda path: F.coalesce(F.try_variant_get(data, path, "map<string,string>"), F.create_map().cast("map<string,string>"))
    top = fields("$")
    asked = F.map_filter(top, lambda k, v: F.array_contains(keys, k))
    nested = F.transform_keys(F.map_filter(fields("$.results[0]"), lambda k, v: useful(k)), lambda k, v: F.concat(F.lit("results_0_"), k))
    return F.when(F.size(keys) > 0, asked).otherwise(F.map_concat(F.map_filter(top, lambda k, v: useful(k)), nested))
