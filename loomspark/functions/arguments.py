"""Arguments of calls: matched to values that earlier calls gave, else from enums, defaults, placeholders or pools.

Values at hand are an array of structs (key, value, kind) in the order in which they came; a key with a dot is
one of a certain step. The first that fits wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions.pools import lot

#: Words of a parameter's name, words of the key of a value that may stand for it, and the kind of that value.
FAMILIES = [
    ("id", "id", "string"),
    ("name title label", "name title", "string"),
    ("city location place destination address", "city location destination", "string"),
    ("date time start end check", "date time created", "string"),
    ("price cost amount budget", "price cost amount", "number"),
    ("status state", "status", "string"),
    ("email mail", "email", "string"),
    ("url link href", "url link", "string"),
]
#: The JSON type of a parameter's type; all others are strings.
JSON_TYPES = "integer number boolean array object".split()
#: The pool of a fresh value for a type.
FRESH = {"integer": "integer", "number": "price", "boolean": "boolean", "date": "date", "datetime": "date"}
#: How long a text may be in a prompt, and how many items of a list are shown.
PROMPT_LENGTH, PROMPT_ITEMS = 50, 3


def _first(values: Column, test) -> Column:
    return F.get(F.filter(values, test), F.lit(0))


def _has(text: Column, words: str) -> Column:
    out = F.lit(False)
    for word in words.split():
        out = out | F.contains(text, F.lit(word))
    return out


def matched_key(name: Column, values: Column) -> Column:
    """The key for a parameter: its own name; one that ends in it after a dot; one whose last part contains it or is in it."""
    last = lambda v: F.element_at(F.split(v["key"], r"\."), -1)
    exact = _first(values, lambda v: v["key"] == name)
    step = _first(values, lambda v: F.endswith(v["key"], F.concat(F.lit("."), name)))
    part = _first(values, lambda v: F.contains(last(v), name) | F.contains(name, last(v)))
    return F.coalesce(exact["key"], step["key"], part["key"])


def grounded(name: Column, values: Column) -> Column:
    """The value for a parameter: of its own name; of a key that contains it or is in it; of a family of names. Null for none."""
    low = F.lower(name)
    plain = F.filter(values, lambda v: ~F.contains(v["key"], F.lit(".")))
    out = [_first(values, lambda v: v["key"] == name), _first(plain, lambda v: F.contains(F.lower(v["key"]), low) | F.contains(low, F.lower(v["key"])))]
    for asks, offers, kind in FAMILIES:
        out.append(F.when(_has(low, asks), _first(plain, _offers(offers, kind))))
    return F.coalesce(*[x["value"] for x in out])


def _offers(words: str, kind: str):
    return lambda v: _has(F.lower(v["key"]), words) & (v["kind"] == kind)


def placeholder(kind: Column, name: Column, *seed: Column) -> Column:
    """A value by type alone, as text: numbers from 1, true or false, a fixed day, an empty list or object, the name and _value."""
    whole, cents, flag = lot(99, name, *seed) + 1, lot(9901, name, *seed) + 100, lot(2, name, *seed) == 1
    return (
        F.when(kind == "integer", whole.cast("string")).when(kind == "number", F.format_string("%d.%02d", F.floor(cents / 100).cast("long"), (cents % 100).cast("long")))
        .when(kind == "boolean", flag.cast("string")).when(kind.isin("date", "datetime"), "2024-06-15").when(kind == "array", "[]").when(kind == "object", "{}").otherwise(F.concat(name, F.lit("_value")))
    )


def _one_of(values: Column, *seed: Column) -> Column:
    return F.when(F.size(values) > 0, F.element_at(values, (F.pmod(lot(1 << 30, *seed), F.size(values)) + 1).cast("int")))


def resolved(name: Column, kind: Column, enum: Column, default: Column, values: Column, *seed: Column) -> Column:
    """struct(value, source) of an argument: grounded, enum, default or placeholder, in this order."""
    sources = {"grounded": grounded(name, values), "enum": _one_of(enum, name, *seed), "default": default, "placeholder": placeholder(kind, name, *seed)}
    return F.coalesce(*[F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(k).alias("source"))) for k, v in sources.items()])


def fresh_pool(name: Column, kind: Column) -> Column:
    """What a fresh value is drawn from: `id` for names with id, else the pool of the type, else the name's own."""
    out = name
    for t, pool in FRESH.items():
        out = F.when(kind == t, pool).otherwise(out)
    return F.when(F.contains(F.lower(name), F.lit("id")), "id").when(kind.isin("array", "object"), "description").otherwise(out)


def generated(name: Column, kind: Column, required: Column, enum: Column, default: Column, values: Column, *seed: Column, optional: float = 0.5) -> Column:
    """struct(value, source) of an argument, or null: optional ones are given with the probability `optional`, by hash.

    A value at hand by matched_key, else of the enum, else the default, else fresh: an id of the name's first three letters
    and a number, or the name of the pool to draw from.
    """
    key = matched_key(name, values)
    at_hand = _first(values, lambda v: v["key"] == key)["value"]
    pool = fresh_pool(name, kind)
    made = F.when(pool == "id", F.concat(F.upper(F.substring(name, 1, 3)), F.lit("-"), (lot(8999, name, *seed) + 1000).cast("string"))).otherwise(F.concat(F.lit("pool:"), pool))
    sources = {"grounded": at_hand, "enum": _one_of(enum, name, *seed), "default": default, "fresh": made}
    out = F.coalesce(*[F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(k).alias("source"))) for k, v in sources.items()])
    given = required | (lot(1000, F.lit("optional"), name, *seed) < int(1000 * optional))
    return F.when(given, out)


def coerced(raw: Column, kind: Column) -> Column:
    """A default (as text) in the form of its type, or null if it has none; other types pass."""
    text = F.trim(raw)
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("decimal(38,0)").cast("string"))
    number = F.when(text.rlike(r"(?i)^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"), text.try_cast("double").cast("string"))
    flag = F.lower(text).isin("true", "1", "yes").cast("string")
    return F.when(kind == "integer", whole).when(kind == "number", number).when(kind == "boolean", flag).otherwise(raw)


def json_type(kind: Column) -> Column:
    return F.when(kind.isin(JSON_TYPES), kind).otherwise("string")


def tool_schema(endpoint: Column, name: Column, description: Column, parameters: Column) -> Column:
    """A function's schema as JSON; parameters(name, type, description, required) in order."""
    safe = lambda c: F.regexp_replace(c, r"[^a-zA-Z0-9_-]", "_")
    prop = lambda p: F.struct(json_type(p["type"]).alias("type"), F.nullif(p["description"], F.lit("")).alias("description"))
    properties = F.map_from_entries(F.transform(parameters, lambda p: F.struct(safe(p["name"]), prop(p))))
    needed = F.transform(F.filter(parameters, lambda p: p["required"]), lambda p: safe(p["name"]))
    body = F.struct(F.lit("object").alias("type"), properties.alias("properties"), needed.alias("required"))
    function = F.struct(safe(endpoint).alias("name"), F.coalesce(F.nullif(description, F.lit("")), name).alias("description"), body.alias("parameters"))
    return F.to_json(F.struct(F.lit("function").alias("type"), function.alias("function")))


def prompt_value(value: Column) -> Column:
    """A VARIANT as a prompt shows it: null, true, 1.50, [a, b, c, ...], {keys}, texts cut to fifty characters."""
    shape = F.schema_of_variant(value)
    get = lambda kind: F.try_variant_get(value, "$", kind)
    items = F.transform(get("array<variant>"), lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("None")))
    listed = F.concat(F.lit("["), F.array_join(F.slice(items, F.lit(1), F.lit(PROMPT_ITEMS)), ", "), F.when(F.size(items) > PROMPT_ITEMS, ", ...").otherwise(""), F.lit("]"))
    keys = F.concat(F.lit("{"), F.array_join(F.map_keys(get("map<string,variant>")), ", "), F.lit("}"))
    text = get("string")
    cut = F.when(F.length(text) > PROMPT_LENGTH, F.concat(F.substring(text, 1, PROMPT_LENGTH), F.lit("..."))).otherwise(text)
    return (
        F.when(value.isNull() | F.is_variant_null(value), "null").when(shape == "BOOLEAN", text).when(shape.startswith("ARRAY"), listed).when(shape.startswith("OBJECT"), keys)
        .when(shape == "BIGINT", text).when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), F.format_string("%.2f", get("double"))).otherwise(cut)
    )


def available_text(values: Column) -> Column:
    """values(key, shown, endpoint, step; null: not tracked) as lines for a prompt, by key; those of certain steps are left out."""
    plain = F.array_sort(F.filter(values, lambda v: ~F.contains(v["key"], F.lit("."))))
    source = lambda v: F.when(v["endpoint"].isNotNull(), F.concat(F.lit(" (from "), v["endpoint"], F.lit(", step "), v["step"].cast("string"), F.lit(")"))).otherwise("")
    lines = F.transform(plain, lambda v: F.concat(F.lit("- "), v["key"], F.lit(": "), v["shown"], source(v)))
    return F.when(F.size(plain) > 0, F.concat(F.lit("Available values from prior tool calls:\n"), F.array_join(lines, "\n"))).otherwise("No values available from prior tool calls.")
