"""Parameter types from names, defaults, enums, descriptions, examples and places, and how they combine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name rules as (priority, confidence, type, pattern); by priority, then in this order.
NAME_RULES = [
    (1, 0.95, "string", "uuid|guid"),
    (1, 0.9, "string", "^id$"),
    (1, 0.9, "string", "[_-]id$"),
    (1, 0.95, "integer", "^(limit|offset|page|per_page|page_size|skip|top)$"),
    (2, 0.9, "integer", "[_-]?count$"),
    (2, 0.85, "integer", "^num[_-]"),
    (2, 0.85, "integer", "^(size|length|width|height|max|min|total)$"),
    (3, 0.8, "integer", "^(year|month|day|hour|minute)$"),
    (2, 0.9, "boolean", "^is[_-]"),
    (2, 0.9, "boolean", "^has[_-]"),
    (2, 0.85, "boolean", "^(enable|disable|active|verbose|recursive|force|dry_run|include|exclude|ascending|descending)$"),
    (2, 0.9, "datetime", "timestamp"),
    (3, 0.8, "datetime", "[_-](at|on)$"),
    (2, 0.9, "date", "[_-]?date$"),
    (3, 0.75, "date", "^(created|updated|modified|expires|start|end)$"),
    (2, 0.85, "number", "(price|cost|amount|fee|rate|balance)"),
    (1, 0.95, "number", "^(lat|latitude|lon|lng|longitude)$"),
    (3, 0.8, "number", "(score|weight|ratio|percent|factor)"),
    (2, 0.9, "array", "[_-]?ids$"),
    (2, 0.85, "array", "[_-]?list$"),
    (3, 0.8, "array", "[_-]?items$"),
    (3, 0.8, "array", "^(tags|categories|labels|fields|columns)$"),
    (3, 0.75, "object", "^(body|data|payload|metadata|config|options|settings|filter)$"),
    (3, 0.8, "string", "[_-]?name$"),
    (2, 0.9, "string", "email"),
    (2, 0.85, "string", "(url|link|href|uri)$"),
    (2, 0.85, "string", "(token|key|secret|password|api_key)$"),
    (3, 0.8, "string", "^(query|search|q|keyword|term)$"),
    (3, 0.75, "string", "^(format|type|kind|sort|order|status|state|mode|lang|locale|currency)$"),
]
#: What a place says of a type.
PLACES = {"body": ("object", 0.4), "path": ("string", 0.5), "header": ("string", 0.6)}
#: Keywords of descriptions as (confidence, type, pattern), in order.
KEYWORDS = [
    (0.7, "integer", r"\bnumber\b|\binteger\b|\bint\b"),
    (0.75, "boolean", r"\btrue\b.*\bfalse\b|\bboolean\b|\bbool\b"),
    (0.7, "date", r"\bdate\b|\biso\s*8601\b"),
    (0.7, "datetime", r"\btimestamp\b|\bdatetime\b"),
    (0.7, "number", r"\bfloat\b|\bdecimal\b|\bdouble\b"),
    (0.7, "array", r"\barray\b|\blist\b|\bcomma[- ]?separated\b"),
    (0.65, "object", r"\bjson\b|\bobject\b|\bdict\b"),
    (0.65, "string", r"\burl\b|\buri\b|\blink\b"),
]
EVIDENCE = "struct<type:string,confidence:double>"


def _evidence(kind: Column | str, confidence: float) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("type"), F.lit(float(confidence)).alias("confidence"))


def from_name(name: Column) -> Column:
    """The first rule that the name meets, as (type, confidence); null for none."""
    rules = sorted(NAME_RULES, key=lambda r: r[0])
    return F.coalesce(*[F.when(name.rlike(f"(?i){p}"), _evidence(kind, c)) for _, c, kind, p in rules])


def from_place(place: Column) -> Column:
    out = _evidence("string", 0.3)
    for name, (kind, confidence) in PLACES.items():
        out = F.when(place == name, _evidence(kind, confidence)).otherwise(out)
    return out


def _whole(c: Column) -> Column:
    return F.trim(c).rlike(r"^[+-]?[0-9]+$")


def _numeric(c: Column) -> Column:
    return F.trim(c).cast("string").try_cast("double").isNotNull()


def from_description(description: Column) -> Column:
    """The first keyword that a description has; null for none."""
    return F.coalesce(*[F.when(description.rlike(f"(?i){p}"), _evidence(kind, c)) for c, kind, p in KEYWORDS])


def from_examples(values: Column) -> Column:
    """The type that most examples (as text) look like, the one first seen if equal; null for no examples."""
    kinds = F.transform(values, lambda v: F.when(_whole(v), "integer").when(_numeric(v), "number").otherwise("string"))
    counted = F.transform(F.array_distinct(kinds), lambda k: F.struct(F.size(F.filter(kinds, lambda x: x == k)).alias("n"), k.alias("kind")))
    most = F.aggregate(counted, F.struct(F.lit(0).alias("n"), F.lit("string").alias("kind")), lambda a, x: F.when(x["n"] > a["n"], x).otherwise(a))
    return F.when(F.size(values) > 0, _evidence(most["kind"], 0.85))


def from_default(default: Column) -> Column:
    """Of a default as text: numbers by their look, true and false, else text; null without a default."""
    kind = F.when(_whole(default), "integer").when(_numeric(default), "number").when(F.lower(default).isin("true", "false"), "boolean").otherwise("string")
    return F.when(default.isNotNull(), _evidence(kind, 0.95))


def from_enum(values: Column) -> Column:
    """All integers, all numbers, all true or false, else text; null for no values."""
    flags = F.forall(values, lambda v: F.lower(v).isin("true", "false"))
    found = F.when(F.forall(values, _whole), _evidence("integer", 0.85)).when(F.forall(values, _numeric), _evidence("number", 0.85)).when(flags, _evidence("boolean", 0.9)).otherwise(_evidence("string", 0.9))
    return F.when(F.size(values) > 0, found)


def combine(evidence: list[Column], least: float = 0.3) -> Column:
    """(type, confidence): a type's best confidence, .05 more for each further voice (.1 at most), 1 at most.

    The highest wins, the type first voiced if equal; below `least` it is text.
    """
    voices = F.array_compact(F.array(*[e.cast(EVIDENCE) for e in evidence]))
    kinds = F.array_distinct(F.transform(voices, lambda v: v["type"]))

    def score(kind: Column) -> Column:
        mine = F.filter(voices, lambda v: v["type"] == kind)
        more = F.least(0.05 * (F.size(mine) - 1), F.lit(0.1))
        return F.least(F.array_max(F.transform(mine, lambda v: v["confidence"])) + more, F.lit(1.0))

    scored = F.transform(kinds, lambda k: F.struct(F.round(score(k), 4).alias("confidence"), k.alias("type")))
    best = F.aggregate(scored, F.lit(None).cast("struct<confidence:double,type:string>"), lambda a, x: F.when(a.isNull() | (x["confidence"] > a["confidence"]), x).otherwise(a))
    kind = F.when(best["confidence"] >= least, best["type"]).otherwise("string")
    return F.struct(kind.alias("type"), F.coalesce(best["confidence"], F.lit(0.0)).alias("confidence"))
