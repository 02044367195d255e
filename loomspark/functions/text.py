"""Scalar expressions on names, descriptions, paths and types of a tool catalogue."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Spellings of parameter types.
TYPES = {
    "string": "string str text", "integer": "integer int int32 int64 long", "number": "number float double decimal",
    "boolean": "bool boolean", "array": "array list", "object": "object dict json map", "file": "file binary", "date": "date", "datetime": "datetime date-time",
}
METHODS = ("GET", "POST", "PUT", "DELETE", "PATCH", "HEAD", "OPTIONS")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_name(c: Column, most: int = 200) -> Column:
    return F.substring(collapse(F.regexp_replace(F.trim(c), r"(?U)[^\w\s\-]", "")), 1, most)


def repair(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, put right; a text that isn't such stays as it is."""
    narrow = c.rlike("^[\\x00-\\xff]*$")
    return F.coalesce(F.when(narrow, F.try_validate_utf8(F.encode(F.when(narrow, c), "ISO-8859-1").cast("string"))), c)


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """Texts with \\uXXXX and character references decoded: Spark has no expression for the full table of names."""
    plain = lambda t: re.sub(r"\\u([0-9a-fA-F]{4})", lambda m: chr(int(m[1], 16)), t).encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return texts.map(lambda t: html.unescape(plain(t)), na_action="ignore")


def description(c: Column, name: Column, most: int = 2000) -> Column:
    """Repaired, decoded and collapsed; empty if null or if it only repeats the name."""
    text = collapse(unescape(repair(F.coalesce(c, F.lit("")))))
    repeats = without_article(text) == F.lower(F.coalesce(name, F.lit("")))
    return F.when(repeats, "").otherwise(F.substring(text, 1, most))


def slug(c: Column) -> Column:
    return F.btrim(F.lower(F.regexp_replace(c, r"(?U)\W+", "_")), F.lit("_"))


def identifier(c: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(F.replace(F.trim(c), F.lit(" "), F.lit("_")), r"(?U)[^\w\-]", ""), F.lit("_-")))


def parameter_name(c: Column) -> Column:
    out = F.lower(F.btrim(F.regexp_replace(F.trim(c), r"(?U)[^\w]", "_"), F.lit("_")))
    return F.when(out == "", "unknown").otherwise(out)


def function_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-zA-Z0-9_-]", "_")


#: Words that are said otherwise.
SAID = {"search": "search for", "lookup": "look up"}


def humanize(c: Column) -> Column:
    """A name in plain words: split before capitals and at _ and -, lower case, no leading slashes."""
    spaced = F.regexp_replace(F.regexp_replace(c, r"([a-z])([A-Z])", "$1 $2"), r"[_\-]", " ")
    out = F.regexp_replace(F.trim(F.lower(spaced)), "^/+", "")
    for word, said in SAID.items():
        out = F.regexp_replace(out, rf"\b{word}\b", said)
    return collapse(out)


def without_article(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"^(the|a|an|this)\s+", "")


def meaningful(description: Column, name: Column) -> Column:
    text = F.trim(F.coalesce(description, F.lit("")))
    low, own = F.lower(text), F.lower(F.trim(F.coalesce(name, F.lit(""))))
    return (F.length(text) >= 10) & (low != own) & (without_article(text) != own)


def vowel_share(c: Column) -> Column:
    letters = F.lower(c)
    return (F.length(letters) - F.length(F.regexp_replace(letters, "[aeiou]", ""))) / F.greatest(F.length(letters), F.lit(1))


#: Verbs that are names though short; marks of names, characters of code and words of API documents that can't be shown.
SHORT_VERBS = "get set add run put".split()
BAD_MARKS = r"602917ac|version 2|copy|\.\.\."
CODE, JARGON = r"[{}\"\\=<>]|//", r"api|endpoint|http|json|parameter|request|response|returns|\.\.\.|base64|png"
#: What is said of a step whose name can't be shown, by whether it has a domain and its tool's name can be shown.
STEP_TEXTS = {(True, False): "look up {domain} information", (True, True): "use {tool} for {domain} data", (False, True): "get data from {tool}", (False, False): "look up some information"}


def garbage_name(c: Column) -> Column:
    """Too short (but for five verbs), one long run, a path, hardly a vowel, or with a fixed mark."""
    text = F.lower(F.trim(c))
    short = (F.length(text) < 4) & ~text.isin(SHORT_VERBS)
    run = (F.length(text) > 25) & ~text.rlike("[ _-]")
    return short | run | text.startswith("/") | text.contains("//") | ((F.length(text) > 4) & (vowel_share(text) < 0.15)) | text.rlike(BAD_MARKS)


def clean_description(c: Column) -> Column:
    """Whether a description can be shown: 5 to 100 characters, no code, no words of API documents; 60 at most after an article."""
    led = F.trim(c).rlike("^(The|A|An|This) ") & (F.length(c) > 60)
    return F.coalesce((F.length(c) >= 5) & (F.length(c) <= 100) & ~c.rlike(CODE) & ~F.lower(c).rlike(JARGON) & ~led, F.lit(False))


def _filled(template: str, **values: Column) -> Column:
    """A template with its {names} filled, as an expression."""
    return F.concat(*[values[part[1:-1]] if part.startswith("{") else F.lit(part) for part in re.split(r"(\{\w+\})", template) if part])


def describe_step(name: Column, tool: Column, domain: Column, description: Column) -> Column:
    """What a step does, in plain words: its description if clean and short, else from the names that can be shown."""
    said = F.lower(F.rtrim(F.trim(description), F.lit(".")))
    own, of, field = humanize(name), humanize(tool), F.replace(F.lower(domain), F.lit("_"), F.lit(" "))
    placed, shown = F.coalesce(domain, F.lit("")) != "", ~garbage_name(tool)
    named = F.exists(F.filter(F.split(of, " "), lambda w: F.length(w) > 3), lambda w: own.contains(w))
    vague = F.coalesce(*[F.when((placed == has) & (shown == clear), _filled(text, tool=of, domain=field)) for (has, clear), text in STEP_TEXTS.items()])
    plain = F.when(~shown | named, own).otherwise(_filled("use {tool} to {own}", tool=of, own=own))
    return F.when(clean_description(description) & (F.length(said) < 50), said).when(garbage_name(name), vague).otherwise(plain)


#: How steps are joined to a task.
TASKS = {0: "help me with a task", 2: "{first} and then {last}", 3: "{first}, then {middle}, and finally {last}", 5: "{first}, then {second}, and a couple more things after that"}


def task(steps: Column, brief: Column) -> Column:
    """steps(tool, text) of a chain as one request; after two, a step of a tool that was there is left out; brief sums up five or more."""
    kept = F.aggregate(
        steps, F.struct(F.array().cast("array<string>").alias("tools"), F.array().cast("array<string>").alias("texts")),
        lambda s, x: F.when((F.size(s["texts"]) >= 2) & F.array_contains(s["tools"], x["tool"]), s).otherwise(F.struct(F.array_append(s["tools"], x["tool"]).alias("tools"), F.array_append(s["texts"], x["text"]).alias("texts"))),
        lambda s: s["texts"],
    )
    n = F.size(kept)
    parts = {"first": F.get(kept, F.lit(0)), "second": F.get(kept, F.lit(1)), "last": F.get(kept, n - 1), "middle": F.array_join(F.slice(kept, F.lit(2), F.greatest(n - 2, F.lit(0))), ", then ")}
    said = {k: _filled(v, **parts) for k, v in TASKS.items()}
    return F.when(n == 0, said[0]).when(n == 1, parts["first"]).when(n == 2, said[2]).when((n > 4) & brief, said[5]).otherwise(said[3])


def path_of(url: Column) -> Column:
    """The path of an absolute URL, or /; anything else as it is."""
    path = F.regexp_extract(url, r"^https?://[^/?#]*([^?#]*)", 1)
    return F.when(url.rlike("^https?://"), F.when(path == "", "/").otherwise(path)).otherwise(url)


def base_url(url: Column) -> Column:
    text = F.regexp_replace(F.trim(url), "/+$", "")
    return F.when(text == "", text).when(text.startswith("//"), F.concat(F.lit("https:"), text)).when(text.rlike("^https?://"), text).otherwise(F.concat(F.lit("https://"), text))


def template_path(path: Column) -> Column:
    """Path parameters in braces, one leading and no trailing slash, no query, percent-encoding decoded where it is valid."""
    bare = F.split_part(F.trim(path), F.lit("?"), F.lit(1))
    bare = F.coalesce(F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))), bare)
    p = F.regexp_replace(bare, r":(\w+)|<(\w+)>", "{$1$2}")
    p = F.regexp_replace(F.concat(F.lit("/"), p), "^/+", "/")
    return F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))


def path_parameters(path: Column) -> Column:
    found = [F.regexp_extract_all(path, F.lit(p), F.lit(1)) for p in (r"\{(\w+)\}", r":(\w+)", r"<(\w+)>")]
    return F.array_distinct(F.concat(*found))


def endpoint_id(tool: Column, method: Column, path: Column) -> Column:
    plain = F.regexp_replace(path, r"\{[^}]+\}|:\w+|<[^>]+>", "_param_")
    return F.concat_ws("/", tool, method, F.substring(F.sha2(F.concat(method, F.lit(":"), plain).cast("binary"), 256), 1, 8))


def parameter_type(c: Column) -> Column:
    out, text = F.lit("unknown"), F.lower(F.trim(c.cast("string")))
    for kind, names in TYPES.items():
        out = F.when(text.isin(names.split()), kind).otherwise(out)
    return out


def method(c: Column) -> Column:
    text = F.upper(F.trim(c))
    return F.when(text.isin(*METHODS), text).otherwise("GET")


def infer_type(name: Column) -> Column:
    """From a name alone, as ingest does: a flag, a number, else text."""
    flag = name.rlike("(?i)^(is_|has_|enable|disable|flag|active|verbose)")
    return F.when(flag, "boolean").when(name.rlike("(?i)count|total|limit|offset|page|size|width|height|lat|lon|price|amount|num"), "number").otherwise("string")


def extractable(name: Column) -> Column:
    """What a response field offers to later steps, by its name; the first kind that fits."""
    n = F.lower(F.trim(name))
    return F.when(n.rlike("^(uuid|guid)$|id$"), "id").when(n.rlike("^(name|title|label)$|_name$"), "name").when(n.rlike("url|link|href"), "url").when(n.rlike("date|time|^created|^updated"), "date").when(n.isin("count", "total", "size", "length"), "count").when(n.isin("status", "state"), "status").otherwise("none")


def enum_values(c: Column) -> Column:
    """The values of a comma-joined text, trimmed; null for none."""
    found = F.filter(F.transform(F.split(c, ","), lambda v: F.trim(v)), lambda v: v != "")
    return F.when(F.size(found) > 0, found)


def required_flag(c: Column) -> Column:
    """true, 1 and yes count; `optional` and the rest do not."""
    return F.coalesce(truthy(c), F.lit(False))


def location(c: Column) -> Column:
    text = F.lower(F.trim(c))
    return F.when(text.isin("query", "path", "header", "body", "form"), text).when(text == "formdata", "form").otherwise("query")


def tool_text(name: Column, description: Column, domain: Column, endpoints: Column) -> Column:
    """What is embedded of a tool; empty parts are left out."""
    part = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(label), c, F.lit(".")))
    return collapse(F.concat_ws(" ", part("", name), description, part("Domain: ", domain), part("Endpoints: ", F.array_join(endpoints, ", "))))


def truthy(c: Column) -> Column:
    return F.lower(F.trim(c)).isin("true", "1", "yes")


def tier(score: Column) -> Column:
    """Registry scale."""
    return F.when(score >= 0.8, "excellent").when(score >= 0.6, "good").when(score >= 0.4, "fair").when(score >= 0.2, "poor").otherwise("minimal")


def graph_tier(score: Column) -> Column:
    """Graph scale."""
    return F.when(score >= 0.7, "high").when(score >= 0.4, "medium").otherwise("low")


def pattern_hash(tools: Column) -> Column:
    """Of a chain's distinct tools, whatever their order."""
    return F.substring(F.sha2(F.array_join(F.array_sort(tools.cast("array<string>")), ",").cast("binary"), 256), 1, 16)


def endpoint_text(name: Column, description: Column, tool: Column, method: Column, path: Column, parameters: Column) -> Column:
    """What is embedded of an endpoint; an empty description or list of parameters is left out."""
    part = lambda label, c: F.concat(F.lit(label), c, F.lit("."))
    listed = F.when(F.size(parameters) > 0, part("Parameters: ", F.array_join(parameters, ", ")))
    return collapse(F.concat_ws(" ", part("", name), F.nullif(description, F.lit("")), part("Tool: ", tool), part("Method: ", method), part("Path: ", path), listed))


def chain_text(steps: Column) -> Column:
    """steps(run, text) in order, joined by arrows; steps of one run stand in brackets, by commas."""
    runs = F.array_distinct(F.transform(steps, lambda x: x["run"]))

    def shown(run: Column) -> Column:
        mine = F.transform(F.filter(steps, lambda x: x["run"] == run), lambda x: x["text"])
        return F.when(F.size(mine) > 1, F.concat(F.lit("["), F.array_join(mine, ", "), F.lit("]"))).otherwise(F.get(mine, F.lit(0)))

    return F.when(F.size(steps) > 0, F.array_join(F.transform(runs, shown), " -> ")).otherwise("(empty chain)")


def file_size(n: int) -> str:
    """Bytes as B, KB or MB."""
    return f"{n / 2**20:.1f} MB" if n >= 2**20 else f"{n / 2**10:.1f} KB" if n >= 2**10 else f"{n} B"
