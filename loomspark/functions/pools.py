"""Values drawn from pools: by the hash of what they stand for, so that reruns agree and no state is kept.

A pool is a list of values under the name of a kind. Ids depend on the scope (a seed and a conversation, say) and
the kind only; so a conversation that asks for an id again gets the one it had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pools are reference data; a table of more values isn't one.
MOST_VALUES = 100_000


def lot(most: int, *scope: Column) -> Column:
    """A number below `most` by the hash of the scope; a null counts as empty."""
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in scope])
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(most))


def _pick(values: list[str], *scope: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (lot(len(values), *scope) + 1).cast("int"))


def draw(kind: Column, pools: dict[str, list[str]], parts: dict[str, str], *scope: Column) -> Column:
    """A value of the pool named like the kind; else of the pool of the first of `parts` that the kind contains; else kind_001.

    Empty pools are passed over. parts maps a part of a name to the name of a pool, in order.
    """
    out = F.concat(kind, F.lit("_001"))
    for part, name in reversed(list(parts.items())):
        if pools.get(name):
            out = F.when(F.lower(kind).contains(part), _pick(pools[name], *scope)).otherwise(out)
    for name, values in pools.items():
        if values:
            out = F.when(kind == name, _pick(values, *scope)).otherwise(out)
    return out


def entity_id(kind: Column, *scope: Column, prefix: Column | None = None) -> Column:
    """PREFIX-1000 to PREFIX-9998; the prefix is the one given, or where null the kind's first three letters."""
    short = F.upper(F.substring(kind, 1, 3))
    return F.concat(F.coalesce(prefix, short) if prefix is not None else short, F.lit("-"), (lot(8999, kind, *scope) + 1000).cast("string"))


def entity_name(domain: Column, endpoint: Column, names: dict[str, list[str]], *scope: Column) -> Column:
    """A name of the domain's pool; else up to three words of the endpoint's name and Result; else the domain and Service."""
    words = F.filter(F.split(F.regexp_replace(F.coalesce(endpoint, F.lit("")), r"[_\-/]", " "), r"\s+"), lambda w: w != "")
    told = F.array_join(F.transform(F.slice(words, 1, 3), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))), " ")
    out = F.when(F.size(words) >= 2, F.concat(told, F.lit(" Result"))).otherwise(F.concat(F.replace(domain, F.lit("_"), F.lit(" ")), F.lit(" Service")))
    for name, values in names.items():
        if values:
            out = F.when(domain == name, _pick(values, domain, *scope)).otherwise(out)
    return out


def to_table(spark: SparkSession, pools: dict[str, list[str]]) -> DataFrame:
    """kind, values: a table that can be saved."""
    return spark.createDataFrame(list(pools.items()), "kind string, values array<string>")


def from_table(table: DataFrame) -> dict[str, list[str]]:
    """The pools of a table(kind, values); refuses one that is too large for reference data."""
    n = table.agg(F.coalesce(F.sum(F.size("values")), F.lit(0))).head()[0]
    if n > MOST_VALUES:
        raise ValueError(f"{n} values: pools have {MOST_VALUES} at most")
    return {r.kind: list(r["values"]) for r in table.collect()}
