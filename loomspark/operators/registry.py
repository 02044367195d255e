"""Registry operators: filters, deduplication, scoring, statistics, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def first_wins(df: DataFrame, key: list, order: list) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def weighted(parts: list[tuple[Column, float]]) -> Column:
    """Sum of the weights of the parts that hold (booleans) or of weight times value (numbers), rounded."""
    total = F.lit(0.0)
    for c, w in parts:
        total = total + c * w
    return F.round(total, 4)


def flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def distribution(df: DataFrame, column: str, values: list) -> DataFrame:
    """Counts of the given values, zeros included."""
    grid = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} {df.schema[column].dataType.simpleString()}")
    return F.broadcast(grid).join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def stratified(df: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows of each stratum by a keyed hash, the same on every run and in other engines."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return df.withColumn("_h", h).withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key))).where(F.col("_r") <= n).drop("_h", "_r")


def top(df: DataFrame, group: str, n: int) -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("n")).orderBy(F.desc("n"), group).limit(n)


def config_diff(a: DataFrame, b: DataFrame, key: str = "key", value: str = "value", ignore: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Keys whose values differ or that one side lacks."""
    x, y = a.withColumnRenamed(value, "a"), b.withColumnRenamed(value, "b")
    return x.join(y, key, "full").where(~F.col("a").eqNullSafe(F.col("b")) & ~F.col(key).isin(*ignore))


#: Fixed order of the tiers, worst first.
TIERS = ("minimal", "poor", "fair", "good", "excellent")


def tier_rank(tier: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in TIERS]), tier)


def at_least(tools: DataFrame, tier: str = "fair") -> DataFrame:
    """tools(tier) of this tier or a better one, best first."""
    return tools.where(tier_rank(F.col("tier")) > TIERS.index(tier)).orderBy(F.desc(tier_rank(F.col("tier"))))


def filter_tools(tools: DataFrame, domains: list | None = None, tier: str | None = None, least: int | None = None, most: int | None = None, has_schema: bool | None = None) -> DataFrame:
    """tools(domain, tier, n_endpoints, has_schema: any endpoint has one) that meet every criterion given."""
    ok = F.lit(True)
    if domains is not None:
        ok = ok & F.col("domain").isin(domains)
    if tier is not None:
        ok = ok & (tier_rank(F.col("tier")) > TIERS.index(tier))
    if least is not None:
        ok = ok & (F.col("n_endpoints") >= least)
    if most is not None:
        ok = ok & (F.col("n_endpoints") <= most)
    if has_schema is not None:
        ok = ok & (F.col("has_schema") == has_schema)
    return tools.where(ok)


def drawn(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """One row at random by a keyed hash; a key is drawn, not a row, and an empty table gives no row."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return rows.orderBy(h, key).limit(1)


def added(registry: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """registry and more; raises where a key of `more` is in the registry or comes twice."""
    n = more.groupBy(key).agg(F.count("*").alias("_n"))
    seen = registry.select(F.col(key).alias("_key")).distinct()
    checked = more.join(n, key).join(seen, F.col(key).eqNullSafe(F.col("_key")), "left")
    twice = F.raise_error(F.concat(F.lit(f"{key} is there already: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    ok = checked.where(F.when((F.col("_n") > 1) | F.col("_key").isNotNull(), twice.cast("boolean")).otherwise(F.lit(True)))
    return registry.unionByName(ok.select(*registry.columns))


def removed(registry: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return registry.join(keys.select(key).distinct(), key, "left_anti")


def parameter(parameters: Column, name) -> Column:
    """The first of an endpoint's parameters (an array of structs) with this name, or null."""
    return F.get(F.filter(parameters, lambda p: p["name"] == name), F.lit(0))


def endpoint(endpoints: Column, endpoint_id) -> Column:
    """The first of a tool's endpoints with this id, or null."""
    return F.get(F.filter(endpoints, lambda e: e["endpoint_id"] == endpoint_id), F.lit(0))


def endpoints_by_method(endpoints: Column, method) -> Column:
    return F.filter(endpoints, lambda e: e["method"] == method)


def spread_sample(df: DataFrame, stratum: str, key: str, most: int, seed: int = 42) -> DataFrame:
    """At most `most` rows: as many of each stratum as an equal share gives, then the rest by hash from all that are left."""
    share = max(1, most // max(1, df.select(stratum).distinct().count()))
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    ranked = df.withColumn("_h", h).withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key)))
    return ranked.orderBy((F.col("_r") > share).cast("int"), "_h", key).limit(most).drop("_h", "_r")
