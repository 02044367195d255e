"""Sharding along a Hilbert curve over several metadata dimensions, with DataFrame functions only.

Each dimension is quantised to 16 steps: sizes by half octaves, languages and sources by where a value's rows stand
among all rows in the order of whole values. The cell (one of 4096) gives the curve index. Equal texts are one
group, in the cell of its least language and source; groups are ranked along the curve, in a cell by the hash of
their text, rows are ranked within their group, and the ranking is cut into runs of equal counts. So every run
covers a compact box of sizes, languages and sources, which lets a reader prune whole shards by any of them, and a
group is parted only where a cut falls into it (as counts must be equal).

Nulls: a null value is a value of its own, the first; a null text counts as empty. Rows that are alike may take one
another's slots. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ._common import broadcast_if_small, running_total, stage

BITS, DIMS = 4, 3


def curve(spark: SparkSession, bits: int = BITS, dims: int = DIMS) -> DataFrame:
    """The 2**(bits*dims) cells (coordinates in mixed radix, first highest) and their index on the curve."""
    side = 1 << bits
    cells = spark.range(side**dims).withColumnRenamed("id", "cell")
    at = [F.floor(F.col("cell") / side ** (dims - 1 - i)).cast("long") % side for i in range(dims)]
    df = cells.withColumns({f"x{i}": c for i, c in enumerate(at)})
    q = side >> 1
    while q > 1:  # from the largest squares down: turn and mirror the axes
        p = q - 1
        for i in range(dims):
            x, first = F.col(f"x{i}"), F.col("x0")
            swap = first.bitwiseXOR(x).bitwiseAND(p)
            inside = x.bitwiseAND(q) != 0
            df = df.withColumns({"x0": F.when(inside, first.bitwiseXOR(p)).otherwise(first.bitwiseXOR(swap)), f"x{i}": F.when(inside, x).otherwise(x.bitwiseXOR(swap))} if i else {"x0": F.when(inside, first.bitwiseXOR(p)).otherwise(first)})
        q >>= 1
    for i in range(1, dims):
        df = df.withColumn(f"x{i}", F.col(f"x{i}").bitwiseXOR(F.col(f"x{i - 1}")))
    turn = F.lit(0).cast("long")
    q = side >> 1
    while q > 1:
        turn = turn.bitwiseXOR(F.when(F.col(f"x{dims - 1}").bitwiseAND(q) != 0, F.lit(q - 1)).otherwise(F.lit(0)).cast("long"))
        q >>= 1
    df = df.withColumn("_t", turn)
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index * 2 + F.floor(F.col(f"x{i}").bitwiseXOR(F.col("_t")) / (1 << b)).cast("long") % 2
    return df.select("cell", index.alias("curve_index"))


def size_step(size: Column) -> Column:
    """The half octave of a size: 0 below 96 bytes, 15 from 12 KB on."""
    binary = F.bin(size)
    return F.greatest(F.lit(0), F.least(F.lit(15), 2 * F.length(binary) + F.coalesce(F.substring(binary, 2, 1).try_cast("int"), F.lit(0)) - 14)).cast("long")


def value_steps(rows: DataFrame, column: str) -> DataFrame:
    """value, step: the sixteenth of all rows (in the order of values) that the middle of a value's rows falls into.

    Values are dealt by ranges; only the ranges' sums meet in one task.
    """
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    dealt = stage(counts.repartitionByRange(F.col("value").asc_nulls_first()).withColumn("part", F.spark_partition_id()), "hilbert-values")
    parts = dealt.groupBy("part").agg(F.sum("n").alias("all"))
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("all").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("part").orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(F.broadcast(parts), F.col("part") == F.col("_part")).withColumn("before", F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0)))  # a row for each range
    return placed.select("value", F.expr(f"(({1 << BITS}L * (2 * before + n)) div (2 * total))").alias("step"))


def _first_bits(key: Column) -> Column:
    """30 bits of a hexadecimal key, in its order."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / 4).cast("long")


def shard(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null), curve_index for each row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("_text"), F.col("lang").alias("_lang"), F.col("source").alias("_source"))
    slim = stage(slim, "hilbert")
    least = F.min(F.struct("_lang", "_source")).alias("_least")
    groups = slim.groupBy("_text").agg(F.count("*").alias("_n"), F.min("size").alias("_size"), least)
    cell = size_step(F.col("_size"))
    for name in ("lang", "source"):
        steps = broadcast_if_small(stage(value_steps(slim, f"_{name}"), f"hilbert-{name}").select(F.col("value").alias(f"_{name}_value"), F.col("step").alias(f"_{name}_step")))
        groups = groups.join(steps, F.col(f"_least._{name}").eqNullSafe(F.col(f"_{name}_value")))
        cell = cell * (1 << BITS) + F.col(f"_{name}_step")
    groups = groups.select("_text", "_n", cell.alias("cell")).join(F.broadcast(stage(curve(spark), "curve")), "cell").drop("cell")  # 4096 cells, whatever the input
    groups = stage(groups, "hilbert-groups")
    n_groups, n = groups.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).head()
    ranked = running_total(groups, ["curve_index"], [F.col("_text")], "_in_cell", n_groups, "_n", _first_bits(F.col("_text")))
    per_cell = groups.groupBy("curve_index").agg(F.sum("_n").alias("_cell_n"))
    base = per_cell.select(F.col("curve_index").alias("_ci"), F.coalesce(F.sum("_cell_n").over(Window.orderBy("curve_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    ranked = ranked.join(F.broadcast(base), F.col("curve_index") == F.col("_ci")).select(F.col("_text").alias("_key"), "_n", "curve_index", (F.col("_base") + F.col("_in_cell")).alias("_start"))
    rows = slim.select("doc_id", "size", "text_crc32", "_text").join(ranked, F.col("_text") == F.col("_key")).drop("_key")
    rows = stage(rows, "hilbert-rows")
    doc = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    several = running_total(rows.where("_n > 1"), ["_text"], [doc, F.col("doc_id").asc_nulls_first()], "_in_group", n, None, _first_bits(doc))
    out = rows.where("_n = 1").withColumn("_in_group", F.lit(0).cast("long")).unionByName(several).withColumn("_rank", F.col("_start") + F.col("_in_group"))
    part = F.expr(f"(_rank * {n_shards}L) div {max(n, 1)}L")
    out = out.withColumn("_shard", part).withColumn("slot", F.expr(f"_rank - ((_shard * {n}L + {n_shards - 1}L) div {n_shards}L)"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"), "curve_index")
