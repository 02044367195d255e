"""Helpers that the training-data operators share: staging, sizes and balanced ranks."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: A word is a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one task of a ranking window holds on average, at most.
ROWS_PER_BUCKET = 2_048
#: Broadcast a table of this many (narrow) rows at most; beyond, join by shuffle.
BROADCAST_ROWS = 50_000

_local: dict[str, str] = {}
_scopes: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Where it is unset a folder is made for a local master (tests); on a cluster that is an error, since
    executors would not see one another's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    if "dir" not in _local:
        _local["dir"] = tempfile.mkdtemp(prefix="loomspark-")
        atexit.register(shutil.rmtree, _local["dir"], True)
    return f"file://{_local['dir']}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that stage() or scratch() made."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end; write what is to stay with staged_at before."""
    path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    _scopes.append(path)
    try:
        yield
    finally:
        _scopes.pop()
        delete(spark, path)


def staged_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here and survives lost executors."""
    return staged_at(df, f"{_scopes[-1] if _scopes else shared_dir(df.sparkSession)}/stage-{name}-{uuid.uuid4().hex}")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the rows of an Arrow batch, as texts may be very long. The plan reads this setting when it runs, so it stays set."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def row_key(df: DataFrame) -> Column:
    """A hash of all of a row's columns; maps, which have no hash, count as their JSON."""
    plain = lambda f: not any(k in f.dataType.simpleString() for k in ("map<", "variant"))
    return F.xxhash64(*[F.col(f"`{f.name}`") if plain(f) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema])


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that no helper column's name can clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has few rows (counted), else as it is: a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def running_total(df: DataFrame, keys: list[str], order: list[Column], out: str, n_rows: int, weight: str | None = None, spread: Column | None = None) -> DataFrame:
    """Add the exclusive running total of weight (None: of ones, that is a rank from 0) within keys.

    A hot key is cut into buckets of about ROWS_PER_BUCKET rows by a hash (spread) that leads the order, so
    no task gets a whole key. Buckets are summed first, their few sums are accumulated within each key, and
    rows only within their bucket.
    """
    n = max(1, min(1 << 20, -(-n_rows // ROWS_PER_BUCKET)))
    w = F.col(weight) if weight else F.lit(1).cast("long")
    spread = spread if spread is not None else F.xxhash64(*[c for c in df.columns if c not in keys])
    rows = df.withColumn("_u", F.pmod(spread, F.lit(1 << 30))).withColumn("_b", ((F.col("_u") * n) / F.lit(float(1 << 30))).cast("int"))
    sums = rows.groupBy(*keys, "_b").agg(F.sum(w).alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_kb"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    on = F.col("_b") == F.col("_kb")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    within = Window.partitionBy(*keys, "_b").orderBy("_u", *order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(sums, on, "inner").withColumn(out, (F.col("_base") + F.coalesce(F.sum(w).over(within), F.lit(0))).cast("long"))
    return joined.drop("_u", "_b", "_kb", "_base", *[f"_k{i}" for i in range(len(keys))])
