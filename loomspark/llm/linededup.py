"""Removal of boilerplate lines that spread over many sites, with DataFrame functions only.

A line's spread is the number of distinct sites that have it, from HyperLogLog sketches per line hash that
merge by aggregation over the lines as they occur; only lines whose estimate is near the threshold get exact distinct
counts. Lines seen on one site only are set aside first by comparing their least and greatest site, and lines whose
sketch stays below the threshold before the documents' witness is weighed; neither loses anything.

A line that is wide-spread only because whole documents were copied is not boilerplate. So a document bears
witness for a line only if more than a fifth of its words stand in long enough lines that no other site has, or
that min_sites times fewer documents have, or if half of its words are in no shared line. A document that is much
shared, or copied to a few sites with all its own text, still bears witness for a footer that is in many others;
one of a large group of copies, whose lines are all about as frequent, doesn't. The lines found are then removed
from all documents.

Nulls: a null site is a site of its own; a null text stays null and has no lines; an empty text has one
empty line, which is too short to count. Rows that are alike get the same result each. An empty table gives no rows.
Other columns pass through, whatever their names, but for n_lines and n_removed, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import broadcast_if_small, packed, stage, word_count

MIN_SITES, MIN_WORDS, PRECISION = 5, 4, 12
#: Estimates this close to the threshold (a share of it, one at least) are counted exactly.
NEAR = 0.15
#: A share a/b: documents that have no more than this of their own are near copies (similarity 0.8, as in the pipeline).
OWN = (1, 5)


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def long_lines(docs: DataFrame, site: str, min_words: int) -> DataFrame:
    """For each document with a text: its site, id, text hash, words, words in long enough lines, and these lines (hash, words), distinct."""
    keyed = docs.where(F.col("text").isNotNull()).select(F.xxhash64(F.coalesce(F.col(site), F.lit("\x00null"))).alias("site"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"), word_count(F.col("text")).alias("total"), F.split("text", "\n", -1).alias("lines"))
    measured = F.transform("lines", lambda x: F.struct(_hash(x).alias("line"), word_count(x).alias("words")))
    long = F.array_distinct(F.filter(measured, lambda x: x["words"] >= min_words))
    keyed = keyed.withColumn("ls", long).withColumn("long", F.aggregate("ls", F.lit(0).cast("long"), lambda s, x: s + x["words"]))
    return keyed.select("site", "id", "text", "total", "long", "ls")


def _spread(rows: DataFrame, least: float) -> DataFrame:
    """line, estimate of the distinct sites (at least `least`) and rows, by sketches."""
    spread = rows.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", PRECISION)).alias("estimate"), F.sum("n").alias("occurrences"))
    return spread.where(F.col("estimate") >= least)


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """The line hashes to remove, with sites and occurrences."""
    return _boilerplate(stage(long_lines(docs, site, min_words), "lines"), min_sites)


def _boilerplate(documents: DataFrame, min_sites: int) -> DataFrame:
    lines = documents.select("site", "text", "total", "long", F.inline("ls"))
    several = lines.groupBy("line").agg(F.min("site").alias("a"), F.max("site").alias("b"), F.count("*").alias("docs")).where("a <> b").select("line", "docs")
    several = broadcast_if_small(stage(several, "lines-several"))
    cross = stage(lines.join(several, "line").groupBy("line", "docs", "site", "text", "total", "long", "words").agg(F.count("*").alias("n")), "line-cross")
    margin = max(1.0, NEAR * min_sites)
    wide = broadcast_if_small(stage(_spread(cross, min_sites - margin).select("line"), "lines-wide"))
    per_text = cross.select("text", "total", "long", "line", F.struct("docs", "words").alias("w")).distinct().groupBy("text", "total", "long").agg(F.array_sort(F.collect_list("w")).alias("ws"))
    # what the lines without others lack of the share, and how frequent the rarest shared lines are that make it up (__reach; 0: none needed)
    a, b = OWN
    shared = F.aggregate("ws", F.lit(0).cast("long"), lambda s, x: s + x["words"])
    lack = F.when(2 * shared <= F.col("total"), -1).otherwise(a * F.col("total") - b * (F.col("long") - shared))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("reach"))
    rarest = F.aggregate("ws", start, lambda s, x: F.when(b * s["sum"] > F.col("lack"), s).otherwise(F.struct((s["sum"] + x["words"]).alias("sum"), x["docs"].alias("reach"))))
    own = per_text.withColumn("lack", lack).select("text", rarest["reach"].alias("reach"))
    witness = cross.join(wide, "line", "left_semi").join(own, "text").where(F.col("reach") * min_sites <= F.col("docs"))
    witness = stage(witness.select("line", "site", "n"), "line-witness")
    spread = stage(_spread(witness, min_sites - margin), "line-spread")
    near = spread.where(F.col("estimate") <= min_sites + margin).select("line")
    exact = witness.join(broadcast_if_small(near), "line", "left_semi").groupBy("line").agg(F.count_distinct("site").alias("exact"))
    found = spread.join(exact, "line", "left").withColumn("sites", F.coalesce("exact", "estimate")).where(F.col("sites") >= min_sites)
    return stage(found.select("line", "sites", "occurrences"), "boilerplate")


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the boilerplate lines taken out of text, and the columns n_lines and n_removed (long)."""
    documents = stage(long_lines(docs, site, min_words), "lines")
    drop = broadcast_if_small(_boilerplate(documents, min_sites).select("line"))
    hits = documents.select("id", "text", F.inline("ls")).join(drop, "line", "left_semi").groupBy("id", "text").agg(F.collect_set("line").alias("drop"))
    # a document's lines are matched to its hits by id and text hash: rows that are alike all get them
    keyed = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_text"))
    joined = keyed.join(hits, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_text") == F.col("text")), "left").select("row", "drop")
    lines = F.split("row.text", "\n", -1)
    left = F.filter(lines, lambda x: ~F.array_contains(F.col("drop"), _hash(x)))
    out = joined.withColumn("left", F.when(F.col("drop").isNotNull(), left))
    n = F.when(F.col("row.text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    removed = F.when(F.col("left").isNotNull(), n - F.size("left")).otherwise(0).cast("long")
    text = F.when(F.col("left").isNotNull(), F.array_join("left", "\n")).otherwise(F.col("row.text"))
    columns = [text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*columns, n.alias("n_lines"), removed.alias("n_removed"))
