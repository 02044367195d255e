"""Mixing sources to target weights by a low-discrepancy schedule.

Van der Corput points (bit reversal in base 2) are mapped through the sources' cumulative slot counts. A
point's rank within its source is a closed form of its bits, so no window over a hot source is needed. Slot
j of a source takes block j of the source's shuffled token stream, and the stream repeats by epochs.

The mix itself (mixed_documents) has whole documents: one that the schedule cuts at its source's end counts if half
or more of it is taken, so a source's total may miss its target by half of one document. Each copy stands at the
position of its first word. The rows of every partition, hence of every file, come in the order of positions; partitions
are drawn by hash, so each is a mix of its own. One order over all costs another shuffle of the texts.

Nulls and ties: a null source is a source of its own (last); null or blank texts have size 0 and are never
taken; rows that are alike share the hash order and are interchangeable. An empty table gives no rows.
Other columns of the input are not read, or pass through with the rows, whatever their names and types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ._common import broadcast_if_small, packed, row_key, running_total, stage, word_count

#: Words in a block, slots in a chunk, slots that a task makes.
BLOCK_WORDS, CHUNK, SLOTS_A_TASK = 1024, 4096, 1 << 16


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """A row for each source of sizes(source, size): source_size, weight and target.

    share = (a, b): the targets add up to a/b of all words. A target stops at `most` times its source's
    size; what is cut off is shared again by weight, which ends where target = min(cap, level * weight).
    """
    a, b = share
    total, by_name = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    dec = lambda c: c.cast("decimal(38,0)")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("ordinal", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), F.col("ordinal") % len(weights) + 1))
    per = per.withColumn("cap", F.col("source_size") * most)
    by_level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumns({"_caps": F.sum("cap").over(by_level), "_later": F.sum("weight").over(total) - F.sum("weight").over(by_level), "_all": F.sum("source_size").over(total)})
    capped = b * (dec(F.col("_caps")) * F.col("weight") + dec(F.col("cap")) * F.col("_later")) <= a * dec(F.col("_all")) * F.col("weight")
    per = per.withColumn("_capped", capped)
    per = per.withColumns({"_cut": F.coalesce(F.sum(F.when(F.col("_capped"), F.col("cap"))).over(total), F.lit(0)), "_free": F.sum(F.when(~F.col("_capped"), F.col("weight"))).over(total)})
    level = (F.col("weight") * (a * F.col("_all") - b * F.col("_cut"))).cast("double") / (b * F.col("_free")).cast("double")
    return per.select("source", "source_size", "ordinal", "weight", F.when(F.col("_capped"), F.col("cap").cast("double")).otherwise(level).alias("target"))


def _bits(v: str, bits: int, term) -> Column:
    return F.expr(" + ".join(["0L", *[f"(((shiftright({v}, {q}) & 1L)) * ({term(q)}))" for q in range(bits)]]))


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """The slots of the mix: position (van der Corput order), source, epoch, block, upto.

    upto is where the slot's words end within its source's stream; the last slot of a source is cut so that
    the source gets exactly floor(target) words.
    """
    t = F.floor("target").cast("long")
    s = F.greatest(F.col("source_size"), F.lit(1))
    plan = targets.select("source", "source_size", "ordinal", "target", F.floor(t / s).cast("long").alias("epochs"), t.alias("t"))
    plan = plan.withColumn("rest", F.col("t") - F.col("epochs") * F.col("source_size")).withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    plan = plan.withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long"))
    plan = stage(plan.withColumn("hi", F.sum("slots").over(Window.orderBy("ordinal"))).withColumn("lo", F.col("hi") - F.col("slots")), "mix-plan")
    n = plan.agg(F.max("hi")).head()[0] or 0
    bits = max(1, (n - 1).bit_length()) if n else 1
    chunks = plan.where("slots > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK)))).repartition(-(-n // SLOTS_A_TASK) or 1, F.col("ordinal"), F.col("chunk"))
    last = F.least(F.col("lo") + (F.col("chunk") + 1) * CHUNK, F.col("hi")) - 1
    points = chunks.withColumn("v", F.explode(F.sequence(F.col("lo") + F.col("chunk") * CHUNK, last)))
    # points of this source that come before v: for each set bit q of v, those that agree with v below q and have q unset
    below = lambda h, q: f"shiftright({h} - (v & {(1 << q) - 1}L) + {(2 << q) - 1}L, {q + 1})"
    points = points.withColumn("rank", _bits("v", bits, lambda q: f"{below('hi', q)} - {below('lo', q)}")).withColumn("position", _bits("v", bits, lambda q: f"{1 << (bits - 1 - q)}L"))
    points = points.withColumns({"epoch": F.floor(F.col("rank") / F.col("blocks")).cast("long"), "block": (F.col("rank") % F.col("blocks")).cast("long")})
    end = F.when(F.col("epoch") < F.col("epochs"), F.col("source_size")).otherwise(F.col("rest"))
    return points.select("position", "source", "epoch", "block", F.least((F.col("block") + 1) * block, end).alias("upto"))


def taken_pieces(docs: DataFrame, weights: Sequence[int], share: tuple[int, int], most: int, block_words: int, keep: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, targets, pieces): pieces has a row for each part of a row of docs that a slot takes: position, epoch, words.

    Rows with words that no slot takes have one piece without position.
    """
    slim = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *keep)
    slim = stage(slim, "mix-sizes")
    n = slim.count()
    targets = stage(source_targets(slim, weights, share, most), "mix-targets")
    slots = schedule(targets, block_words)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    spread = F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / 4
    tie = [F.xxhash64(*keep)] if keep else []
    rows = running_total(slim, ["source"], [key, F.col("doc_id").asc_nulls_first(), F.col("size"), *tie], "at", n, "size", spread.cast("long"))
    first, last = F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words)
    pieces = rows.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    pieces = pieces.withColumns({"_from": F.greatest("at", F.col("block") * block_words), "_to": F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)})
    s = slots.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "position", "epoch", "upto").hint("merge")  # slots grow with the input: never broadcast
    got = pieces.join(s, pieces.source.eqNullSafe(s._source) & (pieces.block == s._block), "left")
    words = F.when(F.col("upto").isNull(), 0).otherwise(F.greatest(F.least("_to", "upto") - F.col("_from"), F.lit(0))).cast("long")
    got = got.select("doc_id", "source", "size", "at", *keep, "position", "epoch", words.alias("words"))
    return slim, targets, got.withColumn("position", F.when(F.col("words") > 0, F.col("position")))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """For each row of docs(doc_id, text, source): size, source_size, target, taken, first_position (or null), source.

    taken counts the words that the mix takes from the row, repeats counted; it never exceeds `most` times
    the row's size. first_position is where in the schedule the row's words first stand.
    """
    slim, targets, pieces = taken_pieces(docs, weights, share, most, block_words, ())
    taken = pieces.groupBy("doc_id", "source", "size", "at").agg(F.sum("words").alias("taken"), F.min("position").alias("first_position")).drop("at")
    every = taken.unionByName(slim.where("size = 0").withColumns({"taken": F.lit(0).cast("long"), "first_position": F.lit(None).cast("long")}))
    info = broadcast_if_small(targets.select(F.col("source").alias("_source"), "source_size", "target"))
    return every.join(info, every.source.eqNullSafe(info._source), "inner").select("doc_id", "size", "source_size", "target", "taken", "first_position", "source")


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2, block_words: int = BLOCK_WORDS, one_order: bool = False) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, in the schedule's order within each partition (one_order: over all).

    Only ids and sizes go through the schedule; texts are joined once. Rows that are alike in all columns are one
    row with their repeats added up.
    """
    keyed = docs.select(row_key(docs).alias("_mix"), "doc_id", "source", "text")
    slim, _, pieces = taken_pieces(keyed, weights, share, most, block_words, ("_mix",))
    copies = pieces.groupBy("_mix", "doc_id", "source", "size", "at", "epoch").agg(F.sum("words").alias("words"), F.min("position").alias("position"))
    copies = stage(copies.where("2 * words >= size").select("_mix", "position"), "mix-copies")
    alike = stage(slim.where("size > 0").groupBy("_mix").agg(F.count("*").alias("n")).where("n > 1").select("_mix"), "mix-alike")
    rows = docs.select(row_key(docs).alias("_key"), packed(docs).alias("row"))
    # a row that is alone in its kind has its few positions listed; rows that are alike are one row that meets its many positions by a join
    few = broadcast_if_small(alike)
    listed = copies.join(few, "_mix", "left_anti").groupBy("_mix").agg(F.collect_list("position").alias("positions"))
    mixed = rows.join(listed.hint("merge"), F.col("_key") == F.col("_mix")).select("row", F.explode("positions").alias("position"))
    if alike.head() is not None:
        one = rows.join(few, F.col("_key") == F.col("_mix"), "left_semi").groupBy("_key").agg(F.first("row").alias("row"))
        mixed = mixed.unionByName(one.join(copies.join(few, "_mix", "left_semi").hint("merge"), F.col("_key") == F.col("_mix")).select("row", "position"))
    if one_order:
        top = copies.agg(F.max("position")).head()[0] or 0
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        mixed = mixed.repartitionById(n, F.floor(F.col("position") * n / (top + 1)).cast("int"))
    return mixed.sortWithinPartitions("position").select("row.*")
