"""Secret scans with corpus-wide ownership, with DataFrame functions only.

Every text is searched for assignments, access keys and hex runs (the base kinds), and for other long mixed
tokens (candidates). Each value's hash is counted over the whole corpus by distinct repositories and owners.
A value that many owners have, or that several owners have in many repositories, is a copied example; another one
whose characters look random is taken for a live credential. Live tokens are added to the spans as kind `token`.

A text's matches are found once, with the lengths of the texts between them; from there on each match is a row
of its own. Offsets are running sums of those lengths, overlaps are found by running maxima, and only then do a
text's spans come together again. So m matches cost m rows, and equal texts are searched out once.

Nulls: a null text is empty; a null owner is an owner of its own. Rows that are alike get the same result
each and count once. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ._common import stage

#: Fixed patterns of the base kinds, in order; the group holds the secret.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}+", 0, 16),
)
#: Further tokens: 24 characters or more with a digit and letters in both cases.
TOKEN = ("token", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[a-z])(?=[A-Za-z0-9+/_=-]*[A-Z])[A-Za-z0-9+/_=-]{24,}+", 0, 24)
QUICK = {"token": r"[A-Za-z0-9+/_=-]{24,}"}
KINDS = (*BASE, TOKEN)
#: Values of this many owners, or of two and this many repositories, are examples; live ones have so many different characters.
EXAMPLE_OWNERS, EXAMPLE_REPOS, LIVE_CHARACTERS = 3, 16, 8
MATCH = "array<struct<ord:tinyint,pos:int,gap:int,length:int,long:boolean,hash:bigint,varied:boolean>>"


def _matches(text: Column, order: int, pattern: str, group: int, least: int, quick: str) -> Column:
    """The matches of one kind in order: characters since the one before, their own, whether the secret is long enough, its hash."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    each = F.filter(F.arrays_zip(between.alias("b"), whole.alias("w"), value.alias("v")), lambda x: x["w"].isNotNull())
    varied = lambda v: F.size(F.array_distinct(F.split(v, ""))) >= LIVE_CHARACTERS
    found = F.transform(each, lambda x, i: F.struct(F.lit(order).cast("tinyint").alias("ord"), i.alias("pos"), x["b"].alias("gap"), F.char_length(x["w"]).alias("length"), (F.char_length(x["v"]) >= least).alias("long"), F.xxhash64(x["v"]).alias("hash"), varied(x["v"]).alias("varied")))
    return F.when(text.rlike(quick), found).otherwise(F.array()).cast(MATCH)


def candidates(docs: DataFrame, repo: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, repo, owner, ka, kb (two hashes of the text) and found: all matches of each row, base and candidates, values as hashes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*[_matches(text, i, pattern, group, least, QUICK.get(kind, pattern)) for i, (kind, pattern, group, least) in enumerate(KINDS)])
    return docs.select("doc_id", F.col(repo).alias("repo"), F.col(owner).alias("owner"), F.xxhash64(text).alias("ka"), F.xxhash64(F.lit(1), text).alias("kb"), found.alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """hash, owners, repos over the whole corpus; every step sums within tasks before it shuffles."""
    values = F.transform(F.filter("found", lambda x: x["long"]), lambda x: x["hash"])
    each = found.select(F.explode(F.array_distinct(values)).alias("hash"), F.xxhash64("owner").alias("owner"), F.xxhash64("repo").alias("repo"))
    return each.groupBy("hash").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos"))


def _spans(found: DataFrame) -> DataFrame:
    """A row for each span of each distinct text: ka, kb, start, ord, end, hash, varied, apart (no base span overlaps it)."""
    once = found.where(F.size("found") > 0).groupBy("ka", "kb").agg(F.first("found").alias("found"))
    each = once.select("ka", "kb", F.inline("found"))
    walk = Window.partitionBy("ka", "kb", "ord").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(walk)).withColumn("start", F.col("end") - F.col("length")).where("long")
    text = Window.partitionBy("ka", "kb")
    up = text.orderBy("start", "ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = text.orderBy(F.desc("start"), F.desc("ord")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.col("ord") < len(BASE)
    meets = (F.max(F.when(base, F.col("end"))).over(up) > F.col("start")) | (F.min(F.when(base, F.col("start"))).over(down) < F.col("end"))
    return each.select("ka", "kb", "start", "ord", "end", "hash", "varied", (~F.coalesce(meets, F.lit(False))).alias("apart"))


def scan(docs: DataFrame, repo: str = "doc_id", owner: str = "source", example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example for each row of docs.

    n_live and n_example count the spans whose values are live, or examples; other spans are neither.
    """
    found = stage(candidates(docs, repo, owner), "secrets")
    base = F.col("ord") < len(BASE)
    example = (F.col("owners") >= example_owners) | ((F.col("owners") > 1) & (F.col("repos") >= example_repos))
    judged = _spans(found).join(ownership(found), "hash").withColumns({"example": example, "live": ~example & F.col("varied")})
    shown = judged.where(base | (F.col("live") & F.col("apart")))
    per = shown.groupBy("ka", "kb").agg(F.sort_array(F.collect_list(F.struct("start", "ord", "end", "live", "example"))).alias("listed"))
    none = F.array().cast(per.schema["listed"].dataType)
    rows = found.where(F.size("found") > 0).select("doc_id", "ka", "kb").join(per.hint("merge"), ["ka", "kb"], "left").select("doc_id", F.coalesce("listed", none).alias("listed"))
    rows = rows.unionByName(found.where(F.size("found") == 0).select("doc_id", none.alias("listed")))
    kinds = F.array(*[F.lit(k[0]) for k in KINDS])
    names = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["ord"].cast("int")), x["start"].cast("string"), x["end"].cast("string"))), ",")
    of_base = F.filter("listed", lambda x: x["ord"] < len(BASE))
    count = lambda test: F.size(F.filter("listed", test)).cast("long")
    of_kind = lambda order: count(lambda x: x["ord"] == order)
    return rows.select(
        "doc_id", *[of_kind(i).alias(f"n_{k[0]}") for i, k in enumerate(BASE)], F.sha2(names(of_base).cast("binary"), 256).alias("base_sha256"),
        names(F.col("listed")).alias("spans"), count(lambda x: x["live"]).alias("n_live"), count(lambda x: x["example"]).alias("n_example"),
    )
