"""The queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hilbert, htmltext, langid, linededup, minhash, mixing, packing, quality, rpforest, secrets


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_position")


def op2_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard(_table(spark, sf_dir, "documents"))


def op5_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", *quality.COUNTS, "base_failed", "kept", "rule")


def op7_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rpforest.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), 3, (85, 100)).drop("root", "row")


def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.remove_boilerplate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_byte_network": op2_byte_network,
    "op3_secret_ownership": op3_secret_ownership,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_bin_completion": op5_bin_completion,
    "op6_decision_list": op6_decision_list,
    "op7_projection_forest": op7_projection_forest,
    "op8_host_consensus": op8_host_consensus,
    "op9_minhash_components": op9_minhash_components,
    "op10_line_spread": op10_line_spread,
}

def _hilbert_sql(bits: int = 4, dims: int = 3) -> str:
    """The curve of op4 as steps of a query: cells(x0, x1, x2, curve_index), one step for each bit and axis."""
    side, names = 1 << bits, ", ".join(f"x{i}" for i in range(dims))
    cells = ", ".join(f"(c // {side ** (dims - 1 - i)}) % {side} AS x{i}" for i in range(dims))
    out, last = [f"h0 AS (SELECT c AS cell, {cells} FROM range({side**dims}) AS r(c))"], "h0"
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(dims):
            swap = f"(xor(x0, x{i}) & {p})"
            new = {"x0": f"CASE WHEN x{i} & {q} <> 0 THEN xor(x0, {p}) ELSE xor(x0, {swap}) END"}
            if i:
                new[f"x{i}"] = f"CASE WHEN x{i} & {q} <> 0 THEN x{i} ELSE xor(x{i}, {swap}) END"
            name = f"h{b}_{i}"
            out.append(f"{name} AS (SELECT cell, {', '.join(f'{new.get(x, x)} AS {x}' for x in names.split(', '))} FROM {last})")
            last = name
    gray = ["x0"]
    for i in range(1, dims):
        gray.append(f"xor(x{i}, {gray[-1]})")
    out.append(f"g AS (SELECT cell, {', '.join(f'{e} AS x{i}' for i, e in enumerate(gray))} FROM {last})")
    turn = "0"
    for b in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN x{dims - 1} & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    out.append(f"t AS (SELECT *, {turn} AS t FROM g)")
    index = " + ".join(f"((xor(x{i}, t) >> {b}) & 1) * {1 << (b * dims + dims - 1 - i)}" for b in range(bits) for i in range(dims))
    out.append(f"curve AS (SELECT cell, {index} AS curve_index FROM t)")
    return ",\n".join(out)


#: DuckDB SQL for the same rows. op1: a source's stream is its rows by the hash of their ids, taken from its
#: start and repeated until the target is met. op3: values themselves instead of hashes. op10: exact site counts instead of sketches.
ORACLES: dict[str, str] = {
    "op1_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS ordinal
  FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE ordinal % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS BIGINT) AS weight, 2 * source_size AS cap FROM s),
c AS (
  SELECT *, sum(source_size) OVER () AS total,
         sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, ordinal ROWS UNBOUNDED PRECEDING) AS caps,
         sum(weight) OVER () - sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, ordinal ROWS UNBOUNDED PRECEDING) AS later
  FROM w),
f AS (SELECT *, 2 * (caps * weight + cap * later) <= 3 * total * weight AS capped FROM c),
g AS (
  SELECT *, coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS cut, sum(CASE WHEN NOT capped THEN weight END) OVER () AS free FROM f),
t AS (
  SELECT source, source_size, ordinal,
         CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE CAST(weight * (3 * total - 2 * cut) AS DOUBLE) / CAST(2 * free AS DOUBLE) END AS target
  FROM g),
p AS (
  SELECT *, CAST(floor(target) AS BIGINT) // greatest(source_size, 1) AS epochs, CAST(floor(target) AS BIGINT) % greatest(source_size, 1) AS rest FROM t),
o AS (
  SELECT *, row_number() OVER () AS r, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at FROM d),
n AS (SELECT *, (source_size + 1023) // 1024 AS blocks, epochs * ((source_size + 1023) // 1024) + (rest + 1023) // 1024 AS slots FROM p),
z AS (SELECT *, CAST(sum(slots) OVER (ORDER BY ordinal) AS BIGINT) AS hi FROM n),
b AS (SELECT greatest(1, length(bin(greatest(0, max(hi) - 1)))) AS bits FROM z),
v AS (SELECT source, source_size, blocks, epochs, rest, unnest(range(hi - slots, hi)) AS v FROM z),
x AS (SELECT *, CAST(list_sum(list_transform(range(bits), lambda q: ((v >> q) & 1) << (bits - 1 - q))) AS BIGINT) AS position FROM v, b),
y AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY position)) - 1 AS nth FROM x),
slot AS (SELECT source, position, nth % blocks AS block, least((nth % blocks + 1) * 1024, CASE WHEN nth // blocks < epochs THEN source_size ELSE rest END) AS upto FROM y),
first AS (
  SELECT r, min(position) AS first_position FROM o JOIN slot ON o.source IS NOT DISTINCT FROM slot.source
  WHERE o.size > 0 AND block * 1024 < o.at + o.size AND (block + 1) * 1024 > o.at AND upto > greatest(o.at, block * 1024)
  GROUP BY r)
SELECT o.doc_id, o.size, p.source_size, p.target,
       CAST(o.size * p.epochs + greatest(0, least(o.at + o.size, p.rest) - o.at) AS BIGINT) AS taken, f.first_position
FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source LEFT JOIN first AS f USING (r)
""",
    "op3_secret_ownership": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
p(ord, kind, least) AS (VALUES (0, 'assign', 12), (1, 'access', 18), (2, 'hex', 16), (3, 'token', 24)),
m AS (
  SELECT r, ord, kind, least, regexp_extract_all(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS w,
         regexp_extract_all(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) AS v,
         string_split_regex(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS b FROM d, p WHERE ord = 0
  UNION ALL SELECT r, ord, kind, least, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), string_split_regex(t, 'AKIA[A-Z0-9]+') FROM d, p WHERE ord = 1
  UNION ALL SELECT r, ord, kind, least, regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'), string_split_regex(t, '[0-9a-f]+') FROM d, p WHERE ord = 2
  UNION ALL SELECT r, ord, kind, least, regexp_extract_all(t, '[A-Za-z0-9+/_=-]+'), regexp_extract_all(t, '[A-Za-z0-9+/_=-]+'), string_split_regex(t, '[A-Za-z0-9+/_=-]+') FROM d, p WHERE ord = 3),
e AS (
  SELECT r, ord, kind, least, unnest(w) AS w, unnest(v) AS v, unnest(list_slice(b, 1, len(w))) AS b, unnest(generate_series(1, len(w))) AS pos
  FROM m WHERE len(w) > 0),
o AS (SELECT *, sum(length(b) + length(w)) OVER (PARTITION BY r, ord ORDER BY pos) AS stop FROM e),
s AS (
  SELECT r, ord, kind, v, CAST(stop - length(w) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM o
  WHERE length(v) >= least AND (ord < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')))),
c AS (
  SELECT v, count(DISTINCT coalesce(source, chr(1))) AS owners, count(DISTINCT coalesce(doc_id, -1)) AS repos
  FROM s JOIN d USING (r) GROUP BY v),
j AS (
  SELECT s.*, owners >= 3 OR (owners > 1 AND repos >= 16) AS example, len(list_distinct(string_split(v, ''))) >= 8 AS varied
  FROM s JOIN c USING (v)),
k AS (
  SELECT *, NOT example AND varied AS live FROM j
  WHERE ord < 3 OR (NOT example AND varied AND NOT EXISTS (SELECT 1 FROM s AS y WHERE y.r = j.r AND y.ord < 3 AND y.start < j.stop AND j.start < y.stop))),
g AS (
  SELECT r, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example
  FROM k GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN g USING (r)
""",
    "op4_hilbert_shards": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, ''))) + 1 AS size, md5(coalesce(text, '')) AS k, lang, source,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS dk FROM documents),
lang_n AS (SELECT lang AS v, count(*) AS n FROM d GROUP BY lang),
lang_s AS (SELECT v, (16 * (2 * coalesce(sum(n) OVER (ORDER BY v NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + n)) // (2 * sum(n) OVER ()) AS step FROM lang_n),
source_n AS (SELECT source AS v, count(*) AS n FROM d GROUP BY source),
source_s AS (SELECT v, (16 * (2 * coalesce(sum(n) OVER (ORDER BY v NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + n)) // (2 * sum(n) OVER ()) AS step FROM source_n),
""" + _hilbert_sql() + r""",
o AS (
  SELECT k, count(*) AS n, min(size) AS size, first(lang ORDER BY lang NULLS FIRST, source NULLS FIRST) AS lang, first(source ORDER BY lang NULLS FIRST, source NULLS FIRST) AS source
  FROM d GROUP BY k),
p AS (
  SELECT o.k, o.n, curve_index FROM o
  JOIN lang_s ON o.lang IS NOT DISTINCT FROM lang_s.v JOIN source_s ON o.source IS NOT DISTINCT FROM source_s.v
  JOIN curve ON cell = 256 * greatest(0, least(15, 2 * length(bin(size)) + coalesce(TRY_CAST(substr(bin(size), 2, 1) AS INTEGER), 0) - 14)) + 16 * lang_s.step + source_s.step),
r AS (
  SELECT doc_id, t, size, curve_index, row_number() OVER (ORDER BY curve_index, k, dk, doc_id NULLS FIRST) - 1 AS rank, count(*) OVER () AS n
  FROM d JOIN p USING (k)),
s AS (SELECT *, (rank * 8) // n AS shard FROM r),
tab AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS tab
  FROM range(256) AS x(n)),
crcs AS (
  SELECT t, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) AS crc
  FROM (SELECT DISTINCT t FROM d), tab)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(rank - (shard * n + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, CAST(curve_index AS BIGINT) AS curve_index
FROM s JOIN crcs USING (t)
""",
    "op10_line_spread": r"""
WITH d AS (SELECT doc_id, text, source, string_split(text, chr(10)) AS lines FROM documents),
u AS (
  SELECT DISTINCT text, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS total, unnest(list_transform(lines, lambda x: trim(x))) AS line FROM d WHERE text IS NOT NULL),
l AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM u WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 4),
several AS (SELECT line FROM l GROUP BY line HAVING count(DISTINCT coalesce(source, chr(1))) > 1),
docs AS (SELECT line, count(*) AS docs FROM (SELECT doc_id, text, source, unnest(list_distinct(list_transform(lines, lambda x: trim(x)))) AS line FROM d) WHERE line IN (SELECT line FROM several) GROUP BY line),
t AS (SELECT text, any_value(total) AS total, sum(n) AS long, coalesce(sum(n) FILTER (line IN (SELECT line FROM several)), 0) AS shared FROM (SELECT DISTINCT text, total, line, n FROM l) GROUP BY text),
k AS (SELECT *, CASE WHEN 2 * shared <= total THEN -1 ELSE total - 5 * (long - shared) END AS lack FROM t),
x AS (SELECT text, docs, coalesce(sum(n) OVER (PARTITION BY text ORDER BY docs, n, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT DISTINCT text, line, n FROM l) JOIN docs USING (line)),
reach AS (SELECT k.text, coalesce(max(x.docs) FILTER (5 * before <= lack), 0) AS reach FROM k LEFT JOIN x ON x.text = k.text GROUP BY k.text),
gone AS (
  SELECT line FROM l JOIN docs USING (line) JOIN reach USING (text) WHERE reach * 5 <= docs
  GROUP BY line HAVING count(DISTINCT coalesce(source, chr(1))) >= 5),
g AS (SELECT coalesce(list(line), CAST([] AS VARCHAR[])) AS gone FROM gone),
r AS (SELECT doc_id, text, lines, list_filter(lines, lambda x: NOT list_contains(gone, trim(x))) AS remaining FROM d, g)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(remaining), 0) AS BIGINT) AS n_removed,
       CAST(length(array_to_string(remaining, chr(10))) AS BIGINT) AS n_chars, md5(array_to_string(remaining, chr(10))) AS text_md5
FROM r
""",
}
