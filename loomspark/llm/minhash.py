"""Near-duplicate documents by MinHash on word shingles.

Texts that are the same sequence of words are one node. Nodes get many universal hash minima of their
shingle sets; nodes that agree in a band of minima are candidates. Components of the candidate graph
(each node with the least node of its bucket) hold every pair that any band has found. Within such a
cluster signatures are compared, and every pair that may reach the threshold is checked on the full sets,
except between nodes that are linked already. Clusters larger than a block are cut into blocks, and each
pair of blocks is a task of its own; so no task gets a whole cluster, and nothing is capped. The links
then give the components by large-star and small-star.

Nulls: null, empty and blank texts have no shingles and are linked with nothing. A null doc_id belongs to its
component but doesn't name it, unless all are null. Rows that are alike are one node. An empty table gives
no rows; other columns are not read, or pass through with the rows that stay. Very long texts are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import WORD, packed, small_batches, stage
from .components import connected_components

#: 196 minima in 28 bands of 7: a pair at similarity 0.85 escapes all bands with probability 2e-5, at 0.8 with 1.4e-3.
BANDS, ROWS = 28, 7
#: More bands of fewer rows for lower thresholds: see bands_for.
BLOCK = 256
#: Signatures this far below the threshold (4.5 standard deviations of the estimate) are not checked.
MARGIN = 0.12

_U = np.uint64
_M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def bands_for(threshold: float) -> tuple[int, int]:
    """(bands, rows) so that a pair at the threshold escapes with probability 1e-4 at most."""
    if threshold >= 0.85:
        return BANDS, ROWS
    rows = 6 if threshold >= 0.8 else 5
    return int(np.ceil(np.log(1e-4) / np.log(1 - threshold**rows))), rows


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) << _U(1) | _U(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _M2
    x = (x ^ (x >> _U(29))) * _M1
    return x ^ (x >> _U(32))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def normal(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case; bytes split at exactly the six ASCII blanks."""
    return (text or "").encode().lower().split()


def _node(words: list[bytes]) -> int | None:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63) if words else None


def shingles(tokens: list[bytes], k: int, words: dict) -> np.ndarray:
    """The sorted distinct hashes of the k-word shingles; fewer words are one shingle."""
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.array([words[w] for w in tokens], dtype=np.uint64)
    n = max(1, len(h) - k + 1)
    x = np.full(n, min(len(h), k), dtype=np.uint64)
    for i in range(min(k, len(h))):
        x = x * _M1 + h[i : i + n]
    return np.unique(_mix(x))


def signature(x: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 28) -> np.ndarray:
    out = np.empty(len(a), np.uint64)
    for i in range(0, len(a), step):
        m = a[i : i + step, None] * x
        m += b[i : i + step, None]
        out[i : i + step] = m.min(axis=1)
    return out


def _row(docs: DataFrame) -> Column:
    """A row's key, from its id and text."""
    return F.xxhash64("doc_id", F.xxhash64("text"))


def features(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row, node, n_shingles, bands of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (a, b) = _Words(), coefficients(bands * rows)
        salt = _mix(np.arange(1, bands + 1, dtype=np.uint64))
        with np.errstate(over="ignore"):
            for batch in batches:
                node, count, found = [], [], []
                for text in batch.column(2).to_pylist():
                    tokens = normal(text)
                    x = shingles(tokens, k, words)
                    node.append(_node(tokens))
                    count.append(len(x))
                    if len(x):
                        band = salt.copy()
                        for minima in signature(x, a, b).reshape(bands, rows).T:
                            band = _mix(band * _M1 + minima)
                        found.append(band.view(np.int64))
                    else:
                        found.append(None)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node, pa.int64()), pa.array(count, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "row", "node", "n_shingles", "bands"])

    return docs.select("doc_id", _row(docs).alias("row"), "text").mapInArrow(run, f"doc_id {kind}, row bigint, node bigint, n_shingles bigint, bands array<bigint>")


def _links(names: list[int], sets: list[np.ndarray], sides: np.ndarray, across: bool, threshold: tuple[int, int], a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all that is linked in a block, or across two; most alike signatures first."""
    part, whole = threshold
    parent = list(range(len(names)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out = []
    signatures = np.stack([signature(x, a, b) for x in sets])
    size = np.array([len(x) for x in sets])
    left, right = (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)) if across else (np.arange(len(sets)),) * 2
    pairs = []
    for i in left:
        others = right if across else right[right > i]
        others = others[np.minimum(size[others], size[i]) * whole >= part * np.maximum(size[others], size[i])]
        if len(others):
            alike = (signatures[others] == signatures[i]).mean(axis=1)
            ok = alike >= part / whole - MARGIN
            pairs += zip(alike[ok].tolist(), [int(i)] * int(ok.sum()), others[ok].tolist(), strict=True)
    for _, i, j in sorted(pairs, key=lambda p: -p[0]):
        if (r := find(i)) != (s := find(j)):
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if whole * common >= part * (size[i] + size[j] - common):
                parent[r] = s
                out.append((names[i], names[j]))
    return out


def verified(groups: DataFrame, k: int, threshold: tuple[int, int], n_hashes: int) -> DataFrame:
    """Links (u, v) within each group of rows (cluster, b1, b2, side, node, text), one group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (a, b) = _Words(), coefficients(n_hashes)
        key, rows = None, {}

        def close() -> list[tuple[int, int]]:
            if len(rows) < 2:
                return []
            across = key[1] != key[2]
            names = list(rows)
            return _links(names, [rows[n][1] for n in names], np.array([rows[n][0] for n in names]), across, threshold, a, b)

        def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["u", "v"])

        with np.errstate(over="ignore"):
            for batch in batches:
                found = []
                for cluster, b1, b2, side, node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (cluster, b1, b2) != key:
                        found += close()
                        key, rows = (cluster, b1, b2), {}
                    if node not in rows:
                        rows[node] = (side, shingles(normal(text), k, words))
                yield batch_of(found)
            yield batch_of(close())

    return groups.select("cluster", "b1", "b2", "side", "node", "text").mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, root and row (keys of the component and the row) for each row of docs(doc_id, text).

    Two documents are linked if whole * |A and B| >= part * |A or B| for threshold = (part, whole).
    """
    bands, rows = bands_for(threshold[0] / threshold[1])
    every = stage(features(docs, k, bands, rows), "minhash")
    nodes = every.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("row").alias("source"), F.first("bands").alias("bands"))
    nodes = stage(nodes, "minhash-nodes")
    members = nodes.select("node", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1").select("band", "first")
    candidates = members.join(buckets, "band").where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v")).distinct()
    clusters = stage(connected_components(candidates).join(nodes.select("node", "source"), "node"), "minhash-clusters")
    large = clusters.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("root", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = clusters.join(large, "root", "left").select(F.col("root").alias("cluster"), "node", "source", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    texts = docs.select(_row(docs).alias("row"), "text").join(placed.hint("merge"), F.col("row") == F.col("source")).select("cluster", "blocks", "node", "text")
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    spread = texts.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = spread.select("cluster", F.least("mine", "other").alias("b1"), F.greatest("mine", "other").alias("b2"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "node", "text")
    groups = groups.repartition("cluster", "b1", "b2").sortWithinPartitions("cluster", "b1", "b2")
    roots = connected_components(verified(groups, k, threshold, bands * rows))
    named = nodes.select("node", "rep").join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    named = stage(named, "minhash-roots")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    joined = named.join(least, "root").select(F.col("node").alias("_n"), "root", "component_id")
    out = every.select("doc_id", "n_shingles", "node", "row").join(joined, F.col("node") == F.col("_n"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "root", "row")


def keep_one(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """docs with one row of each component: one with its least doc_id. Rows without words all stay; all columns pass through."""
    found = near_duplicates(docs, k, threshold)
    kept = found.where(F.col("kept") & F.col("root").isNotNull()).groupBy("root").agg(F.min("row").alias("kept_row")).select("kept_row").hint("merge")
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    keyed = docs.select(_row(docs).alias("key"), has_words.alias("has_words"), packed(docs).alias("whole"))
    one = keyed.where("has_words").join(kept, F.col("key") == F.col("kept_row"), "left_semi").groupBy("key").agg(F.first("whole").alias("whole"))
    return one.select("whole").unionByName(keyed.where("NOT has_words").select("whole")).select("whole.*")
