"""Near-duplicate embeddings by a forest of random-projection trees with spill.

Each tree splits by random directions, one for each level; the thresholds of the upper nodes are quantiles
of a bounded sample, and deeper nodes use their level's median. Vectors near a threshold go to both sides.
Vectors that share a leaf and a label are compared in double precision; large leaves are compared block by
block. Of what is linked in a leaf only as many links leave it as hold it together, and these are united. Links
are then counted within the united components, whose vectors are compared block by block once more: every block
gives a count for each of its vectors. So no pairs are listed or made distinct, and equal vectors of a label are
one node.

A leaf holds many vectors (LEAF), since comparing them costs little beside moving them: three shallow trees find
what many deep ones do, and move a third as many copies. At a cosine of just 0.98 a level parts 1 % of the pairs, so with d
levels three trees miss (1 - 0.99**d)**3 of them: 1e-5 at 2 levels (50 thousand vectors), 0.3 % at 16 (a billion).

Nulls: vectors that are null, empty, zero, or hold null or non-finite components, and rows without a label,
link with nothing and form components of their own. A null vec_id belongs to its component but doesn't name it,
unless all are null. Vectors of other lengths than the most common use trees of their own with thresholds
at zero. Rows that are alike are one node. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import broadcast_if_small, small_batches, stage
from .components import connected_components

TREES, LEAF, BLOCK = 3, 16_384, 8192
#: Rows of a block that are compared with the others at a time.
STRIP = 256
#: Vectors that the thresholds are fitted on, at most (those with the least hashes).
SAMPLE = 16_000
#: Half the width of the spill zone, as a share of the largest distance of linked unit vectors.
SPILL = 0.07


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares of very large or small components overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Forest:
    """Directions from a seed; thresholds by (tree, path) for the nodes that the sample fills."""

    def __init__(self, sample: np.ndarray, n: int, trees: int = TREES, leaf: int = LEAF, spill: float = 0.0, seed: int = 11):
        self.trees, self.spill, self.seed = trees, spill, seed
        self.depth = max(0, int(np.ceil(np.log2(max(n, 1) / leaf))))
        self.dim = sample.shape[1] if sample.size else 0
        self.nodes: list[list[np.ndarray]] = []
        x = _unit(sample.astype(np.float64)) if sample.size else sample
        for t in range(trees):
            levels, path = [], np.zeros(len(x), np.int64)
            p = x @ self.directions(t, self.dim).T if len(x) else np.zeros((0, self.depth))
            for level in range(self.depth):
                fitted = min(level, max(0, int(np.log2(max(len(x), 1) / 64))))
                cut = np.full(1 << fitted, np.median(p[:, level]) if len(x) else 0.0)
                for node in range(1 << fitted):
                    mine = p[path & ((1 << fitted) - 1) == node, level] if fitted == level else np.empty(0)
                    if len(mine) >= 32:
                        cut[node] = np.quantile(mine, 0.4 + 0.2 * self._draw(t, level, node))
                levels.append(cut if fitted == level else cut[:1])
                if len(x):
                    at = cut[path] if fitted == level else cut[0]
                    path |= (p[:, level] > at).astype(np.int64) << level
            self.nodes.append(levels)

    def _draw(self, *key: int) -> float:
        return float(np.random.default_rng([self.seed, *key]).random())

    def directions(self, tree: int, dim: int) -> np.ndarray:
        if not self.depth or not dim:
            return np.zeros((self.depth, dim))
        d = np.random.default_rng([self.seed, tree, dim]).standard_normal((self.depth, dim))
        return d / np.linalg.norm(d, axis=1, keepdims=True)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for each leaf of each tree that a row of unit vectors falls into."""
        rows_out, leaves_out = [], []
        for t in range(self.trees):
            p = x @ self.directions(t, x.shape[1]).T
            rows, path = np.arange(len(x)), np.zeros(len(x), np.int64)
            for level in range(self.depth):
                cut = self.nodes[t][level]
                at = (cut[path] if len(cut) > 1 or level == 0 else cut[0]) if x.shape[1] == self.dim else 0.0
                gap = p[rows, level] - at
                both = np.abs(gap) <= self.spill
                right = (gap > 0).astype(np.int64) << level
                rows, path = np.concatenate([rows, rows[both]]), np.concatenate([path | right, path[both] | ((1 << level) - right[both])])
            rows_out.append(rows)
            leaves_out.append(path * self.trees + t)
        return np.concatenate(rows_out), np.concatenate(leaves_out)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def held_together(x: np.ndarray, least: float, first: int = 0) -> list[tuple[int, int]]:
    """Links that join all that is linked among unit vectors; of those from the rows before `first` (if any) to the rest."""
    label = np.arange(len(x))
    out: list[tuple[int, int]] = []
    for start in range(0, first or len(x), STRIP):
        stop, other = min(start + STRIP, first or len(x)), first or start + 1
        i, j = np.nonzero(x[start:stop] @ x[other:].T >= least)
        i, j = i + start, j + other
        i, j = i[i < j], j[i < j]
        while True:  # each round links every part to another one, until all are joined
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            if not len(i):
                break
            picks = np.union1d(np.unique(i, return_index=True)[1], np.unique(j, return_index=True)[1])
            parent: dict[int, int] = {}

            def find(k: int, parent=parent) -> int:
                while (up := parent.get(k, k)) != k:
                    parent[k] = k = parent.get(up, up)
                return k

            for u, v in zip(i[picks].tolist(), j[picks].tolist(), strict=True):
                a, b = find(int(label[u])), find(int(label[v]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((u, v))
            names = np.arange(len(x))
            for k in parent:
                names[k] = find(k)
            label = names[label]
    return out


def counted(x: np.ndarray, weight: np.ndarray, least: float, first: int = 0) -> np.ndarray:
    """The summed weight of the vectors linked with each; of rows before `first` (if any) against the rest."""
    out = np.zeros(len(x), np.int64)
    w = weight.astype(np.float64)
    for start in range(0, first or len(x), STRIP):
        stop = min(start + STRIP, first or len(x))
        hit = x[start:stop] @ x[first:].T >= least
        if first:
            out[first:] += (w[start:stop] @ hit).astype(np.int64)
        else:
            hit[np.arange(stop - start), np.arange(start, stop)] = False
        out[start:stop] = (hit @ w[first:]).astype(np.int64)
    return out


def blocks(rows: DataFrame, key: list[str], size: int) -> DataFrame:
    """rows(*key, node, ...) once for each pair (b1, b2) of blocks of its group that its own block is in; side: 1 in b2, 0 in b1."""
    large = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > size).select(*key, F.ceil(F.col("n") / size).cast("int").alias("blocks"))
    placed = rows.join(broadcast_if_small(stage(large, "forest-large")), key, "left").withColumn("mine", F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    spread = spread.withColumns({"b1": F.least("mine", "other"), "b2": F.greatest("mine", "other"), "side": (F.col("mine") > F.col("other")).cast("int")})
    keys = [*key, "b1", "b2"]
    return spread.drop("blocks", "mine", "other").repartition(*keys).sortWithinPartitions(*keys, "side")


def groups_of(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """(key, further columns) of each run of rows with the same first n_keys columns; embedding becomes unit vectors."""
    now, held = None, []

    def close() -> dict[str, np.ndarray]:
        names = held[0].schema.names[n_keys:]
        out = {c: np.concatenate([part.column(part.schema.get_field_index(c)).to_numpy() for part in held]) for c in names if c != "embedding"}
        return out | {"x": _unit(np.concatenate([_flat(part.column(part.schema.get_field_index("embedding"))) for part in held]).reshape(len(out["node"]), -1))}

    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys)), strict=True))
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                if held and keys[start] != now:
                    yield now, close()
                    held = []
                now = keys[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield now, close()


def links(reps: DataFrame, least: float = 0.98, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """Links (u, v) that hold together what is linked in the leaves; reps(node, label, embedding)."""
    spark = reps.sparkSession
    small_batches(spark, 1024)
    n = reps.count()
    common = reps.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = common[0]["d"] if common else 0
    taken = [r[0] for r in reps.where(F.size("embedding") == dim).orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").collect()]
    forest = Forest(np.array(taken, dtype=np.float64).reshape(len(taken), dim), n, trees, leaf, SPILL * np.sqrt(max(0.0, 2 - 2 * least)))
    shared = spark.sparkContext.broadcast(forest)  # as large as the bounded sample makes it

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for d in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == d)
                x = _flat(batch.column(1).take(pa.array(rows))).reshape(len(rows), d)
                at, leaf_ids = shared.value.leaves(_unit(x))
                index = pa.array(rows[at])
                yield pa.RecordBatch.from_arrays([pa.array(leaf_ids), pa.array(np.full(len(at), d), pa.int32()), *(batch.column(c).take(index) for c in (2, 0, 1))], ["leaf", "dim", "label", "node", "embedding"])

    kinds = {f.name: f.dataType.simpleString() for f in reps.schema}
    dealt = reps.select("node", "embedding", "label").mapInArrow(deal, f"leaf bigint, dim int, label {kinds['label']}, node bigint, embedding {kinds['embedding']}")
    key = ["leaf", "dim", "label"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (*_, b1, b2), group in groups_of(batches, 5):
            node, first = group["node"], int((group["side"] == 0).sum()) if b1 != b2 else 0
            if len(node) > 1 and (b1 == b2 or 0 < first < len(node)):
                found = np.array(held_together(group["x"], least, first), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]])], ["u", "v"])

    dealt = blocks(dealt, key, BLOCK).select(*key, "b1", "b2", "side", "node", "embedding")
    return dealt.mapInArrow(compare, "u bigint, v bigint").where("u <> v")


def link_counts(members: DataFrame, least: float = 0.98) -> DataFrame:
    """node, others: how many vectors (n counts copies) each of members(root, node, n, embedding) is linked with in its component."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (*_, b1, b2), group in groups_of(batches, 3):
            node, first = group["node"], int((group["side"] == 0).sum()) if b1 != b2 else 0
            if len(node) > 1 and (b1 == b2 or 0 < first < len(node)):
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(counted(group["x"], group["n"], least, first))], ["node", "others"])

    dealt = blocks(members, ["root"], BLOCK).select("root", "b1", "b2", "side", "node", "n", "embedding")
    return dealt.mapInArrow(compare, "node bigint, others bigint").groupBy("node").agg(F.sum("others").alias("others"))


def near_vectors(vectors: DataFrame, least: float = 0.98, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors(vec_id, embedding, label)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & ~bad & ~zero, F.lit(False))
    rows = vectors.select("vec_id", "label", "embedding", good.alias("good"))
    nodes = rows.where("good").groupBy("label", "embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("rep"))
    nodes = stage(nodes.withColumn("node", F.xxhash64("label", "embedding")), "vectors")
    roots = stage(connected_components(links(nodes.select("node", "label", "embedding"), least, trees, leaf)), "vector-roots")
    others = link_counts(nodes.select("node", "n", "embedding").join(roots, "node").select("root", "node", "n", "embedding"), least)
    rooted = nodes.select("node", "n", "rep").join(others, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stage(rooted, "vector-links")
    least_id = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    info = rooted.join(least_id, "root").select(F.col("node").alias("_node"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("_links"), "component")
    keyed = rows.select("vec_id", F.when(F.col("good"), F.xxhash64("label", "embedding")).alias("node"))
    out = keyed.join(info, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
