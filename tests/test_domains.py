"""Graphs given as nodes and their domains, where the pairs of a domain are never made."""

import random

import pytest


from loomspark.operators import diversity as D
from loomspark.operators import graph as G
from loomspark.operators import patterns as M
from loomspark.plans import catalog, detail, more  # noqa: F401  detail and more add their queries
from tests.oracle import compare

STEPS = "chain long, step int, node long, tool long, endpoint long, method string, domain int, params array<string>, outputs array<string>"


def graph(spark, seed=3):
    """Domains of 1 to 12 nodes, one node in two domains, one in none, one that no step has; and chains with unknown and repeated nodes."""
    rng = random.Random(seed)
    rows = [(d * 100 + i, d, rng.choice(["high", "medium", "low", "odd"])) for d, n in enumerate((1, 2, 3, 4, 12)) for i in range(n)]
    nodes = spark.createDataFrame([*rows, (101, 3, "low"), (900, None, "high")], "node long, domain int, tier string")
    pool = [r[0] for r in rows] + [900, 901, None]
    steps = [(c, 2 * i, x, x and x % 7, x, "GET", rng.choice([None, 1, 2]), *rng.choice([(None, None), (["a"], ["a"]), ([], ["b"])])) for c in range(80) for i, x in enumerate(rng.choices(pool, k=rng.randint(1, 6)))]
    return nodes, G.same_domain_edges(nodes), spark.createDataFrame(steps, STEPS)


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def query_without_pairs(spark, sf, monkeypatch, name):
    def pairs(*_):
        raise AssertionError("all pairs of a domain")

    monkeypatch.setattr(G, "same_domain_edges", pairs)
    assert compare(spark, sf, catalog.QUERIES[name], catalog.ORACLES[name])


def test_branched(spark):
    nodes, edges, steps = graph(spark)
    same(G.two_least(nodes), G.two_least(edges))
    same(M.branched(steps, nodes), M.branched(steps, edges))


def test_enforce_branch(spark, sf, monkeypatch):
    query_without_pairs(spark, sf, monkeypatch, "enforce_branch")


def test_parallel(spark):
    nodes, edges, steps = graph(spark)
    same(M.parallel(steps, nodes), M.parallel(steps, edges))


def test_enforce_parallel(spark, sf, monkeypatch):
    query_without_pairs(spark, sf, monkeypatch, "enforce_parallel")


def test_parallel_runs(spark, sf, monkeypatch):
    query_without_pairs(spark, sf, monkeypatch, "parallel_runs")


@pytest.mark.parametrize("most", [0, 1, 3, 4, 5, 50])
def test_pruned_by_degree(spark, most):
    nodes = graph(spark)[0].where("node <> 101 OR domain = 1")  # each node once
    protected = nodes.where("domain <> 2 OR node % 2 = 0").selectExpr("-domain - 1L AS src", "node AS dst", "'same_tool' AS edge_type", "1D AS weight")
    protected = protected.unionByName(protected.where("dst % 3 = 0").selectExpr("src - 100 AS src", "dst", "edge_type", "weight"))
    both = protected.unionByName(G.same_domain_edges(nodes).selectExpr("src", "dst", "'same_domain' AS edge_type", "weight"))
    same(G.same_domain_pruned_by_degree(nodes, protected, most), G.prune_by_degree(both, most))


def test_edge_prune_degree(spark, sf, monkeypatch):
    query_without_pairs(spark, sf, monkeypatch, "edge_prune_degree")


def test_chain_patterns(spark):
    nodes, edges, steps = graph(spark)
    same(G.chain_patterns(steps, nodes), G.chain_patterns(steps, edges))


def test_pattern_classes(spark, sf, monkeypatch):
    query_without_pairs(spark, sf, monkeypatch, "pattern_classes")


def test_full_reward(spark):
    nodes, edges, steps = graph(spark)
    same(D.full_reward(steps, nodes, 2, 5, 2, [4], [3]), D.full_reward(steps, edges, 2, 5, 2, [4], [3]))


def test_chain_reward_full(spark, sf, monkeypatch):
    query_without_pairs(spark, sf, monkeypatch, "chain_reward_full")


def test_lines_of_a_task(spark, sf):
    """Steps are dealt by chain with a bound on the lines of a task, whatever spark.sql.shuffle.partitions is (4 here)."""
    assert catalog.spread(spark.range(10), "id", rows=50_000_000).rdd.getNumPartitions() == 100
    few = 4 * spark.sparkContext.defaultParallelism
    assert catalog.steps(spark, sf).rdd.getNumPartitions() == few > 4


def test_semantic_edges_in_strips(spark):
    """A task gives its links strip by strip; each vector is sent once a block, and blocks are large."""
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)] if i % 50 else [0.0] * 6) for i in range(700)]
    v = spark.createDataFrame(rows, "node long, embedding array<double>")
    cos = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) / ((sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5 or 1)
    want = {(i, j) for i, a in rows for j, b in rows if i < j and cos(a, b) >= 0.6}
    assert G.STRIP < 350
    for block in (None, 100, 350):
        assert sorted((r.src, r.dst) for r in G.semantic_edges(v, 0.6, block).collect()) == sorted(want)
