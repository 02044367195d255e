"""Chains in a pattern, values from pools, clarifying questions, repair by further attempts."""

import json

import pytest
from pyspark.sql import functions as F

from loomspark.functions import pools as V
from loomspark.operators import patterns as M
from loomspark.operators import sampler
from loomspark.plans import jobs
from tests.test_jobs import definition

STEPS = "chain long, step int, node long, domain string, params array<string>, outputs array<string>"


def made(spark, rows, edges, pattern, **more):
    steps = spark.createDataFrame([(c, i, n, d, p, o) for c, i, n, d, p, o in rows], STEPS)
    e = spark.createDataFrame(edges, "src long, dst long")
    return {r.chain: r.groups for r in M.as_pattern(steps, e, pattern, **more).collect()}


def test_patterns(spark):
    rows = [(1, 0, 10, "a", None, ["id"]), (1, 1, 11, "a", None, None), (1, 2, 12, "a", ["id"], None), (2, 5, 20, None, None, None), (2, 9, 21, None, None, None), (3, 0, 30, "z", None, None)]
    edges = [(10, 11), (20, 21), (21, 22), (22, 21), (30, 30)]
    assert made(spark, rows, edges, "sequential") == {1: [[10], [11], [12]], 2: [[20], [21]], 3: [[30]]}
    assert made(spark, rows, edges, "parallel") == {1: [[10, 11], [12]], 2: [[20, 21]], 3: [[30]]}
    # 11's neighbour 10 is not the next node: it joins node 12; chain 2 has none but the next, so a step takes a neighbour
    got = made(spark, rows, edges, "branch_and_merge")
    assert got[1] == [[10], [11], [12, 10]] and got[2] in ([[20, 21], [21]], [[20], [21, 20]]) and got[3] == [[30]]
    again = made(spark, rows, edges, "iterative")
    assert len(again[1]) == 4 and all(len(g) == 1 for g in again[1]) and again[3] == [[30], [30]]
    assert made(spark, [], edges, "branch_and_merge") == made(spark, [], [], "parallel") == {}
    with pytest.raises(ValueError, match="unknown pattern"):
        made(spark, rows, edges, "circular")
    flat = M.sequences(spark.createDataFrame([(1, [[1, 2], [3]])], "chain long, groups array<array<long>>"))
    assert flat.head().groups == [[1], [2], [3]]


def test_pools(spark, tmp_path):
    pools = {"city": ["a", "b"], "none": [], "name": ["n"]}
    V.to_table(spark, pools).write.parquet(str(tmp_path / "p"))
    assert V.from_table(spark.read.parquet(str(tmp_path / "p"))) == pools
    df = spark.createDataFrame([("city", 1), ("First_NAME", 2), ("none", 3), ("odd", 4), (None, 5)], "kind string, k int")
    got = [r.v for r in df.select(V.draw(F.col("kind"), pools, {"name": "name", "none": "none"}, F.col("k")).alias("v")).collect()]
    assert got[0] in ("a", "b") and got[1:] == ["n", "none_001", "odd_001", None]
    ids = df.limit(1).select(V.entity_id(F.col("kind"), F.lit("c1")), V.entity_id(F.col("kind"), F.lit("c1")), V.entity_id(F.col("kind"), F.lit("c2"), prefix=F.lit("XY"))).head()
    assert ids[0] == ids[1] and ids[0].startswith("CIT-") and ids[2].startswith("XY-") and 1000 <= int(ids[2][3:]) <= 9998
    name = lambda d, e: df.limit(1).select(V.entity_name(F.lit(d), F.lit(e).cast("string"), {"Music": ["Song"]}, F.col("k"))).head()[0]
    assert name("Music", "x") == "Song" and name("Food_Shop", "get_all-items/now") == "Get All Items Result" and name("Food_Shop", None) == "Food Shop Service"


def test_clarify():
    steps = [{"endpoint": "e", "name": "find", "parameters": ["item_id"]}]
    asked = sampler.conversation(1, steps, 7, 1.0)
    assert [m["role"] for m in asked] == ["user", "assistant", "user", "assistant", "tool", "assistant"]
    assert "the item id" in asked[1]["content"] and asked[3]["arguments"]["item_id"] in asked[2]["content"]
    assert not any("?" in (m["content"] or "") for m in sampler.conversation(1, steps, 7, 0.0)[1:])


def test_repair(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(4):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(definition(i)))
    jobs.build(spark, str(tmp_path / "in"), str(tmp_path / "b"))
    tries = jobs.generate_attempts(spark, str(tmp_path / "b"), str(tmp_path / "c"), 6, retries=2)
    assert tries.count() == 18 and {r.attempt for r in jobs.repair(tries).collect()} == {1}
    cut = tries.withColumn("messages", F.when((F.col("attempt") < 2) | (F.col("conversation_id") == "chain_00000"), F.slice("messages", 1, 1)).otherwise(F.col("messages")))
    got = {r.conversation_id: (r.attempt, r.passed, r.reason) for r in jobs.repair(cut).collect()}
    assert got.pop("chain_00000") == (3, False, "max_retries_exceeded") and set(got.values()) == {(2, True, None)} and len(got) == 5
