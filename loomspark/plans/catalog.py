"""Named queries on the driver's tables, each with SQL that gives the same rows.

The tables stand for the catalogue: region - nation - supplier are domain - tool - endpoint, an order's line
items are a chain of tools, conversations are messages, events are tool calls, labels are scores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomspark.functions import text as X
from loomspark.operators import conversation as C
from loomspark.operators import diversity as D
from loomspark.operators import graph as G
from loomspark.operators import registry as R
from loomspark.operators import sampler as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, *by: str, rows: int = 0) -> DataFrame:
    """df dealt by the hash of columns, for work that is long or wide for its bytes: over four tasks a core, or as many as have half a million of `rows` each."""
    return df.repartition(max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // 500_000)), *by)


# ---- canonical relations

_TIER = "CASE WHEN s_acctbal >= 7000 THEN 'high' WHEN s_acctbal >= 4000 THEN 'medium' ELSE 'low' END"
_W = "CASE WHEN s_acctbal >= 7000 THEN 0.9 WHEN s_acctbal >= 4000 THEN 0.6 ELSE 0.3 END"
_EDGES = f"""
n AS (SELECT s_suppkey AS node, s_nationkey AS domain, {_W} AS w FROM supplier),
e AS (SELECT a.node AS src, b.node AS dst, (CAST(a.w AS DOUBLE) + CAST(b.w AS DOUBLE)) / 2 AS weight FROM n a JOIN n b ON a.domain = b.domain AND a.node < b.node)"""


def endpoints(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return table(spark, sf, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 and 5 rows at any scale


def nodes(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("domain"), F.expr(_TIER).alias("tier"))


def edges(spark, sf):
    return G.same_domain_edges(nodes(spark, sf))


def pruned(spark, sf, k):
    return G.same_domain_pruned(nodes(spark, sf), k)


def steps(spark, sf):
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = table(spark, sf, "lineitem")
    lines = spread(lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"), "l_orderkey", rows=lines.count())  # instead of the window's own exchange
    return lines.select(F.col("l_orderkey").alias("chain"), F.row_number().over(order).alias("step"), F.col("l_suppkey").alias("tool"))


_STEPS = "st AS (SELECT l_orderkey AS chain, l_suppkey AS tool, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS step FROM lineitem)"
_CHAINS = _STEPS + ", ch AS (SELECT chain, count(*) AS n_steps, count(DISTINCT tool) AS n_tools, substr(sha256(string_agg(DISTINCT CAST(tool AS VARCHAR), ',' ORDER BY CAST(tool AS VARCHAR))), 1, 16) AS pattern FROM st GROUP BY chain)"


def messages(spark, sf):
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("conv"), F.col("turn").alias("pos"), "role", "text")


# ---- filters, joins, sets


@query("SELECT s_suppkey, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey IN (1, 2) AND s_acctbal >= 1000")
def domain_filter(spark, sf):
    return endpoints(spark, sf).where("n_regionkey IN (1, 2) AND s_acctbal >= 1000").select("s_suppkey", "s_name")


@query("SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def endpoint_tool_join(spark, sf):
    return endpoints(spark, sf).select("s_suppkey", "s_name", "n_name", "r_name")


@query("SELECT n_name, count(*) FILTER (WHERE s_acctbal >= 4000) AS good, count(*) AS n_endpoints FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name HAVING count(*) BETWEEN 1 AND 100")
def load_filters(spark, sf):
    return endpoints(spark, sf).groupBy("n_name").agg(F.count_if(F.col("s_acctbal") >= 4000).alias("good"), F.count("*").alias("n_endpoints")).where("n_endpoints BETWEEN 1 AND 100")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def missing_endpoint_anti_join(spark, sf):
    return table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def dedup_first_wins(spark, sf):
    return table(spark, sf, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("text")


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def first_of_source(spark, sf):
    return R.first_wins(table(spark, sf, "documents"), ["source"], ["doc_id"]).select("doc_id", "source")


@query("SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def domain_intersect(spark, sf):
    return table(spark, sf, "supplier").select("s_nationkey").intersect(table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_nationkey"))


@query("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def unused_parts_except(spark, sf):
    return table(spark, sf, "part").select("p_partkey").exceptAll(table(spark, sf, "lineitem").where("l_quantity > 45").select("l_partkey").distinct())


@query("SELECT coalesce(a.k, b.k) AS key, a.v AS a, b.v AS b FROM (SELECT n_name AS k, n_regionkey AS v FROM nation) a FULL JOIN (SELECT CASE WHEN n_nationkey % 5 = 0 THEN n_name || '_new' ELSE n_name END AS k, n_regionkey + (n_nationkey % 2) AS v FROM nation) b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v")
def config_difference(spark, sf):
    n = table(spark, sf, "nation")
    a = n.select(F.col("n_name").alias("key"), F.col("n_regionkey").alias("value"))
    b = n.select(F.when(F.col("n_nationkey") % 5 == 0, F.concat("n_name", F.lit("_new"))).otherwise(F.col("n_name")).alias("key"), (F.col("n_regionkey") + F.col("n_nationkey") % 2).alias("value"))
    return R.config_diff(a, b)


@query("SELECT s_suppkey, s_nationkey FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY md5(CAST(s_suppkey AS VARCHAR) || ':42'), s_suppkey) AS r FROM supplier) WHERE r <= 2")
def stratified_sample(spark, sf):
    return R.stratified(table(spark, sf, "supplier"), "s_nationkey", "s_suppkey", 2).select("s_suppkey", "s_nationkey")


# ---- scoring and statistics

_FLAGS = """SELECT p_partkey, p_brand, round(0.20 * (CASE WHEN p_name <> '' THEN 1.0 ELSE 0.0 END) + 0.25 * (CASE WHEN length(p_name) >= 12 THEN 1.0 ELSE 0.0 END)
 + 0.30 * (CASE WHEN p_type IS NOT NULL THEN 1.0 ELSE 0.0 END) + 0.10 * (CASE WHEN p_size > 10 THEN 1.0 ELSE 0.0 END) + 0.15 * (CASE WHEN p_retailprice > 1200 THEN 1.0 ELSE 0.0 END), 4) AS score FROM part"""


def scored(spark, sf):
    f = R.flag
    score = R.weighted([(f(F.col("p_name") != ""), 0.20), (f(F.length("p_name") >= 12), 0.25), (f(F.col("p_type").isNotNull()), 0.30), (f(F.col("p_size") > 10), 0.10), (f(F.col("p_retailprice") > 1200), 0.15)])
    return table(spark, sf, "part").select("p_partkey", "p_brand", score.alias("score"))


@query(_FLAGS.replace("round(", "CAST(round(").replace(", 4) AS score", ", 4) AS DOUBLE) AS score"))
def parameter_score(spark, sf):
    return scored(spark, sf)


@query(f"WITH p AS ({_FLAGS}) SELECT p_brand, round(0.65 + 0.35 * avg(CAST(score AS DOUBLE)), 6) AS score, count(*) AS n FROM p GROUP BY p_brand")
def completeness_score(spark, sf):
    return scored(spark, sf).groupBy("p_brand").agg(F.round(0.65 + 0.35 * F.avg("score"), 6).alias("score"), F.count("*").alias("n"))


_TIERS = "CASE WHEN score >= 0.8 THEN 'excellent' WHEN score >= 0.6 THEN 'good' WHEN score >= 0.4 THEN 'fair' WHEN score >= 0.2 THEN 'poor' ELSE 'minimal' END"


@query(f"WITH p AS ({_FLAGS}), t AS (SELECT unnest(['excellent', 'good', 'fair', 'poor', 'minimal']) AS tier) SELECT tier, count(p_partkey) AS n FROM t LEFT JOIN p ON {_TIERS} = tier GROUP BY tier")
def quality_tier_distribution(spark, sf):
    return R.distribution(scored(spark, sf).select(X.tier(F.col("score")).alias("tier")), "tier", ["excellent", "good", "fair", "poor", "minimal"])


@query(f"WITH p AS ({_FLAGS}), b AS (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS bucket) SELECT bucket, count(p_partkey) AS n FROM b LEFT JOIN p ON least(CAST(floor(score * 10 + 0.000001) AS INTEGER), 9) = bucket GROUP BY bucket")
def score_histogram(spark, sf):
    bucket = F.least(F.floor(F.col("score") * 10 + 0.000001).cast("int"), F.lit(9))
    return R.distribution(scored(spark, sf).select(bucket.alias("bucket")), "bucket", list(range(10)))


@query("SELECT p_type, count(*) AS n FROM part WHERE p_size <= 10 GROUP BY p_type ORDER BY n DESC, p_type LIMIT 5")
def top_issues(spark, sf):
    return R.top(table(spark, sf, "part").where("p_size <= 10"), "p_type", 5)


@query("SELECT p_brand, p_type, count(*) AS n, avg(p_size) AS mean_size FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), ())")
def registry_stats(spark, sf):
    sets = [[F.col("p_brand")], [F.col("p_type")], []]
    return table(spark, sf, "part").groupingSets(sets, "p_brand", "p_type").agg(F.count("*").alias("n"), F.avg("p_size").alias("mean_size"))


@query("SELECT r_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def domain_counts(spark, sf):
    return endpoints(spark, sf).groupBy("r_name").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, list_filter([CASE WHEN p_size <= 10 THEN 'size' END, CASE WHEN p_retailprice <= 1200 THEN 'price' END, CASE WHEN length(p_name) < 12 THEN 'name' END], lambda x: x IS NOT NULL) AS missing FROM part")
def score_breakdown(spark, sf):
    missing = F.array_compact(F.array(F.when(F.col("p_size") <= 10, "size"), F.when(F.col("p_retailprice") <= 1200, "price"), F.when(F.length("p_name") < 12, "name")))
    return table(spark, sf, "part").select("p_partkey", missing.alias("missing"))


# ---- graph


@query(f"WITH {_EDGES} SELECT src, dst, weight FROM e")
def same_domain_edges(spark, sf):
    return edges(spark, sf)


@query("SELECT 'tool:' || n_nationkey AS src, 'ep:' || s_suppkey AS dst, 'same_tool' AS edge_type, CAST(1.0 AS DOUBLE) AS weight FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def same_tool_edges(spark, sf):
    return G.same_tool_edges(table(spark, sf, "nation").select(F.col("n_nationkey").alias("tool")), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("endpoint"), F.col("s_nationkey").alias("tool")))


_PRUNED = _EDGES + """,
x AS (SELECT src, dst, weight, src AS node FROM e UNION ALL SELECT src, dst, weight, dst FROM e),
y AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, src, dst) AS r FROM x),
p AS (SELECT src, dst, weight FROM y WHERE r <= 3 GROUP BY src, dst, weight HAVING count(*) = 2)"""


@query(f"WITH {_PRUNED} SELECT * FROM p")
def edge_prune_topk(spark, sf):
    return pruned(spark, sf, 3)


@query(f"WITH {_PRUNED}, b AS (SELECT src AS node, dst AS neighbour, weight FROM p UNION ALL SELECT dst, src, weight FROM p) SELECT node, neighbour, max(weight) AS weight FROM b GROUP BY ALL")
def chainable(spark, sf):
    return G.neighbours(pruned(spark, sf, 3))


@query(f"""WITH {_PRUNED}, b AS (SELECT src, dst FROM p UNION SELECT dst, src FROM p),
h1 AS (SELECT src AS origin, dst AS node FROM b),
h2 AS (SELECT DISTINCT h1.origin, b.dst AS node FROM h1 JOIN b ON h1.node = b.src WHERE b.dst <> h1.origin AND NOT EXISTS (SELECT 1 FROM h1 z WHERE z.origin = h1.origin AND z.node = b.dst))
SELECT origin, node, 1 AS hops FROM h1 UNION ALL SELECT origin, node, 2 FROM h2""")
def khop(spark, sf):
    return G.k_hop(pruned(spark, sf, 3), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("origin")), 2)


@query(f"""WITH {_PRUNED}, h1 AS (SELECT src AS origin, dst AS node FROM p UNION SELECT dst, src FROM p),
h2 AS (SELECT DISTINCT a.origin, b.node FROM h1 a JOIN h1 b ON a.node = b.origin WHERE b.node <> a.origin AND (a.origin, b.node) NOT IN (SELECT (origin, node) FROM h1))
SELECT origin, node, 1 AS hops FROM h1 UNION ALL SELECT origin, node, 2 FROM h2""")
def khop_all(spark, sf):
    return G.k_hop(pruned(spark, sf, 3), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("origin")), 2)


@query(f"WITH {_EDGES} SELECT (SELECT count(*) FROM n) AS n_nodes, count(*) AS n_edges, round(avg(weight), 9) AS mean_weight, round(CAST(count(*) AS DOUBLE) / ((SELECT count(*) FROM n) * ((SELECT count(*) FROM n) - 1)), 9) AS density FROM e")
def graph_stats(spark, sf):
    return G.same_domain_stats(nodes(spark, sf)).withColumns({"mean_weight": F.round("mean_weight", 9), "density": F.round("density", 9)})


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)
SELECT a.vec_id AS src, b.vec_id AS dst, round(list_cosine_similarity(a.e, b.e), 6) AS weight FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.3""")
def semantic_edges(spark, sf):
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("node"), "embedding")
    return G.semantic_edges(v, 0.3).withColumn("weight", F.round("weight", 6))


@query()
def node_importance(spark, sf):
    return G.page_rank(pruned(spark, sf, 3)).withColumn("rank", F.round("rank", 6))


# ---- sampling and generation: their own design, so no SQL


@query()
def sampled_chains(spark, sf):
    return S.sample_chains(spark, pruned(spark, sf, 5), nodes(spark, sf), 2 * nodes(spark, sf).count())


@query()
def generated_conversations(spark, sf):
    e = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.lower("s_name").alias("name"), F.when(F.col("s_acctbal") > 5000, F.array(F.lit("id"), F.lit("city"))).otherwise(F.array(F.lit("city"))).alias("parameters"))
    return S.generate(sampled_chains(spark, sf), e)


# ---- chains and diversity

_METRICS = _CHAINS + """,
u AS (SELECT DISTINCT chain, tool FROM st), c AS (SELECT tool, count(*) AS n FROM u GROUP BY tool),
e AS (SELECT count(*) AS distinct_tools, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS entropy FROM c),
pr AS (SELECT count(*) AS n_pairs FROM (SELECT DISTINCT a.tool AS x, b.tool AS y FROM u a JOIN u b ON a.chain = b.chain AND a.tool < b.tool)),
s AS (SELECT count(*) AS n_chains, count(DISTINCT pattern) AS n_patterns, avg(CASE WHEN n_steps >= 3 THEN 1.0 ELSE 0.0 END) AS multi_step_rate, avg(CASE WHEN n_tools >= 2 THEN 1.0 ELSE 0.0 END) AS multi_tool_rate FROM ch)"""


@query(f"""WITH {_METRICS} SELECT n_chains, distinct_tools, round(entropy, 6) AS entropy, n_patterns, round(1 - CAST(n_patterns AS DOUBLE) / n_chains, 6) AS repetition, n_pairs,
round(n_pairs / (distinct_tools * (distinct_tools - 1) / 2.0), 6) AS pair_ratio, round(multi_step_rate, 6) AS multi_step_rate, round(multi_tool_rate, 6) AS multi_tool_rate FROM e, s, pr""")
def diversity_metrics(spark, sf):
    m = D.metrics(steps(spark, sf))
    return m.withColumns({c: F.round(c, 6) for c in ("entropy", "repetition", "pair_ratio", "multi_step_rate", "multi_tool_rate")})


@query(f"WITH {_CHAINS} SELECT chain, n_steps, n_tools, pattern FROM ch")
def chain_patterns(spark, sf):
    return D.chains(steps(spark, sf)).select("chain", "n_steps", "n_tools", "pattern")


@query(f"WITH {_STEPS} SELECT chain, max(n) > 1 AS iterative FROM (SELECT chain, tool, count(*) AS n FROM st GROUP BY chain, tool) GROUP BY chain")
def iterative_detect(spark, sf):
    return D.repeated(steps(spark, sf))


@query(f"WITH {_CHAINS} SELECT chain, CAST(CASE WHEN n_steps BETWEEN 2 AND 5 THEN 1.0 ELSE -0.5 END + 0.5 * n_tools AS DOUBLE) AS reward FROM ch")
def chain_reward(spark, sf):
    return D.reward(D.chains(steps(spark, sf)), 2, 5)


@query(f"WITH {_CHAINS} SELECT chain, n_steps, n_tools FROM ch WHERE n_steps BETWEEN 2 AND 5 AND n_tools >= 2 AND chain NOT IN (SELECT chain FROM st WHERE tool IN (1, 2))")
def constraint_check(spark, sf):
    return D.satisfies(D.chains(steps(spark, sf)), 2, 5, 2, [1, 2]).select("chain", "n_steps", "n_tools")


@query(f"WITH {_CHAINS} SELECT chain, pattern FROM (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY chain) AS r FROM ch) WHERE r > 1")
def duplicate_patterns(spark, sf):
    return D.duplicates(D.chains(steps(spark, sf)))


@query(f"WITH {_STEPS} SELECT a.chain, a.step FROM st a JOIN st b ON a.chain = b.chain AND b.step = a.step + 1 AND a.tool % 25 = b.tool % 25")
def parallel_overlap(spark, sf):
    w = Window.partitionBy("chain").orderBy("step")
    return steps(spark, sf).withColumn("next", F.lead("tool").over(w)).where("tool % 25 = next % 25").select("chain", "step")


@query("WITH u AS (SELECT DISTINCT n_regionkey AS domain FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 9000) SELECT (SELECT count(*) FROM u) AS used_domains, count(*) AS known_domains, CAST((SELECT count(*) FROM u) AS DOUBLE) / count(*) AS coverage FROM region")
def domain_coverage(spark, sf):
    used = endpoints(spark, sf).where("s_acctbal > 9000").select(F.col("n_regionkey").alias("domain"))
    return D.coverage(used, table(spark, sf, "region").select(F.col("r_regionkey").alias("domain")))


@query("WITH c AS (SELECT s_suppkey AS tool, count(l_suppkey) AS uses FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey GROUP BY s_suppkey) SELECT tool, uses FROM c WHERE uses <= (SELECT median(uses) FROM c)")
def underrepresented(spark, sf):
    return D.underrepresented(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("tool")), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("tool")))


@query("SELECT l_suppkey AS tool, round(1.0 / (1 + count(*)), 9) AS weight FROM lineitem GROUP BY l_suppkey")
def steering_weights(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("tool")).agg(F.count("*").alias("n")).select("tool", F.round(D.steering_weight(F.col("n")), 9).alias("weight"))


def _run_sql(priority: str) -> str:
    return f"""SELECT count(DISTINCT l_orderkey) AS chains, count(DISTINCT l_suppkey) AS tools, avg(l_quantity) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '{priority}'"""


@query(f"""WITH a AS ({_run_sql("1-URGENT")}), b AS ({_run_sql("5-LOW")}), m AS (
SELECT 'chains' AS metric, CAST(a.chains AS DOUBLE) AS a, CAST(b.chains AS DOUBLE) AS b FROM a, b UNION ALL SELECT 'tools', a.tools, b.tools FROM a, b UNION ALL SELECT 'quantity', round(a.quantity, 6), round(b.quantity, 6) FROM a, b)
SELECT metric, a, b, round(b - a, 6) AS delta, CASE WHEN b - a > 1e-9 THEN 'up' WHEN b - a < -1e-9 THEN 'down' ELSE 'same' END AS direction FROM m""")
def run_comparison(spark, sf):
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    run = lambda p: joined.where(F.col("o_orderpriority") == p).agg(F.countDistinct("l_orderkey").alias("chains"), F.countDistinct("l_suppkey").alias("tools"), F.round(F.avg("l_quantity"), 6).alias("quantity"))
    return D.compare(run("1-URGENT"), run("5-LOW")).withColumn("delta", F.round("delta", 6))


# ---- conversations

_MSG = "m AS (SELECT conv_id AS conv, turn AS pos, role, text, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous_role FROM conversations)"


@query(f"""WITH {_MSG}, p AS (SELECT conv, arg_min(role, pos) AS f, arg_max(role, pos) AS l, count(*) FILTER (WHERE role = 'assistant') AS a, count(*) FILTER (WHERE role NOT IN ('user', 'assistant', 'tool')) AS u,
 count(*) FILTER (WHERE role = 'user' AND previous_role = 'user') AS r, count(*) FILTER (WHERE role = 'user' AND trim(coalesce(text, '')) = '') AS e FROM m GROUP BY conv),
 q AS (SELECT conv, list_filter([CASE WHEN f <> 'user' THEN 'first message is not from the user' END, CASE WHEN l <> 'assistant' THEN 'last message is not from the assistant' END, CASE WHEN a = 0 THEN 'no assistant message' END,
 CASE WHEN u > 0 THEN 'unknown role' END, CASE WHEN r > 0 THEN 'consecutive user messages' END, CASE WHEN e > 0 THEN 'empty user message' END], lambda x: x IS NOT NULL) AS errors FROM p)
SELECT conv, coalesce(array_to_string(errors, '; '), '') AS errors, len(errors) = 0 AS valid FROM q""")
def validate_structure(spark, sf):
    return C.errors(messages(spark, sf))


@query("SELECT conv_id AS conv, turn AS pos, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous_role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS user_before FROM conversations")
def asof_previous_user(spark, sf):
    return C.structure(messages(spark, sf))


@query("SELECT conv_id AS conv, count(*) AS n_turns, count(DISTINCT role) AS n_roles, CAST(sum(length(text)) AS BIGINT) AS n_chars, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM conversations GROUP BY conv_id")
def conversation_metadata(spark, sf):
    return C.metadata(messages(spark, sf))


@query("""WITH p AS (SELECT conv_id AS conv, count(*) AS n, arg_min(role, turn) AS f, arg_max(role, turn) AS l, count(*) FILTER (WHERE role = 'user') AS u, count(*) FILTER (WHERE role = 'assistant' AND contains(text, '?')) AS q FROM conversations GROUP BY conv_id)
SELECT conv, CAST(3 + (l = 'assistant')::INT + (n >= 3)::INT AS INTEGER) AS task_completion, CAST(2 + (f = 'user')::INT + (u > 1)::INT + (q > 0)::INT AS INTEGER) AS naturalness FROM p""")
def judge_offline(spark, sf):
    return C.judge(messages(spark, sf))


@query(f"WITH {_MSG} SELECT coalesce(previous_role, 'start') AS from_role, role AS to_role, count(*) AS n FROM m GROUP BY ALL")
def role_transitions(spark, sf):
    return C.transitions(messages(spark, sf))


@query("""WITH s AS (SELECT unnest(['quality', 'toxic']) AS dimension), v AS (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS score),
l AS (SELECT 'quality' AS dimension, quality * 4 + 1 AS score FROM labels UNION ALL SELECT 'toxic', toxic * 4 + 1 FROM labels)
SELECT s.dimension, v.score, count(l.score) AS n FROM s CROSS JOIN v LEFT JOIN l ON l.dimension = s.dimension AND l.score = v.score GROUP BY ALL""")
def score_distribution(spark, sf):
    return C.histogram(table(spark, sf, "labels").select((F.col("quality") * 4 + 1).alias("quality"), (F.col("toxic") * 4 + 1).alias("toxic")), ["quality", "toxic"])


@query("SELECT source, count(*) AS total, count(*) FILTER (WHERE quality = 1) AS passed, round(CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) / greatest(count(*), 1), 6) AS pass_rate FROM labels JOIN documents USING (doc_id) GROUP BY source")
def pass_rate(spark, sf):
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    out = j.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("quality") == 1).alias("passed"))
    return out.withColumn("pass_rate", F.round(F.col("passed") / F.greatest("total", F.lit(1)), 6))


@query("SELECT lang, CAST(round_even(avg(quality * 4 + 1), 0) AS INTEGER) AS quality, CAST(round_even(avg(toxic * 4 + 1), 0) AS INTEGER) AS toxic FROM labels JOIN documents USING (doc_id) GROUP BY lang")
def aggregate_scores(spark, sf):
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return j.groupBy("lang").agg(C.rounded_mean(F.col("quality") * 4 + 1).alias("quality"), C.rounded_mean(F.col("toxic") * 4 + 1).alias("toxic"))


@query("""WITH e AS (SELECT user_id AS key, ts AS "at", json_extract_string(props, '$.k') AS value, event_type FROM events)
SELECT key, "at", value FROM e c WHERE event_type = 'purchase' AND EXISTS (SELECT 1 FROM e o WHERE o.event_type <> 'purchase' AND o.key = c.key AND o.value = c.value AND o."at" < c."at")""")
def grounding_semijoin(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("key"), F.col("ts").alias("at"), F.get_json_object("props", "$.k").alias("value"), "event_type")
    return C.grounded(e.where("event_type = 'purchase'").drop("event_type"), e.where("event_type <> 'purchase'").drop("event_type"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 5")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k")).where("k >= 5")


@query("SELECT user_id, max(ts) AS last_at, arg_max(event_type, ts) AS last_type, arg_max(value, ts) AS last_value FROM events GROUP BY user_id")
def last_tool_output(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last_at"), F.max_by("event_type", "ts").alias("last_type"), F.max_by("value", "ts").alias("last_value"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def hourly_events(spark, sf):
    w = table(spark, sf, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n", "total")


# ---- scalars


@query(r"SELECT p_partkey, trim(regexp_replace(lower(regexp_replace(p_name, '[^A-Za-z0-9_]+', '_', 'g')), '', '')) AS slug, substr(trim(regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9_\s\-]', '', 'g'), '\s+', ' ', 'g')), 1, 200) AS name FROM part")
def name_normalize(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.slug(F.col("p_name")).alias("slug"), X.clean_name(F.col("p_name")).alias("name"))


@query("SELECT page_id, CASE WHEN regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) END AS path FROM pages")
def path_extract(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.path_of(F.col("url")).alias("path"))


@query("SELECT s_suppkey, s_name || '/GET/' || substr(sha256('GET:/v1/' || s_nationkey || '/_param_'), 1, 8) AS endpoint_id FROM supplier")
def endpoint_id_hash(spark, sf):
    path = F.concat(F.lit("/v1/"), F.col("s_nationkey").cast("string"), F.lit("/{id}"))
    return table(spark, sf, "supplier").select("s_suppkey", X.endpoint_id(F.col("s_name"), F.lit("GET"), path).alias("endpoint_id"))


_SPOKEN = r"""SELECT c_custkey, ['search', '/v1-list', 'lookup_', 'license_plate_lookup-', 'getFor2Hotels', 'SearchAll', 'research-'][c_custkey % 7 + 1] || replace(c_name, '#', '_') AS name FROM customer"""


@query(rf"""SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(lower(replace(replace(regexp_replace(name, '([a-z])([A-Z])', '\1 \2', 'g'), '_', ' '), '-', ' '))), '^/+', ''), '\bsearch\b', 'search for', 'g'), '\blookup\b', 'look up', 'g'), '\s+', ' ', 'g')) AS human FROM ({_SPOKEN})""")
def humanize(spark, sf):
    starts = F.array(*[F.lit(x) for x in ("search", "/v1-list", "lookup_", "license_plate_lookup-", "getFor2Hotels", "SearchAll", "research-")])
    name = F.concat(F.element_at(starts, (F.col("c_custkey") % 7 + 1).cast("int")), F.regexp_replace("c_name", "#", "_"))
    return table(spark, sf, "customer").select("c_custkey", X.humanize(name).alias("human"))


@query("SELECT p_partkey, length(trim(p_name)) >= 10 AND lower(trim(p_name)) <> lower(trim(p_brand)) AND regexp_replace(lower(trim(p_name)), '^(the|a|an|this)\\s+', '') <> lower(trim(p_brand)) AS meaningful FROM part")
def meaningful_description(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.meaningful(F.col("p_name"), F.col("p_brand")).alias("meaningful"))


@query(r"SELECT p_partkey, (length(t) < 4 AND t NOT IN ('get', 'set', 'add', 'run', 'put')) OR (length(t) > 25 AND NOT regexp_matches(t, '[ _-]')) OR t LIKE '/%' OR contains(t, '//') OR (length(t) > 4 AND length(regexp_replace(t, '[^aeiou]', '', 'g')) < length(t) * 0.15) OR regexp_matches(t, '602917ac|version 2|copy|\.\.\.') AS garbage FROM (SELECT p_partkey, lower(trim(p_name)) AS t FROM part)")
def garbage_name(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.garbage_name(F.col("p_name")).alias("garbage"))
