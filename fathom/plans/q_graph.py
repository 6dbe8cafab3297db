"""Queries of the graph and cover operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.operators import bundles, cluster, graph
from fathom.operators import sets as set_ops
from fathom.plans.adapt import query
from fathom.plans.q_sets import _CELLS, _clusters, order_sets
from fathom.sources.files import stored

_PAIRS = _CELLS + """, pr AS (SELECT x.skill AS a, y.skill AS b, count(*) AS n FROM w x JOIN w y ON x.order_id = y.order_id AND x.skill < y.skill GROUP BY ALL), su AS (SELECT skill, count(*) AS n FROM w GROUP BY ALL), t AS (SELECT count(DISTINCT order_id) AS t FROM w),
m AS (SELECT pr.a, pr.b, pr.n, pr.n / (x.n + y.n - pr.n) AS jaccard, pr.n * t / (x.n * y.n) AS lift FROM pr JOIN su x ON x.skill = a JOIN su y ON y.skill = b, t)"""


@query("pairs_lt", _PAIRS + " SELECT a, b, n FROM pr")
def pairs_lt(spark: SparkSession, d: str) -> DataFrame:
    return graph.pair_counts(order_sets(spark, d), "skills", "n")


@query("graph_metrics", _PAIRS + " SELECT a, b, n, round(jaccard, 6) AS jaccard, round(lift, 6) AS lift, round(greatest(0, log2(lift)), 6) AS ppmi FROM m")
def graph_metrics(spark: SparkSession, d: str) -> DataFrame:
    return graph.measures(stored(order_sets(spark, d)), "skills", "n").select("a", "b", "n", *[F.round(c, 6).alias(c) for c in ("jaccard", "lift", "ppmi")])


_EDGES = _PAIRS + """, o AS (SELECT a AS u, a, b, n FROM pr UNION ALL SELECT b, a, b, n FROM pr), e AS (SELECT DISTINCT a, b, n FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY n DESC, a, b) AS k FROM o) q WHERE k <= 9)"""


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.strongest(pairs_lt(spark, d), "n", 9)


@query("top_neighbours", _EDGES + " SELECT a, b, n FROM e")
def top_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


@query("triangles", _EDGES + " SELECT p.a AS x, p.b AS y, q.b AS z FROM e p JOIN e q ON p.b = q.a JOIN e r ON r.a = p.a AND r.b = q.b")
def triangles(spark: SparkSession, d: str) -> DataFrame:
    return graph.triangles(_edges(spark, d))


@query("micro_bundles", _EDGES + " SELECT p.a AS x, p.b AS y, q.b AS z, round((p.n + q.n + r.n) / 3, 6) AS score FROM e p JOIN e q ON p.b = q.a JOIN e r ON r.a = p.a AND r.b = q.b WHERE (p.n + q.n + r.n) / 3 >= 100")
def micro_bundles(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d)
    return graph.bundles(graph.triangles(e), e, "n", 100).withColumn("score", F.round("score", 6))


_REACH = _EDGES.replace("WITH w", "WITH RECURSIVE w", 1) + """, bi AS (SELECT a, b FROM e UNION SELECT b, a FROM e), rc AS (SELECT a, a AS b FROM bi UNION SELECT rc.a, bi.b FROM rc JOIN bi ON rc.b = bi.a), ro AS (SELECT a AS node, min(b) AS root FROM rc GROUP BY a)"""


@query("components", _REACH + " SELECT node, root FROM ro")
def components(spark: SparkSession, d: str) -> DataFrame:
    return graph.connected(_edges(spark, d))


@query("graph_stats", _REACH + ", z AS (SELECT root, count(*) AS c FROM ro GROUP BY root) SELECT (SELECT count(*) FROM ro) AS nodes, (SELECT count(*) FROM e) AS edges, round(2 * (SELECT count(*) FROM e) / (SELECT count(*) FROM ro), 6) AS avg_degree, round((SELECT max(c) FROM z) / (SELECT count(*) FROM ro), 6) AS largest_share")
def graph_stats(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d)
    return graph.graph_stats(e, graph.connected(e)).select("nodes", "edges", F.round("avg_degree", 6).alias("avg_degree"), F.round("largest_share", 6).alias("largest_share"))


_TIES = _PAIRS + """, hc AS (SELECT DISTINCT skill, CASE WHEN skill < 'm' THEN 1 ELSE 2 END AS cluster FROM w), ed AS (SELECT x.cluster, m.a, m.b, m.n, m.jaccard, m.n / sqrt(p.n * q.n) AS cos FROM m JOIN su p ON p.skill = m.a JOIN su q ON q.skill = m.b JOIN hc x ON x.skill = m.a JOIN hc y ON y.skill = m.b AND y.cluster = x.cluster),
tr AS (SELECT p.cluster, p.a AS x, p.b AS y, q.b AS z, (p.cos + q.cos + r.cos) / 3 AS coherence, p.jaccard + q.jaccard + r.jaccard AS support FROM ed p JOIN ed q ON p.b = q.a AND p.cluster = q.cluster JOIN ed r ON r.a = p.a AND r.b = q.b AND r.cluster = p.cluster)"""
_COHERENT = 0.43


def _halves(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The co-occurrence edges with the cosine of their ends' incidence over orders, inside two clusters by name; and
    (cluster, skill). ``counted`` are the orders' distinct sets with their numbers, so pairs are made once for each set."""
    support = set_ops.skill_counts(counted, "skills", weight="n")
    m = graph.measures(counted, "skills", "n").join(support.toDF("a", "_na"), "a").join(support.toDF("b", "_nb"), "b")
    edges = m.withColumn("cos", F.col("n") / F.sqrt(F.col("_na") * F.col("_nb"))).select("a", "b", "n", "jaccard", "cos")
    members = support.select(F.when(F.col("skill") < "m", 1).otherwise(2).alias("cluster"), "skill")
    return stored(bundles.inside(edges, members)), members


@query(
    "bundle_candidates",
    _TIES + f""", k4 AS (SELECT t.cluster, list_sort([x, y, z, u.b]) AS members, (t.coherence * 3 + u.cos + v.cos + o.cos) / 6 AS coherence, t.support + u.jaccard + v.jaccard + o.jaccard AS support, t.coherence AS own
    FROM tr t JOIN (SELECT cluster, a, b, cos, jaccard FROM ed UNION ALL SELECT cluster, b, a, cos, jaccard FROM ed) u ON u.cluster = t.cluster AND u.a = t.x JOIN (SELECT cluster, a, b, cos, jaccard FROM ed UNION ALL SELECT cluster, b, a, cos, jaccard FROM ed) v ON v.cluster = t.cluster AND v.a = t.y AND v.b = u.b
    JOIN (SELECT cluster, a, b, cos, jaccard FROM ed UNION ALL SELECT cluster, b, a, cos, jaccard FROM ed) o ON o.cluster = t.cluster AND o.a = t.z AND o.b = u.b),
    al AS (SELECT cluster, array_to_string([x, y, z], ', ') AS bundle, coherence, support FROM tr WHERE round(coherence, 9) >= {_COHERENT}
    UNION ALL SELECT cluster, array_to_string(members, ', '), max(coherence), max(support) FROM k4 WHERE round(own, 9) >= {_COHERENT} AND round(coherence, 9) >= {_COHERENT} GROUP BY ALL)
    SELECT cluster, bundle, round(coherence, 6) AS coherence, round(support, 6) AS support FROM al""",
)
def bundle_candidates(spark: SparkSession, d: str) -> DataFrame:
    found = bundles.candidates(_halves(stored(order_sets(spark, d)))[0], "jaccard", _COHERENT)
    return found.select("cluster", "bundle", F.round("coherence", 6).alias("coherence"), F.round("support", 6).alias("support"))


@query("bundle_selection")
def bundle_selection(spark: SparkSession, d: str) -> DataFrame:
    """The bundles of each cluster after containment, in the order in which they are chosen, with their names."""
    rows = stored(order_sets(spark, d))
    edges, members = _halves(rows)
    kept = stored(bundles.without_contained(stored(bundles.candidates(edges, "jaccard", _COHERENT))))
    chosen = bundles.selected(kept, members, rows, "n", "skills", target=12)
    return bundles.named(kept).join(chosen, ["cluster", "bundle"]).select("cluster", "bundle", "name", "step", "gain")


@query(
    "bundle_match",
    _TIES + f""", b AS (SELECT array_to_string([x, y, z], ', ') AS bundle, [x, y, z] AS members FROM tr WHERE round(coherence, 9) >= {_COHERENT}), nm AS (SELECT bundle, unnest(members) AS skill FROM b), bo AS (SELECT a, b, jaccard FROM m UNION ALL SELECT b, a, jaccard FROM m),
    pt AS (SELECT bundle, skill, sum(i) AS i, sum(j) AS j, sum(e) AS e FROM (SELECT bundle, skill, 1 AS i, 0.0::DOUBLE AS j, 0 AS e FROM nm UNION ALL SELECT bundle, bo.a, 0, jaccard, 1 FROM bo JOIN nm ON nm.skill = bo.b) t GROUP BY ALL),
    it AS (SELECT array_to_string(skills, ', ') AS itemset, any_value(skills) AS skills FROM s GROUP BY 1), fl AS (SELECT itemset, len(skills) AS n, unnest(skills) AS skill FROM it),
    sc AS (SELECT itemset, bundle, sum(i) / n AS containment, sum(j) / greatest(sum(e), 1) AS graph_score, sum(i) = n AS whole FROM fl JOIN pt USING (skill) GROUP BY itemset, bundle, n),
    rk AS (SELECT *, round(0.5 * containment + 0.5 * graph_score, 9) AS score, row_number() OVER (PARTITION BY itemset ORDER BY whole DESC, round(0.5 * containment + 0.5 * graph_score, 9) DESC, bundle) AS k FROM sc WHERE round(0.5 * containment + 0.5 * graph_score, 9) >= 0.25)
    SELECT itemset, bundle, round(containment, 6) AS containment, round(graph_score, 6) AS graph_score, round(score, 6) AS score, whole FROM rk WHERE k = 1""",
)
def bundle_match(spark: SparkSession, d: str) -> DataFrame:
    rows = stored(order_sets(spark, d))
    found = bundles.candidates(_halves(rows)[0], "jaccard", _COHERENT).filter(F.size("members") == 3)
    out = bundles.match(rows.select("itemset", "skills"), "itemset", "skills", stored(found), stored(graph.measures(rows, "skills", "n")), "jaccard")
    return out.withColumns({c: F.round(c, 6) for c in ("containment", "graph_score", "score")})


@query("greedy_cover")
def greedy_cover(spark: SparkSession, d: str) -> DataFrame:
    s = stored(order_sets(spark, d))
    return graph.greedy_cover(s, "itemset", "n", "skills", stored(_clusters(spark, d, 40, s)), 10, "demand")


@query("cluster_build")
def cluster_build(spark: SparkSession, d: str) -> DataFrame:
    s = stored(order_sets(spark, d))
    out = cluster.build(s, stored(_clusters(spark, d, 40, s)), 10, ["anvil", "blue", "bolt", "cold", "gear", "hot", "ring"], 50)
    return out.withColumn("members", F.array_join("members", ", "))
