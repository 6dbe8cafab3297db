"""Queries of cluster building by market. A market is the region of an order's customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.operators import market_clusters as mc
from fathom.plans.adapt import load, query
from fathom.plans.q_sets import _CELLS, order_skills
from fathom.sources.files import stored

_SETS = _CELLS + """, om AS (SELECT o_orderkey AS order_id, r_name AS market FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ms AS (SELECT market, skills, count(*) AS n FROM s JOIN om USING (order_id) GROUP BY ALL), fl AS (SELECT market, n, unnest(skills) AS skill FROM ms),
wa AS (SELECT * FROM (SELECT market, skill, sum(n)::BIGINT AS demand, row_number() OVER (PARTITION BY market ORDER BY sum(n) DESC, skill) AS k FROM fl GROUP BY market, skill) q WHERE k <= 8),
cl AS (SELECT * FROM (SELECT market, row_number() OVER (PARTITION BY market ORDER BY n DESC, array_to_string(skills, ', '))::INTEGER AS cluster, skills AS members, n AS demand FROM ms WHERE len(skills) BETWEEN 2 AND 4) q WHERE cluster <= 6)"""


def market_sets(spark: SparkSession, d: str) -> DataFrame:
    """(market, itemset, skills, n)."""
    order, customer = load(spark, d, "orders").select("o_orderkey", "o_custkey"), load(spark, d, "customer").select("c_custkey", "c_nationkey")
    place = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("market"))
    of = order.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("o_orderkey").alias("order_id"), "market")
    return order_skills(spark, d).join(of, "order_id").groupBy("market", "skills").agg(F.count("*").alias("n")).select("market", F.array_join("skills", ", ").alias("itemset"), "skills", "n")


def wanted_skills(sets: DataFrame, most: int = 8) -> DataFrame:
    """(market, skill, demand): the commonest skills of each market."""
    n = sets.select("market", "n", F.explode("skills").alias("skill")).groupBy("market", "skill").agg(F.sum("n").alias("demand"))
    w = Window.partitionBy("market").orderBy(F.desc("demand"), "skill")
    return n.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= most).drop("_k")


def frequent_sets(sets: DataFrame, most: int) -> DataFrame:
    """(market, cluster, members, demand): the commonest sets of two to four skills of each market, numbered from 1."""
    w = Window.partitionBy("market").orderBy(F.desc("n"), "itemset")
    few = sets.filter(F.size("skills").between(2, 4)).withColumn("cluster", F.row_number().over(w)).filter(F.col("cluster") <= most)
    return few.select("market", "cluster", F.col("skills").alias("members"), F.col("n").alias("demand"))


@query("market_missing_skills", _SETS + " SELECT market, skill, demand FROM wa WHERE NOT EXISTS (SELECT 1 FROM cl WHERE cl.market = wa.market AND list_contains(cl.members, wa.skill))")
def market_missing_skills(spark: SparkSession, d: str) -> DataFrame:
    s = stored(market_sets(spark, d))
    return mc.missing(frequent_sets(s, 6), wanted_skills(s))


_REACH = """, pr AS (SELECT ms.market, ms.skills, ms.n, cluster, len(members) AS size, len(list_intersect(skills, members)) AS i, len(list_distinct(list_concat(skills, members))) AS u FROM ms JOIN cl USING (market)),
rk AS (SELECT *, row_number() OVER (PARTITION BY market, skills ORDER BY i::DECIMAL(18,0) / u DESC, size, cluster) AS k FROM pr WHERE i > 0 AND CASE WHEN u >= 7 THEN i * 10 >= u * 3 ELSE i * 10 >= u * 4 END)"""


@query("market_cluster_demand", _SETS + _REACH + " SELECT market, cluster, array_to_string(cl.members, ', ') AS members, coalesce(d, 0)::BIGINT AS demand FROM cl LEFT JOIN (SELECT market, cluster, sum(n) AS d FROM rk WHERE k = 1 GROUP BY ALL) x USING (market, cluster)")
def market_cluster_demand(spark: SparkSession, d: str) -> DataFrame:
    s = stored(market_sets(spark, d))
    clusters = frequent_sets(s, 6).select("market", "cluster", "members")
    return mc.demands(clusters, mc.assigned(mc.by_skill(s), clusters)).withColumn("members", F.array_join("members", ", "))


@query(
    "replacement_deltas",
    _SETS + _REACH + """, own AS (SELECT market, cluster, sum(n) AS d FROM rk WHERE k = 1 GROUP BY ALL), tr AS (SELECT market, cluster, out, list_filter(members, lambda x: x <> out) AS members FROM (SELECT market, cluster, members, unnest(members) AS out FROM cl) q),
    po AS (SELECT DISTINCT market, cluster, out, members, skill FROM (SELECT tr.*, unnest(ms.skills) AS skill FROM tr JOIN ms ON ms.market = tr.market AND list_has_all(ms.skills, tr.members)) q WHERE NOT list_contains(members, skill)),
    ev AS (SELECT po.*, ms.skills, ms.n, len(po.members) + 1 AS size, len(list_intersect(ms.skills, list_append(po.members, skill))) AS i, len(list_distinct(list_concat(ms.skills, list_append(po.members, skill)))) AS u FROM po JOIN ms ON ms.market = po.market),
    wn AS (SELECT ev.*, r.i::DECIMAL(18,0) / r.u AS theirs, r.size AS their_size, r.cluster AS their_cluster FROM ev LEFT JOIN rk r1 ON r1.market = ev.market AND r1.skills = ev.skills AND r1.k = 1 LEFT JOIN rk r ON r.market = ev.market AND r.skills = ev.skills AND r.k = CASE WHEN r1.cluster = ev.cluster THEN 2 ELSE 1 END WHERE ev.i > 0 AND CASE WHEN ev.u >= 7 THEN ev.i * 10 >= ev.u * 3 ELSE ev.i * 10 >= ev.u * 4 END),
    su AS (SELECT market, cluster, out, skill, sum(n) AS demand, sum(CASE WHEN list_contains(skills, skill) THEN n ELSE 0 END) AS occurrence FROM wn WHERE theirs IS NULL OR i::DECIMAL(18,0) / u > theirs OR (i::DECIMAL(18,0) / u = theirs AND (size < their_size OR (size = their_size AND cluster < their_cluster))) GROUP BY ALL)
    SELECT po.market, po.cluster, po.out AS removed, po.skill AS added, coalesce(su.demand, 0)::BIGINT AS demand, coalesce(su.occurrence, 0)::BIGINT AS occurrence, (coalesce(su.demand, 0) - coalesce(own.d, 0))::BIGINT AS delta
    FROM po LEFT JOIN su ON su.market = po.market AND su.cluster = po.cluster AND su.out = po.out AND su.skill = po.skill LEFT JOIN own ON own.market = po.market AND own.cluster = po.cluster WHERE po.skill <> po.out""",
)
def replacement_deltas(spark: SparkSession, d: str) -> DataFrame:
    """For every cluster, member out and skill in: what the cluster would get, and by how much that differs from now."""
    s = stored(market_sets(spark, d))
    flat, clusters = mc.by_skill(s), stored(frequent_sets(s, 6).select("market", "cluster", "members"))
    each = clusters.select("market", "cluster", "members", F.posexplode("members").alias("at", "removed"))
    trials = each.select("market", (F.col("cluster") * 100 + F.col("at")).alias("trial"), "cluster", F.array_remove("members", F.col("removed")).alias("members"), "removed")
    now = mc.demands(clusters, mc.assigned(flat, clusters)).select("market", "cluster", F.col("demand").alias("_now"))
    told = mc.replacements(flat, clusters, trials.drop("removed")).join(trials.select("market", "trial", "cluster", "removed"), ["market", "trial"]).filter("skill <> removed").join(now, ["market", "cluster"])
    return told.select("market", "cluster", "removed", F.col("skill").alias("added"), "demand", "occurrence", (F.col("demand") - F.col("_now")).alias("delta"))


@query("market_cluster_build")
def market_cluster_build(spark: SparkSession, d: str) -> DataFrame:
    """The clusters of every market after all steps; one market is only trimmed."""
    s = stored(market_sets(spark, d))
    out = mc.build(s, stored(frequent_sets(s, 30)), stored(wanted_skills(s)), 6, 2, 4, 5, only_trimmed=["EUROPE"])
    return out.withColumn("members", F.array_join("members", ", "))
