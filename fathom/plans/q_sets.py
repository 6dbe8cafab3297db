"""Queries of the skill-set operators. An order's skills are the words of its parts' names; its cell is their list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions import tokens as tok
from fathom.operators import sets
from fathom.operators.aggregate import running
from fathom.plans.adapt import load, query

_CELLS = """WITH w AS (SELECT DISTINCT l_orderkey AS order_id, unnest(string_split(p_name, ' ')) AS skill FROM lineitem JOIN part ON l_partkey = p_partkey), s AS (SELECT order_id, list_sort(list(skill)) AS skills FROM w GROUP BY ALL),
y AS (SELECT o_orderkey AS order_id, year(o_orderdate) AS year FROM orders)"""


_PRIMARY = ["anvil", "bolt", "gear", "rod", "small", "new"]


def order_skills(spark: SparkSession, d: str) -> DataFrame:
    """(order_id, skills in order). An order gathers its parts' names; they become words where they have met, so rows are
    not multiplied before the shuffle. Parts without a name give none."""
    line, part = load(spark, d, "lineitem").select("l_orderkey", "l_partkey"), load(spark, d, "part").select("p_partkey", "p_name").filter("p_name IS NOT NULL")
    names = line.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("order_id")).agg(F.collect_set("p_name").alias("_names"))
    words = F.flatten(F.transform("_names", lambda x: F.split(x, " ")))
    return names.select("order_id", F.array_sort(F.array_distinct(words)).alias("skills"))


def order_sets(spark: SparkSession, d: str) -> DataFrame:
    """(itemset, skills, n): the distinct skill sets and their numbers of orders."""
    return order_skills(spark, d).groupBy("skills").agg(F.count("*").alias("n")).select(F.array_join("skills", ", ").alias("itemset"), "skills", "n")


def _years(spark: SparkSession, d: str) -> DataFrame:
    return order_skills(spark, d).join(load(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.year("o_orderdate").alias("year")), "order_id")


@query("skill_counts", _CELLS + " SELECT skill, count(*) AS n FROM w GROUP BY skill")
def skill_counts(spark: SparkSession, d: str) -> DataFrame:
    return sets.skill_counts(order_skills(spark, d), "skills")


@query("yearly_skill_counts", _CELLS + " SELECT year, skill, count(*) AS n FROM w JOIN y USING (order_id) GROUP BY ALL")
def yearly_skill_counts(spark: SparkSession, d: str) -> DataFrame:
    return sets.skill_counts(_years(spark, d), "skills", ["year"])


@query("itemset_counts", _CELLS + " SELECT array_to_string(skills, ', ') AS itemset, count(*) AS n, max(len(skills))::INTEGER AS skill_count FROM s GROUP BY 1")
def itemset_counts(spark: SparkSession, d: str) -> DataFrame:
    return sets.itemsets(order_skills(spark, d), "skills")


@query("singletons", _CELLS + ", p AS (SELECT list_intersect(skills, ['anvil', 'bolt', 'gear', 'rod', 'small', 'new']) AS skills FROM s) SELECT skills[1] AS skill, count(*) AS n FROM p WHERE len(skills) = 1 GROUP BY 1")
def singletons(spark: SparkSession, d: str) -> DataFrame:
    few = order_skills(spark, d).withColumn("skills", F.array_intersect("skills", F.array(*[F.lit(p) for p in _PRIMARY])))
    return few.filter(F.size("skills") == 1).groupBy(F.col("skills")[0].alias("skill")).agg(F.count("*").alias("n"))


@query(
    "skill_tokens",
    """WITH c AS (SELECT p_partkey, string_split(p_name, ' ') AS p FROM part) SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([p[1], p[2], coalesce(p[3], ''), 'Cloud', 'HTML', 'CSS', 'JavaScript'], lambda x: x <> ''))), '|') AS tokens FROM c""",
)
def skill_tokens(spark: SparkSession, d: str) -> DataFrame:
    p = F.split("p_name", " ")
    at = lambda k: F.coalesce(F.get(p, F.lit(k)), F.lit(""))
    cell = F.concat(at(0), F.lit(" ("), at(1), F.lit(", ("), at(2), F.lit("); Cloud): html css  javascript"))
    names = F.transform(tok.tokens(cell), lambda x: x)
    return load(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(names), "|").alias("tokens"))


@query(
    "normalised_skills",
    """WITH t AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS t FROM part), n AS (SELECT p_partkey, CASE WHEN lower(t) LIKE 'r%' THEN 'Round' WHEN lower(t) IN ('cold', 'blue') THEN 'Blue' ELSE t END AS n FROM t)
    SELECT p_partkey, array_to_string(list_sort(list_distinct(list(n) FILTER (lower(n) <> 'new'))), '|') AS skills FROM n GROUP BY p_partkey HAVING count(*) FILTER (lower(n) <> 'new') > 0 UNION ALL SELECT p_partkey, '' FROM n GROUP BY p_partkey HAVING count(*) FILTER (lower(n) <> 'new') = 0""",
)
def normalised_skills(spark: SparkSession, d: str) -> DataFrame:
    dictionary = spark.createDataFrame([("Cold ", "Blue"), ("BLUE", "Blue")], "variant string, canonical string")
    cells = load(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("skills"))
    out = sets.normalised(cells, "p_partkey", "skills", dictionary, eliminate=["New"], prefix=("r", "Round"))
    return out.withColumn("skills", F.array_join("skills", "|"))


def _clusters(spark: SparkSession, d: str, n: int = 15, counted: DataFrame | None = None) -> DataFrame:
    """The most frequent itemsets of two to four skills as clusters, numbered from 1; ``counted`` are stored ``order_sets``."""
    counts = order_sets(spark, d) if counted is None else counted
    top = counts.filter(F.size("skills").between(2, 4)).orderBy(F.desc("n"), "itemset").limit(n)
    numbered = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "itemset"))).alias("a")).select(F.posexplode("a").alias("i", "x"))
    return numbered.select((F.col("i") + 1).alias("cluster"), F.split("x.itemset", ", ").alias("members"), (-F.col("x.k")).alias("demand"))


_CLUSTERS = _CELLS + """, i AS (SELECT skills, count(*) AS n FROM s WHERE len(skills) BETWEEN 2 AND 4 GROUP BY 1), c AS (SELECT (row_number() OVER (ORDER BY n DESC, array_to_string(skills, ', ')))::INTEGER AS cluster, skills AS members FROM i ORDER BY n DESC, array_to_string(skills, ', ') LIMIT 15),
p AS (SELECT order_id, cluster, len(members) AS size, len(list_intersect(skills, members)) AS i, len(list_distinct(list_concat(skills, members))) AS u FROM s CROSS JOIN c),
ok AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY i::DECIMAL(18,0) / u DESC, size, cluster) AS k FROM p WHERE i > 0 AND CASE WHEN u >= 7 THEN i * 10 >= u * 3 ELSE i * 10 >= u * 4 END),
a AS (SELECT s.order_id, ok.cluster FROM s LEFT JOIN ok ON ok.order_id = s.order_id AND k = 1)"""


@query("jaccard_assign", _CLUSTERS + " SELECT order_id, cluster FROM a")
def jaccard_assign(spark: SparkSession, d: str) -> DataFrame:
    return sets.assign(order_skills(spark, d), "order_id", "skills", _clusters(spark, d))


@query("cluster_occurrence", _CLUSTERS + ", f AS (SELECT cluster, unnest(skills) AS skill FROM a JOIN s USING (order_id) WHERE cluster IS NOT NULL), m AS (SELECT cluster, unnest(members) AS skill FROM c) SELECT cluster, skill, count(*) AS n FROM f JOIN m USING (cluster, skill) GROUP BY ALL")
def cluster_occurrence(spark: SparkSession, d: str) -> DataFrame:
    s, c = order_skills(spark, d), _clusters(spark, d)
    return sets.occurrence(s, "order_id", "skills", sets.assign(s, "order_id", "skills", c), c)


@query("cluster_labels", _CLUSTERS + ", f AS (SELECT cluster, unnest(skills) AS skill FROM a JOIN s USING (order_id) WHERE cluster IS NOT NULL), m AS (SELECT cluster, unnest(members) AS skill FROM c), o AS (SELECT cluster, skill, count(*) AS n FROM f JOIN m USING (cluster, skill) GROUP BY ALL) SELECT cluster, 'MSC-' || string_agg(skill, '-' ORDER BY n DESC, skill) AS label FROM o GROUP BY cluster")
def cluster_labels(spark: SparkSession, d: str) -> DataFrame:
    return sets.labels(cluster_occurrence(spark, d))




@query(
    "second_pass_assign",
    _CLUSTERS + f""", pr AS (SELECT {_PRIMARY!r} AS p), r AS (SELECT order_id, list_intersect(skills, p) AS skills FROM a JOIN s USING (order_id), pr WHERE cluster IS NULL), c2 AS (SELECT cluster, list_intersect(members, p) AS members FROM c, pr),
    p2 AS (SELECT order_id, cluster, len(members) AS size, len(list_intersect(skills, members)) AS i, len(list_distinct(list_concat(skills, members))) AS u FROM r CROSS JOIN c2 WHERE len(skills) > 0 AND len(members) > 0),
    ok2 AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY i::DECIMAL(18,0) / u DESC, size, cluster) AS k FROM p2 WHERE i > 0 AND CASE WHEN u >= 7 THEN i * 10 >= u * 3 ELSE i * 10 >= u * 4 END)
    SELECT a.order_id, coalesce(a.cluster, ok2.cluster) AS cluster, a.cluster IS NULL AND ok2.cluster IS NOT NULL AS second_pass FROM a LEFT JOIN ok2 ON ok2.order_id = a.order_id AND ok2.k = 1""",
)
def second_pass_assign(spark: SparkSession, d: str) -> DataFrame:
    s, c = order_skills(spark, d), _clusters(spark, d)
    return sets.second_pass(s, "order_id", "skills", sets.assign(s, "order_id", "skills", c), c, _PRIMARY)


_PRIORITY = ["valve", "bolt", "anvil"]


@query(
    "priority_assign",
    _CLUSTERS + f""", q AS (SELECT unnest({_PRIORITY!r}) AS skill, unnest(range({len(_PRIORITY)})) AS place), hold AS (SELECT cluster, place FROM c JOIN q ON list_contains(members, skill)),
    want AS (SELECT order_id, min(place) AS place FROM s JOIN q ON list_contains(skills, skill) WHERE place IN (SELECT place FROM hold) GROUP BY order_id),
    f AS (SELECT p.*, want.place AS w, hold.cluster IS NOT NULL AS has FROM p LEFT JOIN want USING (order_id) LEFT JOIN hold ON hold.cluster = p.cluster AND hold.place = want.place),
    z AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY i::DECIMAL(18,0) / u DESC, size, cluster) AS k FROM f WHERE i > 0 AND CASE WHEN w IS NOT NULL THEN has WHEN u >= 7 THEN i * 10 >= u * 3 ELSE i * 10 >= u * 4 END)
    SELECT s.order_id, z.cluster FROM s LEFT JOIN z ON z.order_id = s.order_id AND z.k = 1""",
)
def priority_assign(spark: SparkSession, d: str) -> DataFrame:
    return sets.assign(order_skills(spark, d), "order_id", "skills", _clusters(spark, d), _PRIORITY)


@query("unmapped_orders", _CLUSTERS + " SELECT order_id, array_to_string(skills, ', ') AS skills FROM a JOIN s USING (order_id) WHERE cluster IS NULL")
def unmapped_orders(spark: SparkSession, d: str) -> DataFrame:
    s, c = order_skills(spark, d), _clusters(spark, d)
    a = sets.assign(s, "order_id", "skills", c)
    labels = sets.labels(sets.occurrence(s, "order_id", "skills", a, c))
    return sets.split_mapped(s, "order_id", a, labels)[1].withColumn("skills", F.array_join("skills", ", "))


@query("contained_match", _CLUSTERS + ", z AS (SELECT order_id, cluster, i / size AS containment, row_number() OVER (PARTITION BY order_id ORDER BY i / size DESC, cluster) AS k FROM p JOIN s USING (order_id) WHERE i = len(skills)) SELECT order_id, cluster, round(containment, 6) AS containment FROM z WHERE k = 1")
def contained_match(spark: SparkSession, d: str) -> DataFrame:
    return sets.contained_match(order_skills(spark, d), "order_id", "skills", _clusters(spark, d)).withColumn("containment", F.round("containment", 6))


@query("coverage_summary", _CLUSTERS + " SELECT count(*) AS orders, count(cluster) AS mapped, round(count(cluster) / count(*), 6) AS coverage FROM a")
def coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    a = jaccard_assign(spark, d)
    return a.agg(F.count("*").alias("orders"), F.count("cluster").alias("mapped"), F.round(F.count("cluster") / F.count("*"), 6).alias("coverage"))


@query(
    "gated_skills",
    _CELLS + """, c AS (SELECT year, skill, count(*) AS n FROM w JOIN y USING (order_id) GROUP BY ALL), ny AS (SELECT count(DISTINCT year) AS y FROM c),
    g AS (SELECT skill, sum(n) AS total, max(n) AS best, coalesce(sum(n) FILTER (year = 2000), 0) AS last, sum(n * n) AS sq FROM c GROUP BY skill), r AS (SELECT *, row_number() OVER (ORDER BY total DESC, lower(skill), skill) AS k, sqrt(greatest(0, sq / y - (total / y) ** 2)) / (total / y) AS cv FROM g, ny)
    SELECT skill, total, round(cv, 6) AS cv FROM r WHERE (total >= 1000 OR (k <= 30 AND total >= 600)) AND best >= 100 AND last >= greatest(50, floor(total * 0.1)) AND cv < 0.9""",
)
def gated_skills(spark: SparkSession, d: str) -> DataFrame:
    out = sets.gated_skills(yearly_skill_counts(spark, d), 1000, 30, 600, 100, 50, 0.1, 0.9, 2000)
    return out.withColumn("cv", F.round("cv", 6))


@query("canonical_frequency", _CELLS + " SELECT skill, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, skill) AS rank FROM w GROUP BY skill")
def canonical_frequency(spark: SparkSession, d: str) -> DataFrame:
    ranked = running(skill_counts(spark, d).withColumn("one", F.lit(1)), "n", "one", descending=True, tie="skill")
    return ranked.select("skill", "n", F.col("upto").cast("long").alias("rank"))
