"""The co-occurrence graph of skills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.sources.files import stored


def pair_counts(df: DataFrame, skills: str, weight: str | None = None) -> DataFrame:
    """(a, b, n) with a < b: rows that hold both, or the sum of their ``weight``. Pairs are made inside a row's own list,
    so only the counts shuffle."""
    s = F.array_sort(F.array_distinct(skills))
    pairs = F.flatten(F.transform(s, lambda x: F.transform(F.filter(s, lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    n = F.sum("_w") if weight else F.count("*")
    return df.select((F.col(weight) if weight else F.lit(1)).alias("_w"), F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(n.alias("n"))


def measures(df: DataFrame, skills: str, weight: str | None = None) -> DataFrame:
    """(a, b, n, jaccard, lift, ppmi) of each pair of skills; a row counts once, or by its ``weight``."""
    from fathom.operators.sets import skill_counts

    total = df.agg((F.sum(weight) if weight else F.count("*")).alias("_t"))
    support = skill_counts(df, skills, weight=weight)
    p = pair_counts(df, skills, weight).join(support.toDF("a", "na"), "a").join(support.toDF("b", "nb"), "b").crossJoin(F.broadcast(total))
    lift = F.col("n") * F.col("_t") / (F.col("na") * F.col("nb"))
    return p.select("a", "b", "n", (F.col("n") / (F.col("na") + F.col("nb") - F.col("n"))).alias("jaccard"), lift.alias("lift"), F.greatest(F.lit(0.0), F.log2(lift)).alias("ppmi"))


def strongest(edges: DataFrame, weight: str, k: int) -> DataFrame:
    """Edges that are among the k strongest of one of their ends at least."""
    both = edges.select(F.col("a").alias("u"), "a", "b", weight).union(edges.select(F.col("b").alias("u"), "a", "b", weight))
    w = Window.partitionBy("u").orderBy(F.desc(weight), "a", "b")
    return both.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= k).select("a", "b", weight).distinct()


def triangles(edges: DataFrame) -> DataFrame:
    """(x, y, z) in order, each edge there. Wedges start at the end of smaller degree, so a hub makes few."""
    degree = edges.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count("*").alias("d"))
    e = edges.select("a", "b").join(degree.toDF("a", "da"), "a").join(degree.toDF("b", "db"), "b")
    first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    out = e.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("v"))
    wedge = out.join(out.toDF("u", "w"), "u").filter("v < w")
    closed = wedge.join(edges.select(F.col("a").alias("v"), F.col("b").alias("w")), ["v", "w"])
    t = F.array_sort(F.array("u", "v", "w"))
    return closed.select(t[0].alias("x"), t[1].alias("y"), t[2].alias("z"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every end of an edge.

    Every node keeps pointers to smaller nodes of its component. A round hands the smallest of a node's pointers to all
    its neighbours, then leaves each node one pointer to the smallest it knows and ties the others to that; chains
    shorten by squaring, so rounds grow with the logarithm of the depth. Rounds end when every node points to a root and
    roots point nowhere; each round is stored in the shared folder."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    down = lambda x, y: (F.greatest(x, y).alias("node"), F.least(x, y).alias("to"))
    now = stored(edges.filter("a <> b").select(*down("a", "b")).distinct())
    while True:
        several = now.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        hanging = now.join(now.select(F.col("node").alias("to")).distinct(), "to", "left_semi")
        if several.isEmpty() and hanging.isEmpty():
            break
        both = now.union(now.select("to", "node"))
        least = both.groupBy("node").agg(F.min("to").alias("least")).select("node", F.least("node", "least").alias("least"))
        wide = stored(both.join(least, "node").filter("to > node").select(F.col("to").alias("node"), F.col("least").alias("to")).filter("node <> to").distinct())
        lowest = wide.groupBy("node").agg(F.min("to").alias("least"))
        tied = wide.join(lowest, "node")
        now = stored(tied.select("node", F.col("least").alias("to")).union(tied.filter("to <> least").select("to", "least")).distinct())
    return ends.join(now, "node", "left").select("node", F.coalesce("to", "node").alias("root"))


def graph_stats(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes, edges, mean degree and the share of nodes in the largest component."""
    n = roots.agg(F.count("*").alias("nodes"))
    big = roots.groupBy("root").count().agg(F.max("count").alias("largest"))
    m = edges.agg(F.count("*").alias("edges"))
    return n.crossJoin(m).crossJoin(big).select("nodes", "edges", (2 * F.col("edges") / F.col("nodes")).alias("avg_degree"), (F.col("largest") / F.col("nodes")).alias("largest_share"))


def bundles(triples: DataFrame, edges: DataFrame, weight: str, least: float) -> DataFrame:
    """(x, y, z, score): triangles whose mean edge weight reaches the bound."""
    e = edges.select("a", "b", F.col(weight).alias("_w"))
    out = triples
    for k, (p, q) in enumerate((("x", "y"), ("x", "z"), ("y", "z"))):
        out = out.join(e.toDF(p, q, f"_w{k}"), [p, q])
    return out.withColumn("score", (F.col("_w0") + F.col("_w1") + F.col("_w2")) / 3).filter(F.col("score") >= least).select("x", "y", "z", "score")


def greedy_cover(sets: DataFrame, key: str, weight: str, skills: str, candidates: DataFrame, most: int, demand: str | None = None) -> DataFrame:
    """(step, cluster, gain): candidates in the order in which each covers the largest weight not covered before; the
    lowest number of equals. Pairs that reach the Jaccard threshold are made once; the loop drops covered sets. Steps left
    when nothing more is covered go to the other candidates by their raw ``demand`` column, if named, with a gain of 0."""
    from fathom.operators.sets import jaccard_candidates, threshold_reached

    spark = sets.sparkSession
    pairs = jaccard_candidates(sets, key, skills, candidates).filter(threshold_reached(F.col("inter"), F.col("union"))).select(key, "cluster").join(sets.select(key, weight), key).cache()
    chosen: list[tuple[int, int, float]] = []
    left = pairs
    for step in range(1, most + 1):
        best = left.groupBy("cluster").agg(F.sum(weight).alias("gain")).orderBy(F.desc("gain"), "cluster").first()
        if best is None or not best["gain"]:
            break
        chosen.append((step, best["cluster"], float(best["gain"])))
        taken = [c for _, c, _ in chosen]
        covered = pairs.filter(F.col("cluster").isin(taken)).select(key).distinct()
        left = pairs.join(covered, key, "left_anti")
    pairs.unpersist()
    if demand and len(chosen) < most:
        others = candidates.filter(~F.col("cluster").isin([c for _, c, _ in chosen])) if chosen else candidates
        rest = others.orderBy(F.desc(demand), "cluster").select("cluster").limit(most - len(chosen)).collect()
        chosen += [(k, r["cluster"], 0.0) for k, r in enumerate(rest, len(chosen) + 1)]
    return spark.createDataFrame(chosen, "step int, cluster int, gain double")
