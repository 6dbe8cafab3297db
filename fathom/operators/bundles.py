"""Micro-bundles: small coherent groups of skills inside a cluster, chosen by the demand they cover.

A bundle is a triangle of the skill graph, or a triangle and one more skill tied to all three. Frames carry (cluster,
bundle, members, coherence, support); ``bundle`` is the members' names in order, so it needs no numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.sources.files import stored


def with_cosine(edges: DataFrame, vectors: DataFrame, key: str = "node", vector: str = "vector") -> DataFrame:
    """``edges`` with ``cos``, that of its ends' vectors; null where an end has none or a zero one."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0).cast("double"), lambda s, x: s + x * x))
    unit = vectors.select(key, F.when(norm > 0, F.transform(vector, lambda x: x / norm)).alias("_u"))
    out = edges.join(unit.toDF("a", "_ua"), "a", "left").join(unit.toDF("b", "_ub"), "b", "left")
    dot = F.aggregate(F.zip_with("_ua", "_ub", lambda x, y: x * y), F.lit(0.0).cast("double"), lambda s, x: s + x)
    return out.select(*[edges[c] for c in edges.columns], dot.alias("cos"))


def inside(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Edges of each cluster's own graph, from (cluster, skill): both ends in it."""
    return edges.join(members.toDF("cluster", "a"), "a").join(members.toDF("cluster", "b"), ["cluster", "b"])


def candidates(edges: DataFrame, weight: str, least: float = 0.5) -> DataFrame:
    """Bundles of three and four skills whose mean cosine over pairs reaches ``least``; ``support`` is the sum of their
    edges' weights. ``edges`` is (cluster, a, b, cos, weight), a < b. A pair without a cosine is left out of the mean; a
    bundle with no cosine has 0. A fourth skill joins a triangle that is coherent itself, as its neighbour on all sides."""
    e = edges.select("cluster", "a", "b", F.col("cos").alias("_c"), F.col(weight).cast("double").alias("_w"))

    def tie(df: DataFrame, p: str, q: str, name: str) -> DataFrame:
        return df.join(e.toDF("cluster", p, q, f"_c{name}", f"_w{name}"), ["cluster", p, q])

    def mean(names: list[str]) -> Column:
        known = F.array_compact(F.array(*[F.col(f"_c{n}") for n in names]))
        return F.round(F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.size(known)).otherwise(0.0), 9)

    def told(df: DataFrame, ends: list[Column], names: list[str]) -> DataFrame:
        members = F.array_sort(F.array(*ends))
        support = F.round(sum((F.col(f"_w{n}") for n in names), F.lit(0.0)), 9)
        return df.select("cluster", F.array_join(members, ", ").alias("bundle"), members.alias("members"), mean(names).alias("coherence"), support.alias("support"))

    # wedges start at the end of smaller degree in the cluster, so a hub makes few
    degree = e.select("cluster", F.explode(F.array("a", "b")).alias("v")).groupBy("cluster", "v").agg(F.count("*").alias("d"))
    ranked = e.join(degree.toDF("cluster", "a", "_da"), ["cluster", "a"]).join(degree.toDF("cluster", "b", "_db"), ["cluster", "b"])
    first = (F.col("_da") < F.col("_db")) | ((F.col("_da") == F.col("_db")) & (F.col("a") < F.col("b")))
    out = ranked.select("cluster", F.when(first, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("v"), "_c", "_w")
    wedge = out.toDF("cluster", "x", "y", "_c0", "_w0").join(out.toDF("cluster", "x", "z", "_c1", "_w1"), ["cluster", "x"]).filter("y < z")
    three = stored(tie(wedge, "y", "z", "2").filter(mean(["0", "1", "2"]) >= least))
    both = e.union(e.select("cluster", "b", "a", "_c", "_w"))
    four = three
    for k, end in enumerate(("x", "y", "z"), 3):
        four = four.join(both.toDF("cluster", end, "u", f"_c{k}", f"_w{k}"), ["cluster", end] + (["u"] if k > 3 else []))
    pairs = [str(k) for k in range(6)]
    four = four.filter(mean(pairs) >= least)
    # a clique of four comes from each of its triangles, with sums in another order: rounded alike, the largest stands
    four = told(four, [F.col(c) for c in "xyzu"], pairs).groupBy("cluster", "bundle").agg(*[F.max(c).alias(c) for c in ("members", "coherence", "support")])
    return told(three, [F.col(c) for c in "xyz"], pairs[:3]).union(four)


def without_contained(bundles: DataFrame) -> DataFrame:
    """Bundles in the order of coherence, support and name, each kept unless a kept one shares 0.70 of its skills.

    Among bundles of three and four, 0.70 means three skills in common. So a round keeps each bundle that comes first
    among the undecided in every triple of its skills, and drops the others of these triples: groupings by triple, no
    pairs of bundles. Every round decides the first of the undecided at least; rounds are stored."""
    m = F.col("members")
    triples = F.filter(F.transform(F.sequence(F.lit(0), F.size(m)), lambda i: F.array_join(F.filter(m, lambda x, k: k != i), "\x1f")), lambda t: F.size(F.split(t, "\x1f")) == 3)
    place = F.struct((-F.col("coherence")).alias("c"), (-F.col("support")).alias("s"), "bundle")
    left = stored(bundles.select("cluster", "bundle", place.alias("_place"), F.explode(F.array_distinct(triples)).alias("_t")))
    kept = None
    while not left.isEmpty():
        first = left.groupBy("cluster", "_t").agg(F.min("_place").alias("_first"))
        judged = left.join(first, ["cluster", "_t"])
        won = stored(judged.groupBy("cluster", "bundle").agg(F.min(F.col("_place") == F.col("_first")).alias("_won")).filter("_won").select("cluster", "bundle"))
        taken = left.join(won, ["cluster", "bundle"], "left_semi").select("cluster", "_t").distinct()
        gone = left.join(taken, ["cluster", "_t"], "left_semi").select("cluster", "bundle").distinct()
        left = stored(left.join(gone, ["cluster", "bundle"], "left_anti"))
        kept = won if kept is None else kept.union(won)
    return bundles if kept is None else bundles.join(kept, ["cluster", "bundle"], "left_semi")


def selected(bundles: DataFrame, members: DataFrame, sets: DataFrame, weight: str, skills: str, target: int = 175, overlap: int = 2) -> DataFrame:
    """(cluster, bundle, step, gain): in each cluster the bundle that covers the most rows not covered before, then the
    next, to the cluster's quota: max(3, floor(target * share of the rows that hold one of its skills)). Of equal gains
    the larger support wins, then the larger coherence, then the name. A row is covered by ``overlap`` common skills.

    ``sets`` are distinct skill sets with weights, ``members`` is (cluster, skill). Cover is an equi-join on skills and a
    count, made once; a round is one grouping for all clusters together, so rounds are as many as the largest quota."""
    keyed = sets.select(F.col(weight).alias("_n"), F.array_distinct(skills).alias("_s")).withColumn("_set", F.array_join(F.array_sort("_s"), "\x1f"))
    keyed = keyed.groupBy("_set").agg(F.sum("_n").alias("_n"), F.first("_s").alias("_s"))
    flat = keyed.select("_set", "_n", F.explode("_s").alias("skill"))
    whole = keyed.agg(F.sum("_n").alias("_all"))
    touched = flat.join(members, "skill").select("cluster", "_set", "_n").distinct().groupBy("cluster").agg(F.sum("_n").alias("_own"))
    quota = touched.crossJoin(F.broadcast(whole)).select("cluster", F.greatest(F.lit(3), F.floor(F.col("_own") * target / F.col("_all"))).alias("_quota"))
    names = bundles.select("cluster", "bundle", F.explode("members").alias("skill"))
    cover = flat.join(names, "skill").groupBy("cluster", "bundle", "_set", "_n").agg(F.count("*").alias("_k")).filter(F.col("_k") >= overlap).drop("_k")
    left = stored(cover.join(bundles.select("cluster", "bundle", "support", "coherence"), ["cluster", "bundle"]).join(quota, "cluster"))
    out, step = [], 0
    w = Window.partitionBy("cluster").orderBy(F.desc("gain"), F.desc("support"), F.desc("coherence"), "bundle")
    while not left.isEmpty():
        step += 1
        gains = left.filter(F.col("_quota") >= step).groupBy("cluster", "bundle", "support", "coherence").agg(F.sum("_n").alias("gain"))
        best = stored(gains.withColumn("_k", F.row_number().over(w)).filter("_k = 1").select("cluster", "bundle", F.lit(step).alias("step"), "gain"))
        out.append(best)
        done = left.join(best, ["cluster", "bundle"], "left_semi").select("cluster", "_set").distinct()
        left = stored(left.filter(F.col("_quota") > step).join(done, ["cluster", "_set"], "left_anti"))
    if not out:
        return cover.select("cluster", "bundle", F.lit(0).alias("step"), F.col("_n").alias("gain")).limit(0)
    whole_out = out[0]
    for more in out[1:]:
        whole_out = whole_out.union(more)
    return whole_out


def match(sets: DataFrame, key: str, skills: str, bundles: DataFrame, edges: DataFrame, weight: str, alpha: float = 0.5, least: float = 0.25) -> DataFrame:
    """(key, bundle, containment, graph_score, score, whole): each row's best bundle by alpha * share of the row's skills
    in it + (1 - alpha) * mean weight of the edges between the row's skills and the bundle's. Bundles that hold the whole
    row come first if one of them reaches ``least``; else the best of all does, or the row has none. Ties by name.

    What a skill gives to a bundle (is it a member, its edges' weights and count) is summed once for each pair that has
    any; a row adds up its skills' parts. So rows meet only bundles they share a skill or an edge with. The parts are stored,
    so that their size decides the join, and rows are dealt by their key first: where the parts are few, the pairs, of which
    there are many for each row, are made and added up in all tasks alike, without another shuffle."""
    names = bundles.select("bundle", F.explode("members").alias("skill")).distinct()
    both = edges.select(F.col("a").alias("s"), F.col("b").alias("skill"), weight).union(edges.select("b", "a", weight))
    near = both.join(names, "skill").select("bundle", F.col("s").alias("skill"), F.lit(0).alias("_in"), F.col(weight).cast("double").alias("_w"), F.lit(1).alias("_e"))
    parts = stored(near.union(names.select("bundle", "skill", F.lit(1), F.lit(0.0).cast("double"), F.lit(0))).groupBy("bundle", "skill").agg(*[F.sum(c).alias(c) for c in ("_in", "_w", "_e")]))
    dealt = sets.repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    flat = dealt.select(key, F.array_distinct(skills).alias("_s")).select(key, F.size("_s").alias("_n"), F.explode("_s").alias("skill"))
    total = flat.join(parts, "skill").groupBy(key, "_n", "bundle").agg(*[F.sum(c).alias(c) for c in ("_in", "_w", "_e")])
    containment, graph_score = F.col("_in") / F.col("_n"), F.col("_w") / F.greatest(F.col("_e"), F.lit(1))
    scored = total.select(key, "bundle", containment.alias("containment"), graph_score.alias("graph_score"), F.round(alpha * containment + (1 - alpha) * graph_score, 9).alias("score"), (F.col("_in") == F.col("_n")).alias("whole"))
    w = Window.partitionBy(key).orderBy(F.desc("whole"), F.desc("score"), "bundle")
    return scored.filter(F.col("score") >= least).withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def named(bundles: DataFrame) -> DataFrame:
    """``bundles`` with ``name``: its first three skills and eight digits of a digest of cluster and members."""
    digest = F.substring(F.sha2(F.concat_ws("\x1f", F.col("cluster").cast("string"), "members"), 256), 1, 8)
    return bundles.withColumn("name", F.concat_ws("-", F.slice("members", 1, 3), digest))
