"""Skill sets: normalising by a dictionary, counts, itemsets, and similarity joins with clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def normalised(df: DataFrame, row: str, skills: str, dictionary: DataFrame, eliminate: Sequence[str] = (), prefix: tuple[str, str] | None = None, drop_beside: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """(row, skills): each token by its canonical name (variants without regard to case, the first of several by name),
    tokens of a prefix by one name, unknown ones as they are; eliminated names go, and ``drop_beside``'s name goes where
    one of the others is there. Rows keep an empty set. The dictionary (variant, canonical) is joined by size."""
    one = dictionary.select(F.lower(F.trim("variant")).alias("_v"), "canonical").groupBy("_v").agg(F.min("canonical").alias("canonical"))
    flat = df.select(row, F.explode_outer(skills).alias("_t")).withColumn("_v", F.lower(F.trim("_t")))
    name = F.coalesce("canonical", F.col("_t"))
    if prefix:
        name = F.when(F.startswith("_v", F.lit(prefix[0].lower())), prefix[1]).otherwise(name)
    named = flat.join(one, "_v", "left").select(row, name.alias("_n"))
    kept = F.when(~F.lower("_n").isin([e.lower() for e in eliminate]), F.col("_n")) if eliminate else F.col("_n")
    out = named.groupBy(row).agg(F.array_sort(F.collect_set(kept)).alias(skills))
    if drop_beside:
        gone, others = drop_beside
        beside = F.arrays_overlap(skills, F.array(*[F.lit(o) for o in others]))
        out = out.withColumn(skills, F.when(beside, F.array_remove(skills, gone)).otherwise(F.col(skills)))
    return out


def in_order(df: DataFrame, row: str, skills: str, dictionary: DataFrame) -> DataFrame:
    """(row, skills): trimmed tokens by their canonical name (exact variants, canonical names among them), each once, in
    the order of its first token; blank tokens go. The dictionary (variant, canonical) is joined by size."""
    one = dictionary.groupBy("variant").agg(F.min("canonical").alias("canonical"))
    flat = df.select(row, F.posexplode_outer(skills).alias("_at", "_t")).withColumn("variant", F.trim("_t"))
    named = flat.join(one, "variant", "left").withColumn("_n", F.when(F.col("variant") != "", F.coalesce("canonical", "variant")))
    first = named.groupBy(row, "_n").agg(F.min("_at").alias("_at"))
    listed = F.array_sort(F.collect_list(F.when(F.col("_n").isNotNull(), F.struct("_at", "_n"))))
    return first.groupBy(row).agg(F.transform(listed, lambda x: x["_n"]).alias(skills))


def skill_counts(df: DataFrame, skills: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Rows that hold each skill, or the sum of their ``weight``."""
    n = F.sum("_w") if weight else F.count("*")
    return df.select(*by, (F.col(weight) if weight else F.lit(1)).alias("_w"), F.explode(F.array_distinct(skills)).alias("skill")).groupBy(*by, "skill").agg(n.alias("n"))


def itemset(skills: str | Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(skills)), ", ")


def itemsets(df: DataFrame, skills: str, qty: Column | None = None) -> DataFrame:
    """Rows by exact combination of skills."""
    return df.filter(F.size(skills) > 0).groupBy(itemset(skills).alias("itemset")).agg(F.count("*").alias("n"), F.first(F.size(F.array_distinct(skills))).alias("skill_count"), *([F.sum(qty).alias("demand")] if qty is not None else []))


def threshold_reached(inter: Column, union: Column, large: int = 7) -> Column:
    """0.3 of a union of ``large`` or more, else 0.4, in whole numbers so that bounds are exact."""
    return F.when(union >= large, inter * 10 >= union * 3).otherwise(inter * 10 >= union * 4)


def jaccard_candidates(sets: DataFrame, key: str, skills: str, clusters: DataFrame) -> DataFrame:
    """(key, cluster, inter, union, size) for every pair with a skill in common: an equi-join on skills and a count,
    not all pairs. ``clusters`` has (cluster, members)."""
    c = clusters.select("cluster", F.array_distinct("members").alias("_m")).withColumn("size", F.size("_m"))
    s = sets.select(key, F.array_distinct(skills).alias("_s")).withColumn("_n", F.size("_s"))
    left = s.select(key, "_n", F.explode("_s").alias("skill"))
    right = c.select("cluster", "size", F.explode("_m").alias("skill"))
    return left.join(right, "skill").groupBy(key, "cluster", "size", "_n").agg(F.count("*").alias("inter")).select(key, "cluster", "size", "inter", (F.col("_n") + F.col("size") - F.col("inter")).alias("union"))


def best_match(candidates: DataFrame, key: str, threshold: Column | None = None) -> DataFrame:
    """Of the pairs that reach their threshold the one of largest Jaccard; then the smaller cluster, then the lower
    number. Fractions are compared by a common denominator, so ties are exact. ``threshold`` replaces the usual one."""
    ok = candidates.filter(threshold_reached(F.col("inter"), F.col("union")) if threshold is None else threshold)
    exact = (F.col("inter").cast("decimal(20,0)") * 10_000_000_000_000 / F.col("union").cast("decimal(20,0)")).cast("decimal(38,6)")
    w = Window.partitionBy(key).orderBy(F.desc(exact), "size", "cluster")
    return ok.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def assign(df: DataFrame, row: str, skills: str, clusters: DataFrame, priority: Sequence[str] = ()) -> DataFrame:
    """(row, cluster or null): distinct skill sets are matched once and their rows looked up.

    A set that holds a priority skill which some cluster holds too goes to the best cluster with the first such skill,
    whatever its Jaccard."""
    keyed = df.withColumn("_set", itemset(skills))
    distinct = keyed.groupBy("_set").agg(F.first(skills).alias(skills))
    pairs = jaccard_candidates(distinct, "_set", skills, clusters)
    if not priority:
        best = best_match(pairs, "_set").select("_set", "cluster")
    else:
        place = lambda c: F.filter(F.transform(F.array(*[F.lit(p) for p in priority]), lambda p, i: F.when(F.array_contains(c, p), i)), lambda i: i.isNotNull())
        held = clusters.select("cluster", F.explode(place("members")).alias("_p"))
        wanted = distinct.select("_set", F.explode(place(skills)).alias("_p")).join(held.select("_p").distinct(), "_p", "left_semi").groupBy("_set").agg(F.min("_p").alias("_p"))
        told = pairs.join(wanted, "_set", "left").join(held.select("cluster", "_p", F.lit(True).alias("_has")), ["cluster", "_p"], "left")
        forced = F.when(F.col("_p").isNull(), threshold_reached(F.col("inter"), F.col("union"))).otherwise(F.coalesce("_has", F.lit(False)))
        best = best_match(told, "_set", forced).select("_set", "cluster")
    return keyed.join(best, "_set", "left").select(row, "cluster")


def split_mapped(df: DataFrame, row: str, assigned: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their cluster's label, and the rows that have no cluster, without the column."""
    told = df.join(assigned, row, "left")
    return told.filter("cluster is not null").join(named, "cluster", "left").drop("cluster"), told.filter("cluster is null").drop("cluster")


def second_pass(df: DataFrame, row: str, skills: str, assigned: DataFrame, clusters: DataFrame, primary: Sequence[str]) -> DataFrame:
    """Assignments with unmatched rows tried again by their primary skills alone, against clusters cut to those."""
    names = F.array(*[F.lit(p) for p in primary])
    rest = df.join(assigned.filter("cluster is null").select(row), row, "left_semi").withColumn(skills, F.array_intersect(skills, names)).filter(F.size(skills) > 0)
    cut = clusters.select("cluster", F.array_intersect("members", names).alias("members")).filter(F.size("members") > 0)
    again = assign(rest, row, skills, cut).select(row, F.col("cluster").alias("_again"))
    return assigned.join(again, row, "left").select(row, F.coalesce("cluster", "_again").alias("cluster"), (F.col("cluster").isNull() & F.col("_again").isNotNull()).alias("second_pass"))


def contained_match(sets: DataFrame, key: str, skills: str, bundles: DataFrame) -> DataFrame:
    """(key, cluster, containment): bundles that hold every skill of the row; the largest share, then the lowest number.

    Such a bundle holds the row's first skill, so rows meet bundles by that one alone and nothing is counted: only pairs
    that are contained reach the grouping. Rows without skills, or with a null among them, have none."""
    s = sets.select(key, F.array_distinct(skills).alias("_s")).withColumn("skill", F.get("_s", F.lit(0)))
    b = bundles.select("cluster", F.array_distinct("members").alias("_m")).withColumn("_size", F.size("_m"))
    first = b.select("cluster", "_size", F.array_compact("_m").alias("_m"), F.explode("_m").alias("skill"))
    met = s.join(first, "skill").filter((F.size("_s") <= F.col("_size")) & (F.size(F.array_except("_s", "_m")) == 0))
    inside = met.select(key, "cluster", (F.size("_s") / F.col("_size")).alias("containment"))
    return inside.groupBy(key).agg(F.max(F.struct("containment", -F.col("cluster"))).alias("_b")).select(key, (-F.col("_b.col2")).alias("cluster"), F.col("_b.containment"))


def occurrence(df: DataFrame, row: str, skills: str, assigned: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, skill, n): rows of each cluster that hold each of its skills."""
    flat = df.join(assigned.filter("cluster is not null"), row).select("cluster", F.explode(F.array_distinct(skills)).alias("skill"))
    own = clusters.select("cluster", F.explode(F.array_distinct("members")).alias("skill"))
    return flat.join(own, ["cluster", "skill"]).groupBy("cluster", "skill").agg(F.count("*").alias("n"))


def labels(occurrences: DataFrame) -> DataFrame:
    """(cluster, label): MSC- and the skills by occurrence, then by name."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("skill"))))
    return occurrences.groupBy("cluster").agg(F.concat(F.lit("MSC-"), F.array_join(F.transform(ordered, lambda x: x["skill"]), "-")).alias("label"))


def gated_skills(counts: DataFrame, minimum: int, top: int, top_minimum: int, low: int, recent: int, recent_share: float, most_cv: float, last_year: int) -> DataFrame:
    """Skills that pass all gates, from (skill, year, n): total of ``minimum``, or among the ``top`` with
    ``top_minimum``; best year of ``low``; last year of ``recent`` and of a share of the total; variation under
    ``most_cv`` (population, years without rows count 0)."""
    years = counts.agg(F.count_distinct("year").alias("_y"))
    s = counts.groupBy("skill").agg(F.sum("n").alias("total"), F.max("n").alias("best"), F.coalesce(F.sum(F.when(F.col("year") == last_year, F.col("n"))), F.lit(0)).alias("last"), F.sum(F.col("n") * F.col("n")).alias("_sq")).crossJoin(F.broadcast(years))
    mean = F.col("total") / F.col("_y")
    s = s.withColumn("cv", F.sqrt(F.greatest(F.lit(0.0), F.col("_sq") / F.col("_y") - mean * mean)) / mean)
    first = s.orderBy(F.desc("total"), F.lower("skill"), "skill").limit(top).filter(F.col("total") >= top_minimum).select("skill", F.lit(True).alias("_top"))
    ok = (F.col("total") >= minimum) | F.coalesce("_top", F.lit(False))
    return s.join(F.broadcast(first), "skill", "left").filter(ok & (F.col("best") >= low) & (F.col("last") >= F.greatest(F.lit(recent), F.floor(F.col("total") * recent_share))) & (F.col("cv") < most_cv)).select("skill", "total", "cv")
