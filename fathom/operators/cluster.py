"""Building a market's skill clusters: cover, missing skills put in, small clusters dropped, rare members trimmed.

Rows are collapsed to distinct skill sets with weights first. The driver holds the clusters alone (``most`` lists of a few
names); every count over rows is a Spark job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.operators import graph, sets
from fathom.sources.files import stored

Clusters = dict[int, list[str]]


def frame(spark, clusters: Clusters) -> DataFrame:
    return spark.createDataFrame([(k, list(v)) for k, v in sorted(clusters.items())], "cluster int, members array<string>")


def demand(weighted: DataFrame, clusters: Clusters) -> dict[int, float]:
    """Weight of the sets that each cluster gets."""
    a = sets.assign(weighted, "itemset", "skills", frame(weighted.sparkSession, clusters))
    got = weighted.join(a.filter("cluster is not null"), "itemset").groupBy("cluster").agg(F.sum("n").alias("n"))
    return {r["cluster"]: float(r["n"]) for r in got.collect()}


def together(weighted: DataFrame, names: Sequence[str]) -> dict[tuple[str, str], float]:
    """Weight of the sets that hold both of two names, for the given names."""
    few = weighted.withColumn("skills", F.array_intersect("skills", F.array(*[F.lit(x) for x in names])))
    flat = few.select("n", F.explode("skills").alias("a"), "skills").select("n", "a", F.explode("skills").alias("b"))
    return {(r["a"], r["b"]): float(r["n"]) for r in flat.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()}


def inject(clusters: Clusters, wanted: Sequence[str], both: dict[tuple[str, str], float], largest: int = 8) -> Clusters:
    """Each wanted skill that no cluster holds: appended to the cluster it stands with most often, if there is room; else
    in place of that cluster's member that another cluster holds too and that stands with the skill least; else as a new
    cluster with the wanted skill nearest to it."""
    out = {k: list(v) for k, v in clusters.items()}
    for skill in wanted:
        if any(skill in v for v in out.values()):
            continue
        near = lambda x, s=skill: both.get((s, x), 0.0)
        ranked = sorted(out, key=lambda k: (-sum(map(near, out[k])), k))
        if ranked and sum(map(near, out[ranked[0]])) > 0:
            home = ranked[0]
            if len(out[home]) < largest:
                out[home].append(skill)
                continue
            double = [x for x in out[home] if any(x in v for k, v in out.items() if k != home)]
            if double:
                out[home][out[home].index(min(double, key=lambda x: (near(x), x)))] = skill
                continue
        partner = max((x for x in wanted if x != skill and near(x) > 0), key=lambda x: (near(x), x), default=None)
        out[max(out, default=0) + 1] = [skill] + ([partner] if partner else [])
    return out


def trimmed(weighted: DataFrame, clusters: Clusters, share: float = 0.2) -> Clusters:
    """Members that occur in their cluster's sets at least ``share`` times as often as its commonest member."""
    f = frame(weighted.sparkSession, clusters)
    a = sets.assign(weighted, "itemset", "skills", f).filter("cluster is not null")
    flat = weighted.join(a, "itemset").select("cluster", "n", F.explode("skills").alias("skill")).groupBy("cluster", "skill").agg(F.sum("n").alias("n"))
    seen: dict[int, dict[str, float]] = {}
    for r in flat.join(f.select("cluster", F.explode("members").alias("skill")), ["cluster", "skill"]).collect():
        seen.setdefault(r["cluster"], {})[r["skill"]] = float(r["n"])
    return {k: [x for x in v if seen.get(k, {}).get(x, 0) >= share * max(seen.get(k, {0: 0.0}).values())] for k, v in clusters.items()}


def build(weighted: DataFrame, candidates: DataFrame, most: int, wanted: Sequence[str], least_demand: float, share: float = 0.2) -> DataFrame:
    """(cluster, members, demand) from (itemset, skills, n) and candidate clusters."""
    spark = weighted.sparkSession
    weighted = stored(weighted.select("itemset", "skills", "n"))
    picked = [r["cluster"] for r in graph.greedy_cover(weighted, "itemset", "n", "skills", candidates, most).orderBy("step").collect()]
    members = {r["cluster"]: list(r["members"]) for r in candidates.filter(F.col("cluster").isin(picked)).collect()} if picked else {}
    clusters: Clusters = {k: members[c] for k, c in enumerate(picked, 1)}
    clusters = inject(clusters, wanted, together(weighted, sorted({*wanted, *(x for v in clusters.values() for x in v)})))
    for step in ("drop", "trim", "drop"):
        if not clusters:
            break
        if step == "trim":
            clusters = {k: v for k, v in trimmed(weighted, clusters, share).items() if v}
        else:
            got = demand(weighted, clusters)
            clusters = {k: v for k, v in clusters.items() if got.get(k, 0) >= least_demand}
    got = demand(weighted, clusters) if clusters else {}
    rows = [(k, sorted(v), got.get(k, 0.0)) for k, v in sorted(clusters.items())]
    return spark.createDataFrame(rows, "cluster int, members array<string>, demand double")
