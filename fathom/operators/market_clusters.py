"""Building the skill clusters of every market at once.

The steps are a cover, missing skills put in by five phases, small clusters dropped, rare members replaced by what a
simulated assignment prefers, and a last drop. One round does one step of every market together, by joins and windows
over small tables of clusters, and is stored; so rounds grow with the steps of the longest market and not with the number
of markets, and nothing passes through the driver. Everything that concerns orders is asked of two stored tables: the
distinct skill sets by skill, and their pairs with clusters that share a skill.

Tables: ``sets`` (market, itemset, skills, n), one row for each distinct set of a market; ``clusters`` (market, cluster,
members); ``wanted`` (market, skill, demand)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.operators.sets import threshold_reached
from fathom.sources.files import stored

PHASES = ("append", "swap", "swap_dup", "synthetic", "force_append")


def by_skill(sets: DataFrame) -> DataFrame:
    """(market, itemset, n, held, skill): stored once, asked by every step."""
    s = sets.select("market", "itemset", "n", F.array_distinct("skills").alias("_s"))
    return stored(s.select("market", "itemset", "n", F.size("_s").alias("held"), F.explode("_s").alias("skill")))


def _members(clusters: DataFrame) -> DataFrame:
    return clusters.select("market", "cluster", F.posexplode("members").alias("at", "skill"))


def _first(df: DataFrame, *order: Column | str) -> DataFrame:
    """The first row of each market in an order."""
    w = Window.partitionBy("market").orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def pairs(flat: DataFrame, clusters: DataFrame) -> DataFrame:
    """(market, itemset, n, held, cluster, size, inter) of every set and cluster of a market with a skill in common: an
    equi-join on the skill and a count."""
    own = clusters.select("market", "cluster", F.size("members").alias("size"), F.explode("members").alias("skill"))
    return flat.join(own, ["market", "skill"]).groupBy("market", "itemset", "n", "held", "cluster", "size").agg(F.count("*").cast("int").alias("inter"))


def _union(inter: str = "inter") -> Column:
    return F.col("held") + F.col("size") - F.col(inter)


def _likeness(inter: Column, union: Column) -> Column:
    """A number that orders fractions of sets exactly: both sides are small whole numbers."""
    return (inter.cast("decimal(20,0)") * 10_000_000_000_000 / union.cast("decimal(20,0)")).cast("decimal(38,6)")


def ranked(flat: DataFrame, clusters: DataFrame, places: int = 1) -> DataFrame:
    """The pairs that reach their threshold, with ``likeness`` and the ``place`` of the cluster for its set: the largest
    likeness, then the smaller cluster, then the lower number; places up to ``places``."""
    ok = pairs(flat, clusters).filter(threshold_reached(F.col("inter"), _union())).withColumn("likeness", _likeness(F.col("inter"), _union()))
    w = Window.partitionBy("market", "itemset").orderBy(F.desc("likeness"), "size", "cluster")
    return ok.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= places)


def assigned(flat: DataFrame, clusters: DataFrame) -> DataFrame:
    """(market, itemset, n, cluster): each set's best cluster; sets that reach none are left out."""
    return ranked(flat, clusters).select("market", "itemset", "n", "cluster")


def demands(clusters: DataFrame, assignment: DataFrame) -> DataFrame:
    """(market, cluster, members, demand)."""
    got = assignment.groupBy("market", "cluster").agg(F.sum("n").alias("demand"))
    return clusters.join(got, ["market", "cluster"], "left").select("market", "cluster", "members", F.coalesce("demand", F.lit(0)).cast("long").alias("demand"))


def cover(flat: DataFrame, candidates: DataFrame, most: int) -> DataFrame:
    """(market, cluster, members, demand, step): in each market the candidates (market, cluster, members, demand) in the
    order in which each covers the largest weight not covered before, the lowest number of equals; places left when
    nothing more is covered go to the others by demand. A round takes one step of every market."""
    reach = stored(pairs(flat, candidates).filter(threshold_reached(F.col("inter"), _union())).select("market", "itemset", "n", "cluster"))
    left, picks = reach, []
    for step in range(1, most + 1):
        gain = left.groupBy("market", "cluster").agg(F.sum("n").alias("gain"))
        pick = stored(_first(gain.filter("gain > 0"), F.desc("gain"), "cluster").select("market", "cluster", F.lit(step).alias("step")))
        if pick.isEmpty():
            break
        picks.append(pick)
        covered = left.join(pick, ["market", "cluster"], "left_semi").select("market", "itemset").distinct()
        left = stored(left.join(covered, ["market", "itemset"], "left_anti"))
    chosen = candidates.select("market", "cluster", F.lit(0).alias("step")).limit(0)
    for p in picks:
        chosen = chosen.union(p)
    had = chosen.groupBy("market").agg(F.max("step").alias("had"))
    w = Window.partitionBy("market").orderBy(F.desc("demand"), "cluster")
    rest = candidates.join(chosen, ["market", "cluster"], "left_anti").join(had, "market", "left").withColumn("step", F.coalesce("had", F.lit(0)) + F.row_number().over(w))
    steps = chosen.union(rest.filter(F.col("step") <= most).select("market", "cluster", "step"))
    return candidates.join(steps, ["market", "cluster"]).select("market", "cluster", "members", "demand", "step")


def missing(clusters: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted skills that no cluster of their market holds."""
    return wanted.join(clusters.select("market", F.explode("members").alias("skill")), ["market", "skill"], "left_anti").select("market", "skill", "demand")


def _room(phase: str, clusters: DataFrame, target: DataFrame, wanted: DataFrame, flat: DataFrame, demand: DataFrame, largest: int) -> DataFrame:
    """(market, cluster, removed): where one phase puts the skill of ``target`` (market, skill), in the markets where it
    finds a place; removed is null where it is appended."""
    none = F.lit(None).cast("string").alias("removed")
    here = clusters.join(target.select("market"), "market", "left_semi")
    if phase in ("append", "force_append"):
        free = here.filter(F.size("members") < largest).select("market", "cluster", "members")
        if phase == "force_append":
            return _first(free, "cluster").select("market", "cluster", none)
        # the weight of the sets that hold the skill and share any member with the cluster
        holds = flat.join(target, ["market", "skill"]).select("market", "itemset")
        beside = flat.join(holds, ["market", "itemset"], "left_semi")
        shared = beside.join(free.select("market", "cluster", F.explode("members").alias("skill")), ["market", "skill"]).groupBy("market", "cluster", "itemset").agg(F.first("n").alias("n"))
        score = shared.groupBy("market", "cluster").agg(F.sum("n").alias("score"))
        return _first(free.join(score, ["market", "cluster"], "left"), F.desc(F.coalesce("score", F.lit(0))), "cluster").select("market", "cluster", none)
    each = _members(here)
    if phase == "swap":
        free = each.join(wanted.select("market", "skill"), ["market", "skill"], "left_anti")
        return _first(free, "cluster", "at").select("market", "cluster", F.col("skill").alias("removed"))
    seen = Window.partitionBy("market", "skill")
    twice = each.withColumn("_n", F.count("*").over(seen)).withColumn("_at", F.min(F.struct("cluster", "at")).over(seen)).filter("_n > 1")
    return _first(twice.join(demand, ["market", "cluster"], "left"), F.coalesce("demand", F.lit(0)), "_at", "cluster").select("market", "cluster", F.col("skill").alias("removed"))


def inject(clusters: DataFrame, wanted: DataFrame, flat: DataFrame, demand: DataFrame, largest: int, most: int, synthetic: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clusters, log): each wanted skill that its market's clusters lack is put in by the first phase that can.

    append: to the cluster with room that shares the largest weight of sets with it; swap: for the first member that is
    not wanted; swap_dup: for a member that stands in several clusters, in the one of least ``demand`` (market, cluster,
    demand); synthetic: what still lacks makes new clusters, up to ``most`` of them; force_append: to the first cluster
    with room. Within a phase skills come by demand, then by name; a round places one skill of every market. The log has
    (market, phase, round, skill, cluster, removed)."""
    now, log, n = stored(clusters.select("market", "cluster", "members")), [], 0
    for phase in PHASES:
        if phase == "synthetic" and not synthetic:
            continue
        tried = wanted.select("market", "skill").limit(0)
        while True:
            lacking = stored(missing(now, wanted).join(tried, ["market", "skill"], "left_anti"))
            if lacking.isEmpty():
                break
            if phase == "synthetic":
                made = stored(_new_clusters(now, lacking, wanted, largest, most))
                if made.isEmpty():
                    break
                log.append(made.select("market", F.lit(phase).alias("phase"), F.lit(n).alias("round"), F.explode("members").alias("skill"), "cluster", F.lit(None).cast("string").alias("removed")))
                now = stored(now.union(made.select("market", "cluster", "members")))
                n += 1
                continue
            target = stored(_first(lacking, F.desc("demand"), "skill").select("market", "skill"))
            place = stored(_room(phase, now, target, wanted, flat, demand, largest).join(target, "market"))
            new = F.when(F.col("skill").isNull(), F.col("members")).when(F.col("removed").isNull(), F.concat("members", F.array("skill"))).otherwise(F.transform("members", lambda x: F.when(x == F.col("removed"), F.col("skill")).otherwise(x)))
            now = stored(now.join(place, ["market", "cluster"], "left").select("market", "cluster", new.alias("members")))
            log.append(place.select("market", F.lit(phase).alias("phase"), F.lit(n).alias("round"), "skill", "cluster", "removed"))
            tried = stored(tried.union(target))
            n += 1
    told = clusters.select("market", F.lit("").alias("phase"), F.lit(0).alias("round"), F.lit("").alias("skill"), "cluster", F.lit("").alias("removed")).limit(0)
    for part in log:
        told = told.union(part)
    return now, told


def _new_clusters(clusters: DataFrame, lacking: DataFrame, wanted: DataFrame, largest: int, most: int) -> DataFrame:
    """(market, cluster, members): one new cluster in each market with fewer than ``most``: the first skills that lack,
    as many as fit; a single one gets the first other wanted skill beside it."""
    state = clusters.groupBy("market").agg(F.count("*").alias("had"), F.max("cluster").alias("last"))
    order = Window.partitionBy("market").orderBy(F.desc("demand"), "skill")
    batch = lacking.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= max(2, largest))
    lists = batch.groupBy("market").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "skill"))), lambda x: x["skill"]).alias("new"))
    mate = _first(wanted.join(lists, "market").filter(~F.array_contains("new", F.col("skill"))), F.desc("demand"), "skill").select("market", F.col("skill").alias("mate"))
    pair = F.when((F.size("new") < 2) & F.col("mate").isNotNull(), F.concat("new", F.array("mate"))).otherwise(F.col("new"))
    told = lists.join(mate, "market", "left").join(state, "market", "left").filter(F.coalesce("had", F.lit(0)) < most)
    return told.select("market", (F.coalesce("last", F.lit(0)) + 1).cast("int").alias("cluster"), pair.alias("members"))


def replacements(flat: DataFrame, clusters: DataFrame, trials: DataFrame) -> DataFrame:
    """What-if table: (market, trial, skill, demand, occurrence, largest) for every skill that could join the members of
    each trial (market, trial, cluster, members), which stand for the cluster of that number.

    Skills are those of the sets that hold all members of the trial. demand: the weight of the sets that the cluster would
    get with the skill, all other clusters as they are; occurrence: the part of it that holds the skill; largest: the
    most of any member. A set with the skill counts one shared skill more, every other set the same whatever the skill,
    so one join of sets with trials gives all skills' figures: what sets without the skill bring, and what those with it
    change. Sets that share the skill alone are joined by it."""
    mine = trials.select("market", "trial", "cluster", "members", (F.size("members") + 1).alias("size"))
    two = ranked(flat, clusters, 2).select("market", "itemset", "cluster", "place", "likeness", F.col("size").alias("their_size"))
    rivals = two.groupBy("market", "itemset").agg(*[F.max(F.when(F.col("place") == k, F.struct("likeness", "their_size", "cluster"))).alias(f"r{k}") for k in (1, 2)])

    def wins(inter: Column) -> Column:
        """Whether the trial gets the set: its threshold is reached and the best other cluster is behind."""
        union = F.col("held") + F.col("size") - inter
        rival = F.when(F.col("r1.cluster") == F.col("cluster"), F.col("r2")).otherwise(F.col("r1"))
        mine_ = _likeness(inter, union)
        ahead = rival.isNull() | (mine_ > rival["likeness"]) | ((mine_ == rival["likeness"]) & ((F.col("size") < rival["their_size"]) | ((F.col("size") == rival["their_size"]) & (F.col("cluster") < rival["cluster"]))))
        return F.coalesce(threshold_reached(inter, union) & ahead, F.lit(False))

    share = flat.join(mine.select("market", "trial", F.explode("members").alias("skill")), ["market", "skill"]).groupBy("market", "itemset", "n", "held", "trial").agg(F.count("*").cast("int").alias("inter"), F.collect_set("skill").alias("common"))
    seen = share.join(mine, ["market", "trial"]).join(rivals, ["market", "itemset"], "left")
    seen = stored(seen.select("market", "trial", "itemset", "n", "common", (F.col("inter") == F.col("size") - 1).alias("whole"), (wins(F.col("inter")).cast("long") * F.col("n")).alias("without"), (wins(F.col("inter") + 1).cast("long") * F.col("n")).alias("with")))
    each = seen.join(flat.select("market", "itemset", "skill"), ["market", "itemset"]).filter(~F.array_contains("common", F.col("skill")))
    per = each.groupBy("market", "trial", "skill").agg(F.sum("with").alias("with"), F.sum("without").alias("lost"), F.max("whole").alias("pool"))
    pool = per.filter("pool").select("market", "trial", "skill", "with", "lost")
    # sets that hold the skill and no member
    alone = flat.join(pool.select("market", "trial", "skill"), ["market", "skill"]).join(seen.select("market", "trial", "itemset"), ["market", "trial", "itemset"], "left_anti")
    more = alone.join(mine, ["market", "trial"]).join(rivals, ["market", "itemset"], "left").filter(wins(F.lit(1))).groupBy("market", "trial", "skill").agg(F.sum("n").alias("alone"))
    all_without = seen.groupBy("market", "trial").agg(F.sum("without").alias("all_without"))
    # members' own figures: among sets without the skill, and changed by those with it
    member = seen.select("market", "trial", "itemset", "with", "without", F.explode("common").alias("member"))
    base = member.groupBy("market", "trial", "member").agg(F.sum("without").alias("base"))
    change = member.join(flat.select("market", "itemset", "skill"), ["market", "itemset"]).join(pool.select("market", "trial", "skill"), ["market", "trial", "skill"], "left_semi").groupBy("market", "trial", "member", "skill").agg((F.sum("with") - F.sum("without")).alias("change"))
    own = pool.select("market", "trial", "skill").join(base, ["market", "trial"]).join(change, ["market", "trial", "member", "skill"], "left")
    most = own.groupBy("market", "trial", "skill").agg(F.max(F.col("base") + F.coalesce("change", F.lit(0))).alias("members_most"))
    out = pool.join(all_without, ["market", "trial"]).join(more, ["market", "trial", "skill"], "left").join(most, ["market", "trial", "skill"])
    with_ = F.col("with") + F.coalesce("alone", F.lit(0))
    return out.select("market", "trial", "skill", (F.col("all_without") - F.col("lost") + with_).alias("demand"), with_.alias("occurrence"), F.greatest("members_most", with_).alias("largest"))


def occurrences(flat: DataFrame, clusters: DataFrame, assignment: DataFrame) -> DataFrame:
    """(market, cluster, at, skill, n): the weight of each cluster's sets that hold each of its members."""
    held = flat.join(assignment.select("market", "itemset", "cluster"), ["market", "itemset"]).groupBy("market", "cluster", "skill").agg(F.sum("n").alias("n"))
    return _members(clusters).join(held, ["market", "cluster", "skill"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _least(largest: Column, share: float) -> Column:
    return F.greatest(F.lit(1), F.floor(F.lit(share) * largest))


def trim(flat: DataFrame, clusters: DataFrame, share: float, smallest: int, largest: int, only_trimmed: Sequence[str] = ()) -> DataFrame:
    """Clusters without the members that occur in fewer than ``share`` of the sets of the commonest one (one set at
    least). Outside the markets of ``only_trimmed`` each is replaced by the skill that brings the cluster the most, those
    first that occur often enough themselves; so are members that it lacks to ``smallest``. Clusters go one after
    another, one member of one cluster of every market in a round; empty clusters go."""
    occ = occurrences(flat, clusters, assigned(flat, clusters))
    top = F.max("n").over(Window.partitionBy("market", "cluster"))
    told = occ.withColumn("fits", F.col("n") >= _least(top, share))
    names = lambda fit: F.transform(F.array_sort(F.collect_list(F.when(F.col("fits") == fit, F.struct("at", "skill")))), lambda x: x["skill"])
    state = told.groupBy("market", "cluster").agg(names(True).alias("fit"), names(False).alias("gone"))
    replaces = ~F.col("market").isin(list(only_trimmed)) if only_trimmed else F.lit(True)
    need = F.when(replaces, F.greatest(F.size("gone"), F.lit(smallest) - F.size("fit"), F.lit(0))).otherwise(0)
    todo = stored(state.withColumn("need", need))
    while True:
        turn = stored(_first(todo.filter("need > 0"), "cluster").select("market", "cluster", "fit", "gone"))
        if turn.isEmpty():
            break
        # clusters whose turn is over or has come are trimmed, later ones still as they were
        at = turn.select("market", F.col("cluster").alias("turn"))
        as_now = clusters.join(todo.select("market", "cluster", "fit"), ["market", "cluster"]).join(at, "market").select("market", "cluster", F.when(F.col("cluster") <= F.col("turn"), F.col("fit")).otherwise(F.col("members")).alias("members")).filter(F.size("members") > 0)
        trials = turn.filter((F.size("fit") > 0) & (F.size("fit") < largest)).select("market", F.col("cluster").alias("trial"), "cluster", F.col("fit").alias("members"))
        gone = turn.select("market", F.explode("gone").alias("skill"))
        table = replacements(flat, as_now, trials).join(gone, ["market", "skill"], "left_anti")
        best = _first(table, F.desc(F.col("occurrence") >= _least(F.col("largest"), share)), F.desc("demand"), "skill").select("market", F.col("trial").alias("cluster"), F.col("skill").alias("added"))
        found = stored(turn.select("market", "cluster").join(best, ["market", "cluster"], "left").select("market", "cluster", "added", F.lit(True).alias("turned")))
        add = F.when(F.col("added").isNotNull(), F.array("added")).otherwise(F.array().cast("array<string>"))
        rest = F.when(F.col("turned").isNull(), F.col("need")).when(F.col("added").isNull(), 0).otherwise(F.col("need") - 1)
        todo = stored(todo.join(found, ["market", "cluster"], "left").select("market", "cluster", F.concat("fit", add).alias("fit"), F.concat("gone", add).alias("gone"), rest.cast("int").alias("need")))
    return todo.filter(F.size("fit") > 0).select("market", "cluster", F.col("fit").alias("members"))


def build(sets: DataFrame, candidates: DataFrame, wanted: DataFrame, most: int, smallest: int, largest: int, least_demand: int, share: float = 0.2, only_trimmed: Sequence[str] = ()) -> DataFrame:
    """(market, cluster, members, demand) for every market, numbered from 1 in the order of the cover.

    Null skills and empty sets take no part. A market without candidates or sets has no clusters, unless wanted skills
    make some. After a drop, lost skills are put back without new clusters."""
    flat = by_skill(sets.filter("market IS NOT NULL AND itemset IS NOT NULL"))
    now = stored(cover(flat, candidates, most).select("market", F.col("step").alias("cluster"), "members"))
    had = stored(demands(now, assigned(flat, now)))
    now, _ = inject(now, wanted, flat, had.select("market", "cluster", "demand"), largest, most)
    had = stored(demands(now, assigned(flat, now)))
    now = had.filter(F.col("demand") >= least_demand).select("market", "cluster", "members")
    now, _ = inject(now, wanted, flat, had.select("market", "cluster", "demand"), largest, most, synthetic=False)
    now = stored(trim(flat, now, share, smallest, largest, only_trimmed))
    out = demands(now, assigned(flat, now)).filter(F.col("demand") >= least_demand)
    number = F.row_number().over(Window.partitionBy("market").orderBy("cluster"))
    return out.select("market", number.alias("cluster"), "members", "demand")
