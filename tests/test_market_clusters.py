"""Cluster building for all markets at once against a plain loop over each market."""

import random

from fathom.operators import market_clusters as mc

SKILLS = "abcdefgh"


def enough(i, u):
    return i * 10 >= u * (3 if u >= 7 else 4)


def plain_assign(sets, clusters):
    """{set: cluster or None} by likeness, then size, then number."""
    out = {}
    for s in sets:
        best = None
        for c, m in sorted(clusters.items()):
            i, u = len(s & set(m)), len(s | set(m))
            if i and enough(i, u) and (best is None or (-i / u, len(m), c) < best):
                best = (-i / u, len(m), c)
        out[s] = best and best[2]
    return out


def plain_demand(sets, clusters):
    a = plain_assign(sets, clusters)
    return {c: sum(n for s, n in sets.items() if a[s] == c) for c in clusters}


def plain_cover(sets, candidates, most):
    covers = {c: {s for s in sets if s & set(m) and enough(len(s & set(m)), len(s | set(m)))} for c, (m, _) in candidates.items()}
    chosen, covered = [], set()
    while len(chosen) < most:
        gain = {c: sum(sets[s] for s in covers[c] - covered) for c in candidates if c not in chosen}
        best = min(gain, key=lambda c: (-gain[c], c), default=None)
        if best is None or not gain[best]:
            break
        chosen.append(best)
        covered |= covers[best]
    chosen += sorted((c for c in candidates if c not in chosen), key=lambda c: (-candidates[c][1], c))[: most - len(chosen)]
    return {k: list(candidates[c][0]) for k, c in enumerate(chosen, 1)}


def plain_inject(clusters, wanted, sets, demand, largest, most, synthetic=True):
    now, log = {c: list(m) for c, m in clusters.items()}, []
    focus = sorted(wanted, key=lambda s: (-wanted[s], s))
    lacking = lambda: [s for s in focus if not any(s in m for m in now.values())]
    for phase in mc.PHASES:
        if phase == "synthetic":
            while synthetic and lacking() and len(now) < most:
                new = lacking()[: max(2, largest)]
                if len(new) < 2:
                    new += [s for s in focus if s not in new][:1]
                now[max(now, default=0) + 1] = new
                log.append(phase)
            continue
        for s in lacking():
            place = None
            if phase == "append":
                score = {c: sum(n for x, n in sets.items() if s in x and x & set(m)) for c, m in now.items() if len(m) < largest}
                place = min(((-v, c) for c, v in score.items()), default=None)
                place = place and (place[1], None)
            elif phase == "force_append":
                place = next(((c, None) for c in sorted(now) if len(now[c]) < largest), None)
            elif phase == "swap":
                place = next(((c, x) for c in sorted(now) for x in now[c] if x not in wanted), None)
            else:
                every = [(c, k, x) for c in sorted(now) for k, x in enumerate(now[c])]
                first = {}
                for c, k, x in every:
                    first.setdefault(x, (c, k))
                twice = [(demand.get(c, 0), first[x], c, x) for c, _, x in every if sum(y == x for *_, y in every) > 1]
                place = min(twice, default=None)
                place = place and (place[2], place[3])
            if place:
                c, gone = place
                now[c] = now[c] + [s] if gone is None else [s if x == gone else x for x in now[c]]
                log.append(phase)
    return now, log


def plain_replacements(sets, clusters, c, members):
    """{skill: (demand, occurrence, largest)}."""
    out = {}
    pool = {x for s in sets if set(members) <= s for x in s} - set(members)
    for skill in pool:
        trial = clusters | {c: [*members, skill]}
        a = plain_assign(sets, trial)
        mine = [s for s in sets if a[s] == c]
        occ = {x: sum(sets[s] for s in mine if x in s) for x in trial[c]}
        out[skill] = (sum(sets[s] for s in mine), occ[skill], max(occ.values()))
    return out


def plain_trim(sets, clusters, share, smallest, largest, replaces):
    a = plain_assign(sets, clusters)
    state = {}
    for c, m in clusters.items():
        occ = {x: sum(n for s, n in sets.items() if a[s] == c and x in s) for x in m}
        least = max(1, int(share * max(occ.values(), default=0)))
        fit, gone = [x for x in m if occ[x] >= least], [x for x in m if occ[x] < least]
        state[c] = [fit, gone, max(len(gone), smallest - len(fit), 0) if replaces else 0]
    for c in sorted(state):
        fit, gone, need = state[c]
        while need > 0:
            now = {k: (state[k][0] if k <= c else clusters[k]) for k in clusters}
            now = {k: m for k, m in now.items() if m}
            table = plain_replacements(sets, now, c, fit) if 0 < len(fit) < largest else {}
            table = {s: v for s, v in table.items() if s not in gone}
            if not table:
                break
            best = min(table, key=lambda s: (table[s][1] < max(1, int(share * table[s][2])), -table[s][0], s))
            fit.append(best)
            gone.append(best)
            need -= 1
    return {c: v[0] for c, v in state.items() if v[0]}


def plain_build(sets, candidates, wanted, most, smallest, largest, least, share, replaces):
    now = plain_cover(sets, candidates, most)
    now, _ = plain_inject(now, wanted, sets, plain_demand(sets, now), largest, most)
    had = plain_demand(sets, now)
    now, _ = plain_inject({c: m for c, m in now.items() if had[c] >= least}, wanted, sets, had, largest, most, False)
    now = plain_trim(sets, now, share, smallest, largest, replaces)
    had = plain_demand(sets, now)
    return [(tuple(now[c]), had[c]) for c in sorted(now) if had[c] >= least]


def case(rng):
    sets = {}
    for _ in range(rng.randrange(1, 25)):
        sets[frozenset(rng.sample(SKILLS, rng.randrange(1, 5)))] = rng.randrange(1, 9)
    candidates = {k: (sorted(rng.sample(SKILLS, rng.randrange(1, 4))), rng.randrange(20)) for k in range(1, rng.randrange(2, 8))}
    wanted = {s: rng.randrange(1, 30) for s in rng.sample(SKILLS, rng.randrange(5))}
    return sets, candidates, wanted


def frames(spark, cases):
    sets = spark.createDataFrame([(m, ",".join(sorted(s)), sorted(s), n) for m, (x, _, _) in cases.items() for s, n in x.items()], "market string, itemset string, skills array<string>, n long")
    candidates = spark.createDataFrame([(m, c, k, d) for m, (_, x, _) in cases.items() for c, (k, d) in x.items()], "market string, cluster int, members array<string>, demand long")
    wanted = spark.createDataFrame([(m, s, d) for m, (_, _, x) in cases.items() for s, d in x.items()], "market string, skill string, demand long")
    return sets, candidates, wanted


def test_replacements_equal_a_loop_over_candidates(spark):
    rng = random.Random(21)
    cases = {f"m{k}": case(rng) for k in range(200)}
    sets, candidates, _ = frames(spark, cases)
    clusters = candidates.select("market", "cluster", "members")
    trials, slow = [], set()
    for m, (x, c, _) in cases.items():
        now = {k: v[0] for k, v in c.items()}
        k = rng.choice(sorted(now))
        members = now[k][:-1] if len(now[k]) > 1 and rng.random() < 0.7 else now[k]
        trials.append((m, 7, k, members))
        slow |= {(m, 7, s, *v) for s, v in plain_replacements(x, now, k, members).items()}
    got = mc.replacements(mc.by_skill(sets), clusters, spark.createDataFrame(trials, "market string, trial int, cluster int, members array<string>"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(slow) > 300 and set(rows) == slow


def test_build_equals_a_loop_over_markets(spark):
    rng = random.Random(22)
    cases = {f"m{k}": case(rng) for k in range(60)}
    sets, candidates, wanted = frames(spark, cases)
    kept = [f"m{k}" for k in range(0, 60, 3)]
    got = {}
    for r in mc.build(sets, candidates, wanted, 4, 2, 3, 3, 0.3, only_trimmed=kept).orderBy("market", "cluster").collect():
        got.setdefault(r["market"], []).append((tuple(r["members"]), r["demand"]))
    slow = {m: plain_build(x, c, w, 4, 2, 3, 3, 0.3, m not in kept) for m, (x, c, w) in cases.items()}
    assert got == {m: v for m, v in slow.items() if v}


def test_every_phase_places_a_skill(spark):
    sets = {frozenset("ab"): 5, frozenset("bz"): 2, frozenset("cd"): 4, frozenset("z"): 1}
    cases = {
        "append": (sets, {1: ("ab", 1), 2: ("cd", 1)}, {"z": 9}, 3, 2),
        "swap": (sets, {1: ("ab", 1), 2: ("cd", 1)}, {"z": 9, "a": 1, "c": 1, "d": 1}, 2, 2),
        "swap_dup": (sets, {1: ("ab", 1), 2: ("ac", 1)}, {"z": 9, "a": 1, "b": 1, "c": 1}, 2, 2),
        "synthetic": (sets, {1: ("ab", 1)}, {"z": 9, "y": 8, "a": 1, "b": 1}, 2, 3),
        "force_append": (sets, {1: ("ab", 1)}, {"z": 9, "y": 8, "x": 7, "w": 6, "v": 5, "a": 1, "b": 1}, 2, 3),
    }
    for phase, (x, c, w, largest, most) in cases.items():
        s, cand, wanted = frames(spark, {phase: (x, {k: (list(m), d) for k, (m, d) in c.items()}, w)})
        flat = mc.by_skill(s)
        clusters = cand.select("market", "cluster", "members")
        had = plain_demand(x, {k: list(m) for k, (m, _) in c.items()})
        demand = spark.createDataFrame([(phase, k, v) for k, v in had.items()], "market string, cluster int, demand long")
        now, log = mc.inject(clusters, wanted, flat, demand, largest, most)
        slow, told = plain_inject({k: list(m) for k, (m, _) in c.items()}, w, x, had, largest, most)
        assert {r["cluster"]: r["members"] for r in now.collect()} == slow
        if phase == "force_append":  # after new clusters of two, one skill is left and one cluster has room
            assert "synthetic" in told
        else:
            assert phase in told and phase in {r["phase"] for r in log.collect()}
    # room that only a later phase makes: the single new cluster of a lone skill without any other wanted one
    s, cand, wanted = frames(spark, {"f": (sets, {1: (["a", "b"], 1)}, {"z": 9})})
    none = spark.createDataFrame([], "market string, cluster int, demand long")
    now, log = mc.inject(cand.select("market", "cluster", "members"), wanted, mc.by_skill(s), none, 2, 1, synthetic=False)
    assert [r["phase"] for r in log.collect()] == ["swap"]
    assert mc._room("force_append", cand, wanted.select("market", "skill"), wanted, mc.by_skill(s), none, 3).collect()[0]["cluster"] == 1


def test_nothing_there(spark):
    sets, candidates, wanted = frames(spark, {})
    assert mc.build(sets, candidates, wanted, 4, 2, 3, 3).collect() == []
