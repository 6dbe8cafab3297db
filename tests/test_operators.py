"""Small fixtures for the rules that the tables do not exercise."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from fathom.functions.dates import month_number, month_of_column
from fathom.functions.tokens import flat_tokens, tokens
from fathom.operators import aggregate, clean, graph, match, sets, warehouse
from fathom.sources import files


def values(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("Java, Python", ["Java", "Python"]),
        ("A; B: C", ["A", "B", "C"]),
        ("Azure (Logic Apps, Functions)", ["Azure", "Functions", "Logic Apps"]),
        ("X (a (b), c)", ["X", "a", "b", "c"]),
        ("Y (z", ["Y", "z"]),
        ("HTML CSS JavaScript", ["CSS", "HTML", "JavaScript"]),
        ("", []),
        (None, []),
        ("Java, Java", ["Java"]),
    ],
)
def test_tokens(spark, cell, expected):
    df = spark.createDataFrame([(cell,)], "c string")
    assert sorted(df.select(tokens("c").alias("t")).first()["t"]) == expected


def test_flat_tokens(spark):
    df = spark.createDataFrame([("A (b, c), D",)], "c string")
    assert df.select(flat_tokens("c").alias("t")).first()["t"] == ["A (b, c)", "D"]


def test_dates(spark):
    texts = ["2024-01-05", "01-05-2024", "2024/01/05", "01/05/2024", "05-Jan-2024", "05-Jan-24", "garbage", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string").select("d", clean.parse_date("d").alias("p"))
    got = {r["d"]: r["p"] for r in df.collect()}
    assert got["garbage"] is None and got[None] is None
    assert {got[t] for t in texts[:6]} == {date(2024, 1, 5)}


def test_month_names(spark):
    df = spark.createDataFrame([("Jan",), ("september",), ("7",), ("x",)], "m string")
    assert [r[0] for r in df.select(month_number("m")).collect()] == [1, 9, 7, None]
    assert month_of_column("Mar-24_Forecast") == (2024, 3, "Forecast") and month_of_column("Market") is None


def test_relabel_keeps_null(spark):
    df = spark.createDataFrame([("PT",), ("vp",), (" sa ",), (None,), ("P",)], "g string")
    assert {r["g"] for r in clean.relabel(df, "g", ["PT", "VP"], {"SA": "Senior", "P": "Mid"}).collect()} == {"Senior", None, "Mid"}


def test_rules_follow_each_other(spark):
    df = spark.createDataFrame([("T-UK",), ("T&H",)], "bu string")
    out = clean.rewritten(df, "bu", [(F.col("bu") == "T-UK", "T&H"), (F.col("bu") == "T&H", "RCG")])
    assert {r["bu"] for r in out.collect()} == {"RCG"}


def test_jaccard_bounds_and_ties(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "x", "y", "z"]), (3, ["q"])], "row int, skills array<string>")
    clusters = spark.createDataFrame([(1, ["a", "b", "d"]), (2, ["a", "c", "e"]), (3, ["a"])], "cluster int, members array<string>")
    assert dict(values(sets.assign(rows, "row", "skills", clusters), "row", "cluster")) == {1: 1, 2: None, 3: None}


def test_normaliser(spark):
    rows = spark.createDataFrame([(1, ["java", "API Development"]), (2, ["API Development"]), (3, []), (4, ["Project Planning", "junk"])], "row int, skills array<string>")
    names = spark.createDataFrame([("JAVA", "Java")], "variant string, canonical string")
    out = sets.normalised(rows, "row", "skills", names, ["Junk"], ("project ", "Project Management"), ("API Development", ["Java"]))
    assert {r["row"]: r["skills"] for r in out.collect()} == {1: ["Java"], 2: ["API Development"], 3: [], 4: ["Project Management"]}


def test_null_safe_upsert(spark):
    old = spark.createDataFrame([(1, None, 5), (2, 7, 6)], "a int, b int, v int")
    new = spark.createDataFrame([(1, None, 9)], "a int, b int, v int")
    assert values(warehouse.upserted(old, new, ["a", "b"]), "a", "b", "v") == [(1, None, 9), (2, 7, 6)]
    assert match.null_safe(old, new.withColumnRenamed("v", "w"), ["a", "b"]).count() == 1


def test_running_sum_in_ranges(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "k int, v int")
    got = dict(values(aggregate.running(df, "k", "v", parts=8), "k", "upto"))
    total = 0
    for i in range(500):
        total += i % 7
        assert got[i] == total


def test_components(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "a string, b string")
    assert dict(values(graph.connected(e), "node", "root")) == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    chain = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(900, 901), (7, 7), (950, 950)], "a long, b long")
    assert dict(values(graph.connected(chain), "node", "root")) == {**dict.fromkeys(range(301), 0), 900: 900, 901: 900, 950: 950}
    assert graph.connected(chain.limit(0)).count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"Java": {"variants": ["java 8", "J2SE"]}, "Go": {"variants": []}}')
    got = values(files.read_dictionary(spark, f"file://{tmp_path}/d.json"), "variant", "canonical")
    assert got == [("Go", "Go"), ("J2SE", "Java"), ("Java", "Java"), ("java 8", "Java")]
    (tmp_path / "c.json").write_text('{"market": "m", "clusters": [["a", "b"], ["c"]]}')
    assert values(files.read_clusters(spark, f"file://{tmp_path}/c.json"), "market", "cluster", "members") == [("m", 1, ["a", "b"]), ("m", 2, ["c"])]
    df = spark.createDataFrame([(1, "x", "train"), (2, "y", "test")], "v int, g string, s string")
    assert files.write_groups(df, f"file://{tmp_path}/out", ["g"], "s").count() == 2
    assert files.token("A & B (c)") == "a_b_c" and files.abbreviation("Digital and Engineering") == "DE" and files.year_range(["a_2023.csv", "b_2025.csv"]) == "2023-2025"
    with pytest.raises(ValueError, match="missing"):
        files.read_csv(spark, f"file://{tmp_path}/d.json", ["nope"])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "market string, country string, y int, v int")
    assert clean.without_rare(empty, "market", "country", "y", 0.1, 0.1).count() == 0
    assert aggregate.value_counts(empty, "market").count() == 0
    assert aggregate.running(empty, "y", "v").count() == 0


def test_row_rules(spark):
    from fathom.operators import clean, series

    rows = spark.createDataFrame([(1, {"bu": "ADM", "x": "1"}), (2, {"x": "1"}), (3, {"bu": "EPS"}), (4, None)], "id int, row map<string,string>")
    assert sorted(r["id"] for r in rows.filter(clean.matches("row", {"bu": ["adm"], "market": ["EMEA"]})).collect()) == [1, 2, 4]
    texts = spark.createDataFrame([("a &eacute;&#33; &amp;lt;",), (None,), ("plain",)], "t string")
    assert [r["x"] for r in texts.select(clean.unescaped("t").alias("x")).collect()] == ["a é! &lt;", None, "plain"]
    days = spark.createDataFrame([("g", f"2000-01-{d:02d}") for d in (1, 1, 3, 7)] + [("h", "2000-01-02")], "k string, d string").selectExpr("k", "to_date(d) AS d")
    import numpy as np

    got = {r["k"]: r["slope"] for r in series.count_slope(days, ["k"], "d", "2000-02-01").collect()}
    assert got["h"] == 0 and abs(got["g"] - np.polyfit([0, 0, 2, 6], [0, 1, 2, 3], 1)[0]) < 1e-9


def test_ordered_normaliser(spark):
    from fathom.operators import sets

    cells = spark.createDataFrame([(1, [" js", "Java", "JavaScript", "", "js"]), (2, []), (3, None)], "id int, skills array<string>")
    out = {r["id"]: r["skills"] for r in sets.in_order(cells, "id", "skills", spark.createDataFrame([("js", "JavaScript"), ("JavaScript", "JavaScript")], "variant string, canonical string")).collect()}
    assert out == {1: ["JavaScript", "Java"], 2: [], 3: []}


def test_failed_steps_are_told(spark):
    from fathom.operators import warehouse

    def bad():
        raise ValueError("no")

    log = warehouse.orchestrated([("one", lambda: spark.range(3)), ("two", bad), ("three", lambda: spark.range(1))], spark)
    assert [tuple(r)[1:] for r in log.orderBy("position").collect()] == [("one", "completed", 3), ("two", "failed: ValueError", None), ("three", "skipped", None)]


def small_graph(spark):
    import itertools
    import random

    r = random.Random(3)
    names = [f"s{i}" for i in range(9)]
    vectors = {n: [r.uniform(-0.2, 1) for _ in range(4)] for n in names if n != "s8"}
    edges = {(a, b): r.choice([0.1, 0.25, 0.5]) for a, b in itertools.combinations(names, 2) if r.random() < 0.75}
    cluster = {n: 1 + (i >= 6) for i, n in enumerate(names)} | {"s5": 1}
    rows = [(i, sorted(r.sample(names, r.randint(1, 4)))) for i in range(60)]
    e = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "a string, b string, w double")
    v = spark.createDataFrame(list(vectors.items()), "node string, vector array<double>")
    m = spark.createDataFrame([(c, n) for n, c in cluster.items()], "cluster int, skill string")
    return names, vectors, edges, cluster, rows, e, v, m


def test_bundles_against_brute_force(spark):
    import itertools

    import numpy as np

    from fathom.operators import bundles

    names, vectors, edges, cluster, rows, e, v, m = small_graph(spark)
    w = lambda a, b: edges.get((min(a, b), max(a, b)))

    def coherence(b):
        cos = [np.dot(vectors[x], vectors[y]) / np.linalg.norm(vectors[x]) / np.linalg.norm(vectors[y]) for x, y in itertools.combinations(b, 2) if x in vectors and y in vectors]
        return round(float(np.mean(cos)) if cos else 0.0, 9)

    want = {}
    for c in (1, 2):
        own = [n for n in names if cluster[n] == c]
        clique = lambda b: all(w(x, y) is not None for x, y in itertools.combinations(b, 2))
        threes = [t for t in itertools.combinations(own, 3) if clique(t) and coherence(t) >= 0.5]
        fours = {tuple(sorted({*t, x})) for t in threes for x in own if x not in t and clique({*t, x}) and coherence({*t, x}) >= 0.5}
        for b in [*threes, *fours]:
            want[c, ", ".join(b)] = (coherence(b), round(sum(w(x, y) for x, y in itertools.combinations(b, 2)), 9))
    found = bundles.candidates(bundles.inside(bundles.with_cosine(e, v), m), "w", 0.5).cache()
    got = {(r["cluster"], r["bundle"]): (r["coherence"], r["support"]) for r in found.collect()}
    assert len(want) > 8 and set(got) == set(want) and all(np.allclose(got[k], want[k], atol=2e-9) for k in want)

    order = sorted(got, key=lambda k: (-got[k][0], -got[k][1], k[1]))
    kept = []
    for c, b in order:
        s = set(b.split(", "))
        if not any(k == c and len(s & set(t.split(", "))) / len(t.split(", ")) >= 0.70 for k, t in kept):
            kept.append((c, b))
    left = bundles.without_contained(found).cache()
    assert values(left, "cluster", "bundle") == sorted(kept, key=str)

    chosen = set()
    for c in (1, 2):
        own = {i for i, s in rows if any(cluster[x] == c for x in s)}
        cover = {b: {i for i, s in rows if len(set(s) & set(b.split(", "))) >= 2} for k, b in kept if k == c}
        quota, uncovered, step = max(3, int(10 * len(own) / len(rows))), set(own), 0
        while step < quota and cover:
            best = min(cover, key=lambda b: (-len(cover[b] & uncovered), -got[c, b][1], -got[c, b][0], b))
            gain = len(cover[best] & uncovered)
            if not gain:
                break
            step += 1
            chosen.add((c, best, step, gain))
            uncovered -= cover[best]
    sets_ = spark.createDataFrame([(1, s) for _, s in rows], "n long, skills array<string>")
    assert set(values(bundles.selected(left, m, sets_, "n", "skills", target=10), "cluster", "bundle", "step", "gain")) == chosen
    assert bundles.selected(left.limit(0), m, sets_, "n", "skills").count() == 0 and bundles.without_contained(left.limit(0)).count() == 0
    assert all(r["name"].startswith("-".join(r["members"][:3])) for r in bundles.named(left).collect())

    every = sorted({b for _, b in got})
    best = {}
    for i, s in rows:
        told = []
        for b in every:
            own = b.split(", ")
            near = [w(x, y) for x in s for y in own if x != y and w(x, y) is not None]
            told.append((set(s) <= set(own), round(0.5 * len(set(s) & set(own)) / len(s) + 0.5 * sum(near) / max(1, len(near)), 9), b))
        good = [t for t in told if t[1] >= 0.25]
        if good:
            best[i] = min(good, key=lambda t: (not t[0], -t[1], t[2]))
    df = spark.createDataFrame([*rows, (900, ["unknown"]), (901, []), (902, None)], "id int, skills array<string>")
    assert {r["id"]: (r["whole"], r["score"], r["bundle"]) for r in bundles.match(df, "id", "skills", found, e, "w").collect()} == best


def test_priority_and_padding(spark):
    clusters = spark.createDataFrame([(1, ["a", "b"], 5), (2, ["a", "c", "d"], 9), (3, ["x", "y"], 7)], "cluster int, members array<string>, demand long")
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "d", "e", "f", "g", "h", "i"]), (3, ["x"]), (4, ["q"]), (5, ["b", "p"]), (6, None)], "id int, skills array<string>")
    assert dict(values(sets.assign(rows, "id", "skills", clusters, ["p", "d", "a"]), "id", "cluster")) == {1: 1, 2: 2, 3: 3, 4: None, 5: None, 6: None}
    assert dict(values(sets.assign(rows, "id", "skills", clusters), "id", "cluster"))[2] is None
    labels = spark.createDataFrame([(1, "MSC-a-b"), (2, "MSC-a"), (3, "MSC-x")], "cluster int, label string")
    mapped, rest = sets.split_mapped(rows, "id", sets.assign(rows, "id", "skills", clusters), labels)
    assert values(mapped, "id", "label") == [(1, "MSC-a-b"), (3, "MSC-x")] and mapped.columns == ["id", "skills", "label"] and rest.count() == 4
    weighted = spark.createDataFrame([("ab", ["a", "b"], 4)], "itemset string, skills array<string>, n long")
    assert [tuple(r) for r in graph.greedy_cover(weighted, "itemset", "n", "skills", clusters, 3, "demand").orderBy("step").collect()] == [(1, 1, 4.0), (2, 2, 0.0), (3, 3, 0.0)]


def test_biased_walks(spark):
    from fathom.operators import model

    path = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}", 1) for i in range(20)], "a string, b string, w int")
    turns = lambda p: sum(x == z for r in model.walks(path, "w", 5, 4, p=p).collect() for x, z in zip(r["walk"], r["walk"][2:], strict=False))
    assert turns(1e6) < turns(1.0) < turns(1e-6)


def _loads(monkeypatch, table):
    """A list that grows with every time that a query of skill sets asks for ``table``."""
    from fathom.plans import q_sets

    seen, load = [], q_sets.load
    monkeypatch.setattr(q_sets, "load", lambda spark, d, name: (seen.append(name) if name == table else None) or load(spark, d, name))
    return seen


def test_contained_match_meets_bundles_by_one_skill(spark):
    rows = [(1, ["a", "b"]), (2, ["b"]), (3, ["a", "z"]), (4, []), (5, None), (6, ["c", "a", "b"]), (7, [None]), (8, ["b", "b"]), (9, ["a", None])]
    held = [(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["b", "a"]), (4, [None, "a", "z", "z"])]
    got = sets.contained_match(spark.createDataFrame(rows, "k int, skills array<string>"), "k", "skills", spark.createDataFrame(held, "cluster int, members array<string>"))
    want = {}
    for k, s in rows:
        own = set(s or ())
        fits = [(-len(own) / len(set(m)), c) for c, m in held if own and None not in own and own <= set(m)]
        if fits:
            want[k] = (min(fits)[1], -min(fits)[0])
    assert {r["k"]: (r["cluster"], r["containment"]) for r in got.collect()} == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1  # the bundles' members, not the rows' skills


def test_skills_become_words_after_the_shuffle(spark):
    from fathom.plans.q_sets import order_skills

    assert "Generate" not in order_skills(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_weighted_sets_count_like_their_rows(spark):
    rows = spark.createDataFrame([(["a", "b", "c"], 3), (["b", "a"], 2), (["c"], 4), ([], 5)], "skills array<string>, n long")
    each = rows.select("skills", F.explode(F.sequence(F.lit(1), F.col("n"))))
    for one, many in ((sets.skill_counts(rows, "skills", weight="n"), sets.skill_counts(each, "skills")), (graph.pair_counts(rows, "skills", "n"), graph.pair_counts(each, "skills")), (graph.measures(rows, "skills", "n"), graph.measures(each, "skills"))):
        assert sorted(one.collect()) == sorted(many.collect())


@pytest.mark.parametrize("name", ["bundle_selection", "cluster_build", "bundle_match"])
def test_orders_are_gathered_once(spark, monkeypatch, name):
    from fathom.plans.catalog import QUERIES

    seen = _loads(monkeypatch, "lineitem")
    out = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen == ["lineitem"]
    assert "lineitem" not in " ".join(out.inputFiles())


def test_bundle_match_deals_rows_before_pairs(spark):
    from fathom.operators import bundles

    rows = spark.createDataFrame([("a, b", ["a", "b"]), ("b", ["b"])], "itemset string, skills array<string>")
    held = spark.createDataFrame([("a, b, c", ["a", "b", "c"])], "bundle string, members array<string>")
    edges = spark.createDataFrame([("a", "b", 0.5), ("b", "c", 0.25)], "a string, b string, w double")
    got = bundles.match(rows, "itemset", "skills", held, edges, "w")
    assert sorted((r["itemset"], r["containment"], r["graph_score"], r["whole"]) for r in got.collect()) == [("a, b", 1.0, 1.25 / 3, True), ("b", 1.0, 0.375, True)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(skill" not in plan
