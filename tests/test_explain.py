"""Shapley values against all coalitions."""

import random
from itertools import combinations
from math import factorial

import numpy as np
from pyspark.ml.functions import vector_to_array

from fathom.operators import explain, model


def read(node):
    """A tree's node as plain values: (rows, prediction) or (rows, column, test, left, right)."""
    n = node.impurityStats().count()
    if node.subtreeDepth() == 0:
        return n, node.prediction()
    split = node.split()
    told = set(split.leftCategories()) if split.getClass().getSimpleName() == "CategoricalSplit" else split.threshold()
    return n, split.featureIndex(), told, read(node.leftChild()), read(node.rightChild())


def worth(node, x, known):
    """The expectation of a tree's node when the columns of ``known`` are given."""
    if len(node) == 2:
        return node[1]
    _, j, told, left, right = node
    if j in known:
        return worth(left if (x[j] in told if isinstance(told, set) else x[j] <= told) else right, x, known)
    return (left[0] * worth(left, x, known) + right[0] * worth(right, x, known)) / (left[0] + right[0])


def test_shapley_values_equal_all_coalitions_and_add_up(spark):
    rng = random.Random(16)
    rows = []
    for i in range(400):
        c, e, a, b, z, w = rng.choice("pqrs"), rng.choice("xy"), rng.random(), rng.random(), rng.randrange(4), rng.random()
        rows.append((i, c, e, a, b, float(z), w, 3 * a * (c == "p") + b * z - 2 * (e == "x") * (a > 0.5)))
    df = spark.createDataFrame(rows, "id int, c string, e string, a double, b double, z double, w double, y double")
    m = model.fit_global(df, "y", ["c", "e"], ["a", "b", "z", "w"])
    out = explain.attributed(m, df)
    assert out.columns == [*df.columns, "prediction", "base", "contributions"]
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 400 and all(abs(r["base"] + sum(r["contributions"]) - r["prediction"]) < 1e-6 for r in got.values())
    trees = m.stages[-1]
    xs = m.transform(df).filter("id < 6").select("id", vector_to_array("features").alias("x")).collect()
    roots = [(read(t._java_obj.rootNode()), w) for t, w in list(zip(trees.trees, trees.treeWeights, strict=True))]
    for r in xs:
        v = {s: sum(w * worth(n, r["x"], s) for n, w in roots) for k in range(7) for s in map(frozenset, combinations(range(6), k))}
        slow = [sum(factorial(len(s)) * factorial(5 - len(s)) / factorial(6) * (v[s | {j}] - v[s]) for s in v if j not in s) for j in range(6)]
        assert np.allclose(slow, got[r["id"]]["contributions"], atol=1e-9) and abs(v[frozenset()] - got[r["id"]]["base"]) < 1e-9
    ranked = explain.top(out, ["c", "e", "a", "b", "z", "w"], 4).collect()
    mean = np.abs([r["contributions"] for r in got.values()]).mean(axis=0)
    assert [r["feature"] for r in ranked] == [["c", "e", "a", "b", "z", "w"][i] for i in np.argsort(-mean)[:4]] and [r["place"] for r in ranked] == [1, 2, 3, 4]
    assert explain.attributed(m, df.limit(0)).collect() == []
