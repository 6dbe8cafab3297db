"""The ensemble and the model for each group."""

import random

import numpy as np
from pyspark.sql import functions as F

from fathom.operators import stack


def rows(spark, n=300, wrong=None):
    rng = random.Random(31)
    out = []
    for i in range(n):
        c, a, b = rng.choice("pqr"), rng.random(), rng.random()
        y = 2 + 3 * a + (4 if c == "p" else 0) * (b > 0.5) + rng.random()
        out.append((i, c, a, b, 500.0 if i == wrong else y))
    return spark.createDataFrame(out, "id int, c string, a double, b double, y double")


def test_held_out_predictions_never_saw_their_row(spark):
    kinds = ("poisson", "forest")
    s, held = stack.fit_stack(rows(spark), ["id"], "y", ["c"], ["a", "b"], kinds, folds=3)
    before = {r["id"]: r for r in held.collect()}
    assert len(before) == 300 and {r["fold"] for r in before.values()} == {0, 1, 2}
    _, other = stack.fit_stack(rows(spark, wrong=5), ["id"], "y", ["c"], ["a", "b"], kinds, folds=3)
    after = {r["id"]: r for r in other.collect()}
    same = [i for i in before if all(abs(before[i][f"by_{k}"] - after[i][f"by_{k}"]) < 1e-9 for k in kinds)]
    assert 5 in same and all(before[i]["fold"] == before[5]["fold"] for i in same)  # only models without row 5 stayed
    # no worse than its best base model, where the weights were found
    y = np.array([r["y"] for r in before.values()])
    p = {k: np.array([r[f"by_{k}"] for r in before.values()]) for k in kinds}
    error = {k: ((v - y) ** 2).mean() for k, v in p.items()}
    assert (sum(s.weights[k] * p[k] for k in kinds) - y).var() < y.var()
    assert ((sum(s.weights[k] * p[k] for k in kinds) - y) ** 2).mean() <= min(error.values()) + 1e-9
    assert abs(sum(s.weights.values()) - 1) < 1e-9 and min(s.weights.values()) >= 0
    new = stack.predict_stack(s, rows(spark).drop("y").limit(20)).collect()
    assert len(new) == 20 and all(abs(r["predicted"] - sum(s.weights[k] * r[f"by_{k}"] for k in kinds)) < 1e-9 for r in new)


def test_simplex_weights_beat_a_grid():
    rng = np.random.default_rng(1)
    for _ in range(20):
        p, y = rng.normal(size=(40, 3)), rng.normal(size=40)
        w = stack.simplex_weights(p.T @ p, p.T @ y)
        loss = lambda v: ((p @ np.array(v) - y) ** 2).sum()  # noqa: E731, B023
        assert loss(w) <= min(loss((a / 20, b / 20, 1 - a / 20 - b / 20)) for a in range(21) for b in range(21 - a)) + 1e-9


def test_booster_splits_like_a_search_and_learns():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, size=(60, 3)).astype(float)
    y = rng.poisson(np.exp(0.3 + 0.8 * (x[:, 1] > 2) + 0.3 * (x[:, 0] > 3))).astype(float)
    b = stack.Booster()
    g, h = np.full(60, y.mean()) - y, np.full(60, y.mean())
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + b.ridge)
    slow = max(((score(m) + score(~m) - score(np.ones(60, bool)), j, t) for j in range(3) for t in np.arange(6) + 0.5 for m in [x[:, j] <= t] if b.least <= m.sum() <= 60 - b.least), key=lambda v: (round(v[0], 9), -v[1], -v[2]))
    gain, j, t = b.split(x, g, h)
    assert abs(gain - slow[0]) < 1e-9 and j == slow[1] and ((x[:, j] <= t) == (x[:, j] <= slow[2])).all()
    deviance = lambda mu: (mu - y * np.log(mu)).sum()
    fitted = b.fit(x, y)
    assert deviance(fitted.predict(x)) < deviance(np.full(60, y.mean())) - 5
    assert stack.Booster().fit(x, np.zeros(60)).predict(x).max() < 1e-3
    assert np.allclose(stack.Booster().fit(x[:1], np.array([3.0])).predict(x[:1]), 3.0)


def test_each_group_has_its_own_model_or_the_global_one(spark):
    rng = random.Random(4)
    data = [(g, t, float(t % 2), (20.0 if (g == "a") == (t % 2 == 0) else 2.0) + rng.random(), t < 40, 7.0) for g in "ab" for t in range(50)]
    data += [("few", t, float(t % 2), 1.0, t < 5, 7.0) for t in range(8)] + [("none", 1, None, None, True, 7.0), (None, 1, 0.0, 1.0, False, 7.0)]
    df = spark.createDataFrame(data, "g string, t int, odd double, y double, is_train boolean, glob double")
    got = stack.per_group(df, ["g"], "y", ["odd"], "is_train", "glob")
    by = {(r["g"], r["t"]): r for r in got.collect()}
    assert set(by) == {(g, t) for g in "ab" for t in range(40, 50)} | {("few", t) for t in (5, 6, 7)} | {(None, 1)}
    assert all(abs(by[g, t]["predicted"] - by[g, t]["y"]) < 3 and by[g, t]["source"] == "own" for g in "ab" for t in range(40, 50))
    assert all(by[k]["predicted"] == 7.0 and by[k]["source"] == "global" and by[k]["own"] is None for k in (("few", 6), (None, 1)))
    assert stack.per_group(df.filter(F.lit(False)), ["g"], "y", ["odd"], "is_train", "glob").collect() == []


def test_models_of_the_stack_are_fitted_at_a_time(spark, monkeypatch):
    import threading
    import time

    rows = spark.createDataFrame([(k, float(k % 7), float(k % 7)) for k in range(60)], "k int, x double, y double")
    fit, lock, now, most = stack.fit_base, threading.Lock(), [0], [0]

    def slow(*a):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.3)
        try:
            return fit(*a)
        finally:
            with lock:
                now[0] -= 1

    monkeypatch.setattr(stack, "fit_base", slow)
    many, held = stack.fit_stack(rows, ["k"], "y", [], ["x"], kinds=("poisson", "forest"), folds=2)
    assert 1 < most[0] <= 4 and [len(many.bases[k]) for k in ("poisson", "forest")] == [2, 2]
    monkeypatch.undo()
    _, alone = stack.fit_stack(rows, ["k"], "y", [], ["x"], kinds=("poisson", "forest"), folds=2, parallelism=1)
    one, two = ({r["k"]: r["by_poisson"] for r in h.collect()} for h in (held, alone))  # bagging depends on the files' order
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)
