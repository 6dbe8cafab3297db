"""Mini-batch k-means against full k-means and a plain silhouette."""

import os

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fathom.operators import minibatch

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_cost_is_near_full_k_means(spark):
    e = spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding")
    out, told = minibatch.cluster(e, "vec_id", "embedding", [4, 12, 20], batch=100)
    x = e.select(array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("features"))
    got = {r["k"]: r for r in told.collect()}
    assert set(got) == {4, 12, 20}
    for k, r in got.items():
        assert r["cost"] <= 1.02 * min(KMeans(k=k, seed=s, maxIter=20).fit(x).summary.trainingCost for s in (1, 2))
    best = max(got.values(), key=lambda r: (r["silhouette"], -r["k"]))["k"]
    rows = out.collect()
    assert len(rows) == e.count() and {r["cluster"] for r in rows} <= set(range(best))


def test_silhouette_equals_a_plain_one():
    rng = np.random.default_rng(5)
    x, at = rng.normal(size=(30, 3)), rng.integers(0, 4, 30)
    at[0] = 9
    s = []
    for i in range(30):
        d = ((x - x[i]) ** 2).sum(1)
        own = (at == at[i]) & (np.arange(30) != i)
        a, b = d[own].mean() if own.any() else 0, min(d[at == k].mean() for k in set(at.tolist()) - {int(at[i])})
        s.append((b - a) / max(a, b) if own.any() else 0.0)
    assert abs(minibatch.silhouette(x, at) - np.mean(s)) < 1e-9


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 5), (2, None, 5), (3, [1.0, None], 5), (4, [], 5), (5, [9.0, 9.0], 5), (5, [9.0, 9.0], 5)], "id int, v array<double>, cluster_ int")
    out, told = minibatch.cluster(df, "id", "v", [2, 50])
    got = sorted((r["id"], r["cluster"] is None) for r in out.collect())
    assert got == [(1, False), (2, True), (3, True), (4, True), (5, False), (5, False)] and [r["k"] for r in told.collect()] == [2]
    out, told = minibatch.cluster(df.filter("id = 2"), "id", "v", [2])
    assert [r["cluster"] for r in out.collect()] == [None] and told.collect() == []
