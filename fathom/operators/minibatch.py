"""Mini-batch k-means for every number of clusters of a range at once, chosen by silhouette on a bounded sample.

Rows are dealt to stored batches by a hash. A batch moves each centre towards the mean of the rows nearest to it, the
less the more rows the centre has seen. Tasks give sums for each centre, so the driver sees numbers of the size of the
centres alone. Last passes over all rows put each centre at the mean of its rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.sources.files import stored

Centres = dict[int, np.ndarray]


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, 0))


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)


def _sums(df: DataFrame, centres: Centres) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For each k the count and sum of the rows of each centre, and the squared distance of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {k: np.zeros(k) for k in centres}
        total = {k: np.zeros_like(c) for k, c in centres.items()}
        cost = dict.fromkeys(centres, 0.0)
        for b in batches:
            x = _matrix(b.column(0), b.num_rows)
            for k, c in centres.items() if len(x) else ():
                at = _nearest(x, c)
                count[k] += np.bincount(at, minlength=k)
                np.add.at(total[k], at, x)
                cost[k] += float(((x - c[at]) ** 2).sum())
        rows = [(k, i, count[k][i], total[k][i].tolist(), cost[k] if i == 0 else 0.0) for k in centres for i in range(k)]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.float64()), strict=True)], ["k", "i", "n", "s", "cost"])

    parts = df.select("v").mapInArrow(run, "k int, i int, n double, s array<double>, cost double")
    flat = parts.select("k", "i", "n", "cost", F.posexplode("s").alias("at", "x")).groupBy("k", "i", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"), F.sum("cost").alias("cost"))
    out = {k: (np.zeros(k), np.zeros_like(c), 0.0) for k, c in centres.items()}
    for r in flat.collect():  # as many numbers as the centres have
        n, s, cost = out[r["k"]]
        n[r["i"]], s[r["i"], r["at"]] = r["n"], r["x"]
        if r["i"] == 0 and r["at"] == 0:
            out[r["k"]] = (n, s, r["cost"])
    return out


def _spread(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """First centres: rows far from those chosen before are likelier."""
    chosen = [x[rng.integers(len(x))]]
    far = ((x - chosen[0]) ** 2).sum(1)
    while len(chosen) < k:
        odds = far / far.sum() if far.sum() else np.full(len(x), 1 / len(x))
        chosen.append(x[rng.choice(len(x), p=odds)])
        far = np.minimum(far, ((x - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


def silhouette(x: np.ndarray, at: np.ndarray) -> float:
    """The mean silhouette of a sample by squared distance; a cluster of one counts 0."""
    d = np.maximum((x * x).sum(1)[:, None] + (x * x).sum(1) - 2 * x @ x.T, 0)
    kinds = np.unique(at)
    if len(kinds) < 2:
        return -1.0
    mean = np.stack([d[:, at == k].sum(1) for k in kinds], 1)
    size = np.array([(at == k).sum() for k in kinds])
    own = np.searchsorted(kinds, at)
    rows = np.arange(len(x))
    inside = mean[rows, own] / np.maximum(size[own] - 1, 1)
    other = mean / size
    other[rows, own] = np.inf
    outside = other.min(1)
    s = (outside - inside) / np.maximum(np.maximum(inside, outside), 1e-300)
    return float(np.where(size[own] > 1, s, 0.0).mean())


def cluster(df: DataFrame, key: str, vector: str, ks: Sequence[int], batch: int = 4096, rounds: int = 40, passes: int = 3, sample: int = 1000, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(rows with ``cluster``, table of (k, silhouette, cost)): the k of best silhouette, the smaller of equals.

    ``batch`` rows at a time, ``rounds`` batches at most, then ``passes`` over all rows. First centres and silhouettes
    come from ``sample`` rows of least hash, a documented bound. Rows whose vector is null, empty or holds nulls have a
    null cluster. Numbers of clusters past the sample's different rows are left out; without any left, all are null."""
    spark = df.sparkSession
    fit = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(F.coalesce(F.col(vector), F.array().cast(df.schema[vector].dataType)), lambda x: x.isNull())
    rows = stored(df.filter(fit).select(F.col(key).alias("key"), F.transform(vector, lambda x: x.cast("double")).alias("v")))
    n = rows.count()
    many = max(1, n // batch)
    dealt = stored(rows.withColumn("batch", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(many)).cast("int"))) if many > 1 else rows.withColumn("batch", F.lit(0))
    few = np.array([r["v"] for r in rows.orderBy(F.xxhash64("key", F.lit(seed + 1)), "key").limit(sample).collect()], float)
    rng = np.random.default_rng(seed)
    fits = [k for k in sorted(set(ks)) if len(few) and k <= len(np.unique(few, axis=0))]
    if not fits:
        return df.withColumn("cluster", F.lit(None).cast("int")), spark.createDataFrame([], "k int, silhouette double, cost double")
    centres = {k: _spread(few, k, rng) for k in fits}
    seen = {k: np.zeros(k) for k in fits}
    for i in range(rounds if many > 1 else 0):
        for k, (count, total, _) in _sums(dealt.filter(F.col("batch") == i % many), centres).items():
            seen[k] += count
            centres[k] = centres[k] + (total - count[:, None] * centres[k]) / np.maximum(seen[k], 1)[:, None]
    for _ in range(passes):
        for k, (count, total, _) in _sums(rows, centres).items():
            centres[k] = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres[k])
    told = [(k, silhouette(few, _nearest(few, centres[k])), cost) for k, (_, _, cost) in sorted(_sums(rows, centres).items())]
    best = max(told, key=lambda r: (r[1], -r[0]))[0]
    own = centres[best]
    kind = df.schema[key].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_nearest(_matrix(b.column(1), b.num_rows), own), pa.int32())], ["key", "cluster"])

    placed = rows.mapInArrow(place, f"key {kind}, cluster int").withColumnRenamed("key", key)
    return df.join(placed.distinct(), key, "left"), spark.createDataFrame(told, "k int, silhouette double, cost double")
