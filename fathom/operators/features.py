"""Correlation over many columns, columns that repeat others, codes by first appearance, and columns known in advance."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.operators.aggregate import running

_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, pearson, n) for each pair of columns in their order, over the rows where both are there; null where one of
    them does not vary.

    One pass: every task adds up the products of all columns at once, centred on the columns' means for exactness, and
    the sums of a few numbers for each pair are merged. Nulls and numbers that are not finite take no part."""
    clean = [F.when(F.abs(F.col(f"`{c}`").cast("double")) < F.lit(float("inf")), F.col(f"`{c}`").cast("double")) for c in columns]
    mean = df.agg(*[F.avg(c) for c in clean]).first()
    centred = df.select(*[(c - F.lit(m if m is not None else 0.0)).alias(f"c{i}") for i, (c, m) in enumerate(zip(clean, mean, strict=True))])
    k = len(columns)
    up = np.triu_indices(k, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns]) if b.num_rows else np.zeros((0, k))
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
        yield pa.RecordBatch.from_arrays([pa.array(up[0], pa.int32()), pa.array(up[1], pa.int32()), *[pa.array(t[up]) for t in total]], ["i", "j", *_SUMS])

    sums = centred.mapInArrow(run, "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS)).groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])
    vx, vy = (F.col(f"s{v}{v}") - F.col(f"s{v}") * F.col(f"s{v}") / F.col("n") for v in "xy")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    tiny = 1e-12  # of the squares' sum: what rounding leaves of a constant
    varies = (vx > tiny * F.col("sxx")) & (vy > tiny * F.col("syy")) & (F.col("n") > 1)
    name = lambda at: F.element_at(F.array(*[F.lit(c) for c in columns]), F.col(at) + 1)
    return sums.select(name("i").alias("a"), name("j").alias("b"), F.when(varies, cov / F.sqrt(vx * vy)).alias("pearson"), F.col("n").cast("long").alias("n"))


def uncorrelated(pairs: DataFrame, columns: Sequence[str], bound: float) -> list[str]:
    """The columns that stay when each, in order, goes if it correlates above the bound with one that stays. The pairs
    are as many as columns squared."""
    tied = {frozenset((r["a"], r["b"])) for r in pairs.filter(F.abs("pearson") > bound).collect()}
    kept: list[str] = []
    for c in columns:
        if not any(frozenset((c, k)) in tied for k in kept):
            kept.append(c)
    return kept


def first_seen(df: DataFrame, column: str, order: str) -> DataFrame:
    """(column, first, code): values numbered from 0 by the least ``order`` they appear at, a number that no two values
    share. Values are grouped first; the running count goes by ranges, so nothing is sorted in one task. Null is a value
    like others; rows with a null order take no part."""
    first = df.filter(F.col(order).isNotNull()).groupBy(column).agg(F.min(order).alias("first")).withColumn("_one", F.lit(1))
    return running(first, "first", "_one").select(column, "first", (F.col("upto") - 1).cast("long").alias("code"))


def known_in_advance(df: DataFrame, keys: Sequence[str], dates: Sequence[str], quantity: Sequence[str] = ()) -> DataFrame:
    """The rows to forecast with the columns that are known then: the keys, dates and quantities named here. A key that
    the table lacks is an error."""
    absent = [c for c in keys if c not in df.columns]
    if absent:
        raise ValueError(f"missing keys: {', '.join(absent)}")
    return df.select(*[c for c in df.columns if c in {*keys, *dates, *quantity}])


def refuse_leaks(features: Sequence[str], known: Sequence[str], derived: Sequence[str]) -> None:
    """An error that names every feature that is neither known in advance nor derived from the past."""
    leaks = [f for f in features if f not in {*known, *derived}]
    if leaks:
        raise ValueError(f"not known when forecasting: {', '.join(leaks)}")
