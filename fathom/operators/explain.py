"""Shapley values of boosted trees: how much each column moves a row's prediction from the mean.

A coalition's worth is the trees' expectation when only its columns are known: at a split on an unknown column both sides
count by the training rows that went there. A leaf then contributes a product over the columns on its path, and the
Shapley value of a product needs only the sums over coalition sizes, so values are exact and take time linear in leaves."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


class Test(NamedTuple):
    """What a leaf asks of one column: a value in (low, high], or one of some categories; and the share of training rows
    that stay on the path at this column's splits."""

    feature: int
    low: float
    high: float
    allowed: tuple[float, ...] | None
    share: float

    def passed(self, x: np.ndarray) -> np.ndarray:
        return np.isin(x, self.allowed) if self.allowed is not None else (x > self.low) & (x <= self.high)


class Leaf(NamedTuple):
    value: float
    tests: tuple[Test, ...]


def leaves(model: Any) -> list[Leaf]:
    """The leaves of a fitted tree ensemble with their values by the tree's weight, read on the driver: as many as the
    model has, whatever the table's size."""
    out: list[Leaf] = []

    def walk(node: Any, weight: float, tests: dict[int, Test]) -> None:
        if node.subtreeDepth() == 0:
            out.append(Leaf(weight * node.prediction(), tuple(tests.values())))
            return
        split, here = node.split(), float(node.impurityStats().count())
        j = split.featureIndex()
        old = tests.get(j, Test(j, -np.inf, np.inf, None, 1.0))
        for left, child in ((True, node.leftChild()), (False, node.rightChild())):
            share = old.share * float(child.impurityStats().count()) / here
            if split.getClass().getSimpleName() == "CategoricalSplit":
                named = tuple(split.leftCategories() if left else split.rightCategories())
                new = old._replace(share=share, allowed=named if old.allowed is None else tuple(c for c in named if c in old.allowed))
            else:
                t = split.threshold()
                new = old._replace(share=share, high=min(old.high, t)) if left else old._replace(share=share, low=max(old.low, t))
            walk(child, weight, tests | {j: new})

    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        walk(tree._java_obj.rootNode(), float(weight), {})
    return out


def base(found: Sequence[Leaf]) -> float:
    """The worth of knowing nothing: the mean over training rows."""
    return float(sum(leaf.value * np.prod([t.share for t in leaf.tests]) for leaf in found))


def values(found: Sequence[Leaf], x: np.ndarray) -> np.ndarray:
    """One Shapley value for each row and column of ``x``."""
    out = np.zeros(x.shape)
    for leaf in found:
        m = len(leaf.tests)
        passed = [t.passed(x[:, t.feature]).astype(float) for t in leaf.tests]
        odds = [factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)]
        for j, own in enumerate(leaf.tests):
            # sums of products over the coalitions of the other columns, by coalition size
            by_size = [np.ones(len(x))] + [np.zeros(len(x)) for _ in range(m - 1)]
            for i, other in enumerate(leaf.tests):
                if i != j:
                    for k in range(m - 1, 0, -1):
                        by_size[k] = by_size[k] * other.share + by_size[k - 1] * passed[i]
                    by_size[0] = by_size[0] * other.share
            out[:, own.feature] += leaf.value * (passed[j] - own.share) * sum(w * s for w, s in zip(odds, by_size, strict=True))
    return out


def attributed(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with prediction, base and contributions (one for each input column of the model, in its order), which add
    up to the prediction. Rows are worked on where they lie, in batches; nothing is shuffled or sampled."""
    trees = model.stages[-1]
    found = leaves(trees)
    mean = base(found)
    scored = model.transform(df).withColumn("_x", vector_to_array(trees.getFeaturesCol())).select(*df.columns, "prediction", "_x")
    names = [*df.columns, "prediction"]
    schema = scored.drop("_x").schema.add("base", "double").add("contributions", ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            flat = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            phi = values(found, flat.reshape(b.num_rows, -1))
            edge = pa.array(np.arange(b.num_rows + 1) * phi.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.full(b.num_rows, mean)), pa.ListArray.from_arrays(edge, pa.array(phi.ravel()))], [*names, "base", "contributions"])

    return scored.mapInArrow(run, schema)


def top(rows: DataFrame, columns: Sequence[str], most: int = 25) -> DataFrame:
    """(place, feature, strength, mean, n): the columns that move predictions most, by mean absolute contribution."""
    flat = rows.select(F.posexplode("contributions").alias("i", "v"))
    by = flat.groupBy("i").agg(F.avg(F.abs("v")).alias("strength"), F.avg("v").alias("mean"), F.count("*").alias("n"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)
    first = by.select(name.alias("feature"), "strength", "mean", "n").orderBy(F.desc("strength"), "feature").limit(most)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("strength")).alias("k"), "feature", "mean", "n")))
    return first.agg(ranked.alias("a")).select(F.posexplode("a").alias("i", "x")).select((F.col("i") + 1).alias("place"), "x.feature", (-F.col("x.k")).alias("strength"), "x.mean", "x.n")
