"""An ensemble by stacking, and a full model for each group.

Stacking: every base model is fitted once for each fold, without that fold; what it says of the fold it has not seen is
the second level's only input. New rows get the mean of a base model's fold models, weighted by the second level."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.util import inheritable_thread_target

from fathom.operators import model
from fathom.sources.files import stored


class Stack(NamedTuple):
    bases: dict[str, list[PipelineModel]]  # a model for each fold
    weights: dict[str, float]


def fit_base(train: DataFrame, target: str, categorical: Sequence[str], numeric: Sequence[str], kind: str) -> PipelineModel:
    """One of gbt, poisson, tweedie (``model.fit_global``) or forest."""
    if kind != "forest":
        return model.fit_global(train, target, categorical, numeric, kind)
    trees = RandomForestRegressor(labelCol=target, numTrees=20, maxDepth=6, maxBins=64, seed=7)
    return Pipeline(stages=[*model.frame(categorical, numeric), trees]).fit(train.withColumn(target, F.col(target).cast("double")))


def _said(fitted: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    return model.predict(fitted, df).withColumnRenamed("predicted", name)


def simplex_weights(gram: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """The weights that are not negative, add up to 1 and make w'Gw - 2w'c least: every support is solved by itself, so
    the answer is exact for a few models. A single model is one of the choices, so none is better than the whole."""
    k, best = len(cross), (np.inf, np.zeros(len(cross)))
    for size in range(1, k + 1):
        for own in map(list, combinations(range(k), size)):
            edge = np.zeros((size + 1, size + 1))
            edge[:size, :size], edge[size, :size], edge[:size, size] = 2 * gram[np.ix_(own, own)], 1, 1
            w = np.zeros(k)
            w[own] = np.linalg.lstsq(edge, np.append(2 * cross[own], 1), rcond=None)[0][:size]
            loss = w @ gram @ w - 2 * w @ cross
            if (w >= -1e-12).all() and abs(w.sum() - 1) < 1e-6 and loss < best[0] - 1e-12:
                best = (loss, np.maximum(w, 0))
    return best[1]


def fit_stack(train: DataFrame, keys: Sequence[str], target: str, categorical: Sequence[str], numeric: Sequence[str], kinds: Sequence[str] = ("gbt", "poisson", "forest"), folds: int = 5, parallelism: int = 8) -> tuple[Stack, DataFrame]:
    """The stack, and the rows with their ``fold`` and what each base model says of them without having seen them.

    A row's fold is a hash of its keys, so it is the same in every run. The second level sees sums of products over those
    columns alone, a few numbers. Rows with a null target are left out. The models do not depend on each other:
    ``parallelism`` of them are fitted at a time, as their many small jobs leave most cores idle one by one."""
    rows = stored(train.filter(F.col(target).isNotNull()).withColumn("fold", F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int")))
    one = lambda x: fit_base(rows.filter(F.col("fold") != x[1]), target, categorical, numeric, x[0])
    with ThreadPool(max(1, min(parallelism, folds * len(kinds)))) as pool:
        fitted = pool.map(inheritable_thread_target(rows.sparkSession)(one), list(product(kinds, range(folds))), 1)
    bases: dict[str, list[PipelineModel]] = {k: fitted[i * folds : (i + 1) * folds] for i, k in enumerate(kinds)}
    held: list[DataFrame] = []
    for fold in range(folds):
        part = rows.filter(F.col("fold") == fold)
        for kind in kinds:
            part = _said(bases[kind][fold], part, f"by_{kind}")
        held.append(part)
    out = held[0]
    for h in held[1:]:
        out = out.unionByName(h)
    out = stored(out)
    names = [f"by_{k}" for k in kinds]
    sums = out.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}*{b}") for a in names for b in [*names, target]]).first()
    gram = np.array([[sums[f"{a}*{b}"] or 0.0 for b in names] for a in names], float)
    weights = simplex_weights(gram, np.array([sums[f"{a}*{target}"] or 0.0 for a in names], float))
    return Stack(bases, dict(zip(kinds, map(float, weights), strict=True))), out


def predict_stack(stack: Stack, df: DataFrame) -> DataFrame:
    """``df`` with by_<kind> for each base model, the mean of its fold models, and ``predicted``."""
    out, made = df, []
    for kind, fitted in stack.bases.items():
        names = [f"_{kind}{i}" for i in range(len(fitted))]
        for name, one in zip(names, fitted, strict=True):
            out = _said(one, out, name)
        out = out.withColumn(f"by_{kind}", sum(F.col(n) for n in names) / len(names)).drop(*names)
        made.append(F.col(f"by_{kind}") * stack.weights[kind])
    return out.withColumn("predicted", sum(made, F.lit(0.0)))


class Booster:
    """Poisson gradient boosting of small trees on a small table: exact splits, log link."""

    def __init__(self, rounds: int = 60, depth: int = 2, rate: float = 0.1, least: int = 4, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.least, self.ridge = rounds, depth, rate, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> Booster:
        self.start = float(np.log(max(y.mean(), 1e-6)))
        self.trees: list = []
        f = np.full(len(y), self.start)
        for _ in range(self.rounds):
            mu = np.exp(np.clip(f, -30, 30))
            tree = self._grow(x, mu - y, mu, np.arange(len(y)), self.depth)
            if not isinstance(tree, tuple):
                break
            self.trees.append(tree)
            f = f + self.rate * _walk(tree, x)
        return self

    def split(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, float] | None:
        """The gain, column and bound of the best cut; the first column and bound of equals."""
        score = lambda a, b: a * a / (b + self.ridge)
        best = None
        for j in range(x.shape[1]):
            order = np.argsort(x[:, j], kind="stable")
            v, gs, hs = x[order, j], np.cumsum(g[order]), np.cumsum(h[order])
            at = np.flatnonzero(v[:-1] < v[1:])
            at = at[(at + 1 >= self.least) & (len(v) - at - 1 >= self.least)]
            if len(at):
                gain = score(gs[at], hs[at]) + score(gs[-1] - gs[at], hs[-1] - hs[at]) - score(gs[-1], hs[-1])
                k = int(np.argmax(gain))
                if best is None or gain[k] > best[0] + 1e-12:
                    best = (float(gain[k]), j, float((v[at[k]] + v[at[k] + 1]) / 2))
        return best if best and best[0] > 1e-9 else None

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> tuple | float:
        cut = self.split(x[rows], g[rows], h[rows]) if depth else None
        if cut is None:
            return float(-g[rows].sum() / (h[rows].sum() + self.ridge))
        left = x[rows, cut[1]] <= cut[2]
        return cut[1], cut[2], self._grow(x, g, h, rows[left], depth - 1), self._grow(x, g, h, rows[~left], depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.start)
        for tree in self.trees:
            f = f + self.rate * _walk(tree, x)
        return np.exp(np.clip(f, -30, 30))


def _walk(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    j, bound, left, right = tree
    return np.where(x[:, j] <= bound, _walk(left, x), _walk(right, x))


def per_group(df: DataFrame, keys: Sequence[str], target: str, numeric: Sequence[str], train: str, fallback: str, least_rows: int = 24) -> DataFrame:
    """The rows of ``df`` that are not marked by the column ``train``, with ``own``, ``predicted`` and ``source``.

    Each group that has ``least_rows`` training rows gets a booster of its own, fitted in one task; a group is one series
    of months, so its size is bounded by the calendar. Other groups take the global model's ``fallback`` column. Null
    features count as 0; training rows with a null target are left out; a group without rows to predict gives none."""
    add = [StructField("own", DoubleType())]

    def one(pair: pd.DataFrame) -> pd.DataFrame:
        marked = pair[train].fillna(False).to_numpy(bool)
        old, new = pair[marked & pair[target].notna().to_numpy()], pair[~marked].copy()
        x = lambda f: f[list(numeric)].fillna(0).to_numpy(float)
        enough = len(old) >= least_rows and len(new)
        new["own"] = Booster().fit(x(old), old[target].to_numpy(float)).predict(x(new)) if enough else np.nan
        return new

    told = df.groupBy(*keys).applyInPandas(one, StructType([*df.schema.fields, *add]))
    own = F.when(~F.isnan("own"), F.col("own"))
    return told.withColumn("own", own).withColumn("predicted", F.coalesce("own", fallback)).withColumn("source", F.when(F.col("own").isNull(), "global").otherwise("own")).drop(train)
