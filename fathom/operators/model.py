"""Models: global and per-group forecasts, clustering of vectors, random walks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler, Word2Vec
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.sources.files import stored


def frame(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    """Stages that turn columns into one vector; categories are numbered by frequency, unseen ones have their own."""
    index = [StringIndexer(inputCol=c, outputCol=f"_{c}", handleInvalid="keep") for c in categorical]
    return [*index, VectorAssembler(inputCols=[f"_{c}" for c in categorical] + list(numeric), outputCol="features", handleInvalid="keep")]


def fit_global(train: DataFrame, target: str, categorical: Sequence[str], numeric: Sequence[str], kind: str = "gbt") -> PipelineModel:
    """Boosted trees, or a Poisson or Tweedie regression, over all groups."""
    if kind == "gbt":
        model = GBTRegressor(labelCol=target, maxIter=20, maxDepth=4, maxBins=64, seed=7)
    elif kind == "poisson":
        model = GeneralizedLinearRegression(labelCol=target, family="poisson", link="log", regParam=0.1)
    else:
        model = GeneralizedLinearRegression(labelCol=target, family="tweedie", variancePower=1.5, linkPower=0.0, regParam=0.1)
    return Pipeline(stages=[*frame(categorical, numeric), model]).fit(train.withColumn(target, F.col(target).cast("double")))


def predict(model: PipelineModel, df: DataFrame, whole: bool = False) -> DataFrame:
    """With ``predicted``, never negative, rounded if asked."""
    out = F.greatest(F.col("prediction"), F.lit(0.0))
    return model.transform(df).withColumn("predicted", F.round(out) if whole else out).select(*df.columns, "predicted")


def two_phase(model: PipelineModel, df: DataFrame, keys: Sequence[str], horizon: str, bridge: str) -> DataFrame:
    """Horizons 0 and 1 first; their mean prediction is the bridge feature of the later ones."""
    near = predict(model, df.filter(F.col(horizon) <= 1))
    means = near.groupBy(*keys).agg(F.avg("predicted").alias("_bridge"))
    late = df.filter(F.col(horizon) > 1).join(means, list(keys), "left").withColumn(bridge, F.coalesce("_bridge", F.col(bridge))).drop("_bridge")
    return near.unionByName(predict(model, late))


def per_group_trend(train: DataFrame, keys: Sequence[str], t: str, value: str, ahead: Sequence[int]) -> DataFrame:
    """(keys, t, predicted): a seasonal level with a damped trend for each group, each fitted in a task of its own.

    A group is one series of months, so its size is bounded by the calendar, not by the number of orders."""
    schema = train.select(*keys, t).schema.add("predicted", "double")

    def one(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(t)
        x, y = f[t].to_numpy(float), f[value].to_numpy(float)
        slope = float(np.polyfit(x[-12:], y[-12:], 1)[0]) if len(x) >= 6 else 0.0
        out = []
        for a in ahead:
            same = y[np.isclose((x - a) % 12, 0)]
            level = same[-2:].mean() if len(same) else y[-3:].mean()
            out.append({**{k: f[k].iloc[0] for k in keys}, t: a, "predicted": max(0.0, level + 0.5 * slope)})
        return pd.DataFrame(out)

    return train.select(*keys, t, value).groupBy(*keys).applyInPandas(one, schema)


def importance(model: PipelineModel, df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """(feature, loss): by how much the squared error grows when a column is replaced by its mean."""
    spark = df.sparkSession
    error = lambda d: model.transform(d).agg(F.avg((F.col("prediction") - F.col(target)) ** 2)).first()[0]
    base = error(df)
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return spark.createDataFrame([(c, float(error(df.withColumn(c, F.lit(float(means[c])))) - base)) for c in columns], "feature string, loss double")


def cluster_vectors(df: DataFrame, vector: str, options: Sequence[int], seed: int = 7) -> tuple[DataFrame, int]:
    """``df`` with ``cluster`` from k-means, the number of clusters being that of best silhouette; unit vectors."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    unit = df.withColumn("_f", array_to_vector(F.transform(vector, lambda x: (x / norm).cast("double"))))
    unit = stored(unit)
    best = None
    for k in options:
        model = KMeans(k=k, seed=seed, featuresCol="_f", predictionCol="cluster", maxIter=15).fit(unit)
        out = model.transform(unit)
        score = ClusteringEvaluator(featuresCol="_f", predictionCol="cluster").evaluate(out)
        if best is None or score > best[0]:
            best = (score, k, out)
    return best[2].drop("_f"), best[1]


def medoids(df: DataFrame, key: str, vector: str, cluster: str = "cluster") -> DataFrame:
    """(cluster, key) of the row nearest to its cluster's mean; the smallest key of equals."""
    flat = df.select(cluster, F.posexplode(vector).alias("i", "x")).groupBy(cluster, "i").agg(F.avg("x").alias("m"))
    mean = flat.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("_mean"))
    far = F.aggregate(F.zip_with(vector, "_mean", lambda a, b: (a - b) * (a - b)), F.lit(0.0).cast("double"), lambda s, x: s + x)
    return df.join(mean, cluster).groupBy(cluster).agg(F.min_by(key, F.struct(F.round(far, 9), key)).alias(key))


def walks(edges: DataFrame, weight: str, length: int, per_node: int, seed: int = 7, p: float = 1.0, q: float = 1.0) -> DataFrame:
    """(node, walk): weighted random walks by joins, the next step being that of smallest -ln(u) / weight.

    A step back to the node before has its weight divided by ``p``, one to a node that is no neighbour of it by ``q``."""
    both = edges.select("a", "b", weight).union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), weight))
    tied = both.select(F.col("a").alias("_before"), "b", F.lit(True).alias("_tied")).distinct()
    now = both.select(F.col("a").alias("node")).distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(per_node)))).withColumn("walk", F.array("node"))
    for step in range(length - 1):
        draw = (F.pmod(F.xxhash64("node", "k", "b", F.lit(step), F.lit(seed)), F.lit(1_000_003)) + 1) / 1_000_004.0
        moves, odds = now.withColumn("a", F.element_at("walk", -1)).join(both, "a"), F.col(weight).cast("double")
        if step and (p != 1 or q != 1):
            moves = moves.withColumn("_before", F.element_at("walk", -2)).join(tied, ["_before", "b"], "left")
            odds = odds / F.when(F.col("b") == F.col("_before"), p).when(F.col("_tied"), 1.0).otherwise(q)
        moves = moves.withColumn("_r", -F.log(draw) / odds)
        now = moves.groupBy("node", "k", "walk").agg(F.min_by("b", F.struct("_r", "b")).alias("b")).select("node", "k", F.concat("walk", F.array("b")).alias("walk"))
    return now.select("node", "walk")


def embed(walked: DataFrame, size: int = 32, window: int = 10, seed: int = 7) -> DataFrame:
    """(node, vector) learned from walks as if they were sentences."""
    return Word2Vec(vectorSize=size, windowSize=window, minCount=1, seed=seed, inputCol="walk", outputCol="_v").fit(walked).getVectors().toDF("node", "vector")
