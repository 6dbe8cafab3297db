"""Queries of models, readers and streams. They have no SQL oracle where a model or a stream is involved."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.functions.dates import month_of_column
from fathom.operators import explain, graph, minibatch, model, series, stack
from fathom.plans.adapt import load, query
from fathom.plans.q_graph import pairs_lt
from fathom.plans.q_series import KEYS, monthly
from fathom.sources.files import stored


def _features(spark: SparkSession, d: str) -> DataFrame:
    """(bu, cluster, t, target and features of the months before) for the spine's months."""
    s = series.growth(series.moving_averages(monthly(spark, d), KEYS), KEYS)
    w = Window.partitionBy(*KEYS).orderBy("t")
    lagged = s.withColumns({c: F.lag(c).over(w) for c in s.columns if c not in (*KEYS, "t", "value")})
    aged = lagged.withColumn("_n", F.row_number().over(w)).filter("_n > 13").drop("_n")
    return aged.withColumn("month", F.pmod("t", F.lit(12)).cast("string")).withColumnRenamed("value", "target")


def _last(f: DataFrame) -> int:
    return f.agg(F.max("t")).first()[0]


NUMERIC = ["sma_3m", "wma_3m", "sma_6m", "sma_12m", "demand_growth_3m", "demand_growth_6m"]


@query("global_forecast")
def global_forecast(spark: SparkSession, d: str) -> DataFrame:
    f = stored(_features(spark, d))
    last = _last(f)
    m = model.fit_global(f.filter(F.col("t") < last - 6), "target", ["bu", "cluster", "month"], NUMERIC)
    return model.predict(m, f.filter(F.col("t") >= last - 6), whole=True).select(*KEYS, "t", "target", "predicted")


@query("two_phase_forecast")
def two_phase_forecast(spark: SparkSession, d: str) -> DataFrame:
    f = stored(_features(spark, d))
    last = _last(f)
    m = model.fit_global(f.filter(F.col("t") < last - 6), "target", ["bu", "month"], NUMERIC, "poisson")
    test = f.filter(F.col("t").between(last - 6, last - 1)).withColumn("h", F.col("t") - (last - 6))
    return model.two_phase(m, test, KEYS, "h", "sma_3m").select(*KEYS, "h", "predicted")


@query("per_group_forecast")
def per_group_forecast(spark: SparkSession, d: str) -> DataFrame:
    s = stored(monthly(spark, d))
    last = _last(s)
    s = s.filter(F.col("t") < last - 6)
    return model.per_group_trend(s, KEYS, "t", "value", range(last - 6, last))


@query("feature_importance")
def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    f = stored(_features(spark, d))
    return model.importance(model.fit_global(f, "target", ["bu"], NUMERIC, "poisson"), f, "target", NUMERIC)


@query("vector_clusters")
def vector_clusters(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "embeddings").select("vec_id", "embedding")
    out, _ = model.cluster_vectors(e, "embedding", [5, 10])
    return model.medoids(out, "vec_id", "embedding")


def _unit(spark: SparkSession, d: str) -> DataFrame:
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    return load(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x / norm).alias("embedding"))


@query("vector_clusters_minibatch")
def vector_clusters_minibatch(spark: SparkSession, d: str) -> DataFrame:
    """Every vector's cluster, the number of clusters chosen from a range, and whether it is its cluster's medoid."""
    out = stored(minibatch.cluster(_unit(spark, d), "vec_id", "embedding", range(10, 81, 14), batch=512)[0])
    middle = model.medoids(out.filter("cluster IS NOT NULL"), "vec_id", "embedding")
    return out.join(middle.select("vec_id", F.lit(True).alias("is_medoid")), "vec_id", "left").select("vec_id", "cluster", F.coalesce("is_medoid", F.lit(False)).alias("is_medoid"))


@query("skill_embedding")
def skill_embedding(spark: SparkSession, d: str) -> DataFrame:
    e = graph.strongest(pairs_lt(spark, d), "n", 9)
    v = model.embed(stored(model.walks(e, "n", 8, 4, q=1.5)), size=8, window=4)
    return v.select("node", vector_to_array("vector").alias("vector"))


@query("csv_round_trip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    from fathom.sources import files

    path = f"{files.scratch(spark)}/csv-{uuid.uuid4().hex}"
    files.write_csv(load(spark, d, "nation"), path)
    return files.read_csv(spark, path, ["n_nationkey", "n_name", "n_regionkey"], "n_nationkey int, n_name string, n_regionkey int")


@query("event_stream_counts", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def event_stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """The events read as a stream, counted, and the final state read as a table."""
    from fathom.streaming import demand

    e = load(spark, d, "events")
    folder = f"{d}/events.parque*"  # a pattern, so that a single file is a folder's content
    schema = ", ".join(f"`{c}` {t}" for c, t in e.dtypes)
    source = demand.events(spark, folder, schema)
    name = "fathom_events"
    q = source.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


@query("uplf_unpivot", "SELECT c_custkey, unnest([24290, 24291, 24292]) AS t, unnest([c_acctbal, c_acctbal + 1, c_acctbal + 2]) AS value FROM customer")
def uplf_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """Wide month columns, named like Mar-24_Forecast, as rows by month index."""
    c = load(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("Mar-24_Forecast"), (F.col("c_acctbal") + 1).alias("Apr-24_Forecast"), (F.col("c_acctbal") + 2).alias("May-24_Forecast"))
    found = {n: month_of_column(n) for n in c.columns}
    cols = [F.struct(F.lit(m[0] * 12 + m[1] - 1).alias("t"), F.col(f"`{n}`").alias("value")) for n, m in found.items() if m]
    return c.select("c_custkey", F.explode(F.array(*cols)).alias("x")).select("c_custkey", "x.t", "x.value")


@query("shapley_values")
def shapley_values(spark: SparkSession, d: str) -> DataFrame:
    """Every forecast row of the last months with its base and the part of each column; the parts add up."""
    f = stored(_features(spark, d))
    last = _last(f)
    m = model.fit_global(f.filter(F.col("t") < last - 6), "target", ["bu", "cluster", "month"], NUMERIC)
    out = explain.attributed(m, f.filter(F.col("t") >= last - 6))
    parts = [F.col("contributions")[i].alias(f"by_{c}") for i, c in enumerate(["bu", "cluster", "month", *NUMERIC])]
    return out.select(*KEYS, "t", "prediction", "base", *parts)


@query("shapley_top_features")
def shapley_top_features(spark: SparkSession, d: str) -> DataFrame:
    """The columns that move the forecasts most, over all rows of the table."""
    f = stored(_features(spark, d))
    m = model.fit_global(f.filter(F.col("t") < _last(f) - 6), "target", ["bu", "cluster", "month"], NUMERIC)
    return explain.top(explain.attributed(m, f), ["bu", "cluster", "month", *NUMERIC])


@query("stacked_forecast")
def stacked_forecast(spark: SparkSession, d: str) -> DataFrame:
    """The last months by the ensemble, beside what each base model says."""
    f = stored(_features(spark, d))
    last = _last(f)
    s, _ = stack.fit_stack(f.filter(F.col("t") < last - 6), [*KEYS, "t"], "target", ["bu", "cluster", "month"], NUMERIC)
    return stack.predict_stack(s, f.filter(F.col("t") >= last - 6)).select(*KEYS, "t", "target", "by_gbt", "by_poisson", "by_forest", "predicted")


@query("stack_errors")
def stack_errors(spark: SparkSession, d: str) -> DataFrame:
    """Root mean squared error of each base model and of the ensemble on rows that their models have not seen."""
    f = stored(_features(spark, d))
    s, held = stack.fit_stack(f.filter(F.col("t") < _last(f) - 6), [*KEYS, "t"], "target", ["bu", "cluster", "month"], NUMERIC)
    whole = sum((F.col(f"by_{k}") * w for k, w in s.weights.items()), F.lit(0.0))
    said = F.array(*[F.struct(F.lit(k).alias("model"), F.lit(w).alias("weight"), F.col(f"by_{k}").alias("p")) for k, w in s.weights.items()], F.struct(F.lit("ensemble").alias("model"), F.lit(1.0).alias("weight"), whole.alias("p")))
    return held.select("target", F.explode(said).alias("x")).groupBy("x.model", "x.weight").agg(F.sqrt(F.avg((F.col("x.p") - F.col("target")) ** 2)).alias("rmse"), F.count("*").alias("n"))


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    f = stored(_features(spark, d))
    last = _last(f)
    m = model.fit_global(f.filter(F.col("t") < last - 6), "target", ["bu", "cluster", "month"], NUMERIC, "poisson")
    rows = model.predict(m, f).withColumnRenamed("predicted", "global").withColumn("is_train", F.col("t") < last - 6).withColumn("moon", F.col("month").cast("double"))
    return stack.per_group(rows, KEYS, "target", [*NUMERIC, "moon"], "is_train", "global")


@query("per_group_models")
def per_group_models(spark: SparkSession, d: str) -> DataFrame:
    """The last months by a model for each group, beside the global model."""
    return _grouped(spark, d).select(*KEYS, "t", "target", "global", "own", "predicted", "source")


@query("per_group_errors")
def per_group_errors(spark: SparkSession, d: str) -> DataFrame:
    """Mean absolute error of the last months for each group: its own model and the global one."""
    off = lambda c: F.avg(F.abs(F.col(c) - F.col("target")))
    return _grouped(spark, d).groupBy(*KEYS, "source").agg(off("own").alias("own_error"), off("global").alias("global_error"), F.count("*").alias("n"))
