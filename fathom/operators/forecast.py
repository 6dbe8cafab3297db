"""Forecast figures: accuracy, guardrail, splits, bias and alerts; and the planning views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_accuracy(actual: Column, predicted: Column) -> Column:
    """100 x (1 - capped relative error), null without actual demand."""
    return F.when(actual > 0, F.round(100 * (1 - F.least(F.lit(1.0), F.abs(actual - predicted) / actual)), 2))


def uncapped_accuracy(actual: Column, predicted: Column) -> Column:
    return F.when(actual > 0, 100 - F.abs(predicted - actual) * 100 / actual)


def guardrail(df: DataFrame, floors: DataFrame, keys: Sequence[str], predicted: str = "predicted") -> DataFrame:
    """Predictions raised to the rows already submitted; a group without a floor has floor 0."""
    out = df.join(floors, list(keys), "left").withColumn("floor", F.coalesce("floor", F.lit(0)))
    return out.withColumn("corrected", F.greatest(F.col(predicted), F.col("floor"))).withColumn("was_corrected", F.col("floor") > F.col(predicted))


def group_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals of each group, whether and how often the floor was used, and accuracy before and after."""
    before, after = row_accuracy(F.sum("actual"), F.sum("predicted")), row_accuracy(F.sum("actual"), F.sum("corrected"))
    return df.groupBy(*keys).agg(F.sum("actual").alias("total_actual"), F.sum("predicted").alias("total_predicted"), F.sum("corrected").alias("total_corrected"), F.bool_or("was_corrected").alias("any_corrected"), F.count_if("was_corrected").alias("n_corrected"), before.alias("accuracy_before"), after.alias("accuracy_after"))


def demand_split(df: DataFrame, ratio: str, value: str = "predicted", default: float = 0.07) -> DataFrame:
    share = F.coalesce(F.col(ratio), F.lit(default))
    return df.withColumn("backfill", F.col(value) * share).withColumn("new_demand", F.col(value) * (1 - share))


def bias(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean and deviation of the relative error by group, and its kind: over or under throughout, uneven, or fine."""
    e = F.when(F.col("actual") > 0, (F.col("predicted") - F.col("actual")) / F.col("actual"))
    g = df.withColumn("_e", e).groupBy(*keys).agg(F.avg("_e").alias("mean_error"), F.stddev_samp("_e").alias("std_error"), F.count("_e").alias("n"), F.count_if(F.col("_e") > 0.05).alias("_over"), F.count_if(F.col("_e") < -0.05).alias("_under"))
    kind = F.when((F.col("_over") >= 0.75 * F.col("n")) & (F.col("mean_error") > 0.1), "systematic over").when((F.col("_under") >= 0.75 * F.col("n")) & (F.col("mean_error") < -0.1), "systematic under").when((F.col("std_error") > 0.25) & (F.col("n") >= 3), "high variance").otherwise("fine")
    return g.withColumn("bias", kind).drop("_over", "_under")


def alerts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spikes against the horizon before, accuracy under 80, and more rows submitted than 1.2 times the prediction."""
    from fathom.operators.match import against_prior

    p = against_prior(df, keys, "h", "predicted")
    cols = [*keys, "h"]
    spike = p.filter((F.col("predicted") > 1.5 * F.col("prior")) & (F.col("predicted") > 50)).select(*cols, F.lit("Demand Spike").alias("alert"), F.when(F.col("predicted") > 2 * F.col("prior"), "High").otherwise("Medium").alias("severity"))
    drop = df.filter(row_accuracy(F.col("actual"), F.col("predicted")) < 80).select(*cols, F.lit("Accuracy Drop").alias("alert"), F.lit("Medium").alias("severity"))
    surge = df.filter(F.col("floor") > 1.2 * F.col("predicted")).select(*cols, F.lit("Short Fuse Surge").alias("alert"), F.lit("High").alias("severity"))
    return spike.unionByName(drop).unionByName(surge)


def gap_status(demand: Column, supply: Column) -> Column:
    pct = F.when(demand > 0, (demand - supply) * 100 / demand).otherwise(0.0)
    return F.when(pct > 25, "Critical").when(pct > 15, "Warning").otherwise("OK")


def scenario(df: DataFrame, value: str, bu: float = 0, market: float = 0, win: float = 0, strategic: float = 0) -> DataFrame:
    """(…, kind, amount): baseline, scenario and adjustment rows; drivers are shares, weighed 1, 0.5, 0.3 and 0.2."""
    factor = 1 + bu + 0.5 * market + 0.3 * win + 0.2 * strategic
    base, new = F.floor(value).cast("long"), F.floor(F.col(value) * factor).cast("long")
    rest = [c for c in df.columns if c != value]
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("amount")) for k, v in (("baseline", base), ("scenario", new), ("adjustment", new - base))])
    return df.select(*rest, F.explode(kinds).alias("x")).select(*rest, "x.kind", "x.amount")


def sections(summary: DataFrame, value: str, individual: int, others: int, keys: Sequence[str]) -> DataFrame:
    """``summary`` with the section of each group by its place in ``value``: individual, global or remainder."""
    top = summary.orderBy(F.desc(value), *keys).limit(individual + others).withColumn("_m", -F.col(value))
    placed = top.agg(F.array_sort(F.collect_list(F.struct("_m", *keys))).alias("a")).select(F.posexplode("a").alias("_place", "x")).select("_place", *[f"x.{k}" for k in keys])
    section = F.when(F.col("_place") < individual, "Individual").when(F.col("_place").isNotNull(), "Global").otherwise("Remainder")
    return summary.join(F.broadcast(placed), list(keys), "left").withColumn("section", section).drop("_place")


def late_bias(df: DataFrame, keys: Sequence[str], first: int = 3, last: int = 6) -> DataFrame:
    """(keys, late): what is wrong with the late horizons: low visibility where a prediction is missing or the mean
    absolute error is over half, else over- or underprediction by 15 % on the mean, else none."""
    inside = df.filter(F.col("h").between(first, last) & (F.col("actual") > 0))
    e = (F.col("predicted") - F.col("actual")) / F.col("actual")
    g = inside.groupBy(*keys).agg(F.count_if(F.col("predicted") < 1e-6).alias("_none"), F.avg(F.abs(e)).alias("_abs"), F.avg(e).alias("_mean"))
    low = (F.col("_none") >= 1) | (F.col("_abs") > 0.5)
    late = F.when(low, "low visibility").when(F.col("_mean") < -0.15, "underprediction").when(F.col("_mean") > 0.15, "overprediction").otherwise("none")
    return df.select(*keys).distinct().join(g.withColumn("late", late).drop("_none", "_abs", "_mean"), list(keys), "left").withColumn("late", F.coalesce("late", F.lit("none")))


def rescaled(df: DataFrame, parts: Sequence[str], before: str, after: str) -> DataFrame:
    """Parts of a value scaled by what its correction did to it; unchanged where it was 0."""
    factor = F.when(F.col(before) > 0, F.col(after) / F.col(before)).otherwise(1.0)
    return df.withColumns({p: F.col(p) * factor for p in parts})
