"""Aggregates over service orders and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def value_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., value, n, pct, label): counts with their share of the group, label like "12 (3.4%)"."""
    counts = df.groupBy(*by, F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by)) if by else None
    if total is None:
        counts, total = counts.crossJoin(counts.agg(F.sum("n").alias("_t"))), F.col("_t")
    pct = F.col("n") * 100.0 / total
    return counts.withColumn("pct", F.round(pct, 4)).withColumn("label", F.concat(F.col("n").cast("string"), F.lit(" ("), F.format_number(pct, 1), F.lit("%)"))).drop("_t")


def monthly_demand(df: DataFrame, keys: Sequence[str], date: str = "rsd", qty: str = "qty", status: str = "status", open_: str = "O", cancelled: str = "P") -> DataFrame:
    """Demand, open and cancelled quantity by month, and the cancelled share of demand (0 where there is none)."""
    part = lambda s: F.sum(F.when(F.col(status) == s, F.col(qty)).otherwise(0))
    out = df.groupBy(*keys, F.year(date).alias("year"), F.month(date).alias("month")).agg(F.sum(qty).alias("demand"), part(open_).alias("open_demand"), part(cancelled).alias("cancelled"))
    return out.withColumn("cancellation_pct", F.when(F.col("demand") > 0, F.round(F.col("cancelled") * 100 / F.col("demand"), 2)).otherwise(0.0))


def months_ahead_floors(df: DataFrame, keys: Sequence[str], cutoff: Column, start: str = "rsd", submitted: str = "ssd", horizon: int = 6) -> DataFrame:
    """Rows already submitted before the cutoff, by the months from the cutoff to their start (0 to horizon - 1)."""
    window = (F.year(start) - F.year(cutoff)) * 12 + F.month(start) - F.month(cutoff)
    return df.filter(F.col(submitted) < cutoff).withColumn("window", window).filter(F.col("window").between(0, horizon - 1)).groupBy(*keys, "window").agg(F.count("*").alias("floor"))


def variation(df: DataFrame, keys: Sequence[str], value: str, sample: bool = False, missing: float | None = None) -> DataFrame:
    """Coefficient of variation of ``value`` in each group: population or sample deviation over the mean."""
    cv = F.try_divide((F.stddev_samp if sample else F.stddev_pop)(value), F.avg(value))
    return df.groupBy(*keys).agg((F.coalesce(cv, F.lit(missing)) if missing is not None else cv).alias("cv"))


def xyz(cv: Column | str) -> Column:
    c = F.col(cv) if isinstance(cv, str) else cv
    return F.when(c < 0.5, "X").when(c <= 1.0, "Y").otherwise("Z")


def quantiles(df: DataFrame, value: str, shares: Sequence[float]) -> DataFrame:
    """One row (q0, q1, ...) of exact, interpolated quantiles: running counts over distinct values go by ranges, so no
    task holds all values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    placed = running(counts, "v", "n")
    at = lambda place: F.max(F.when((F.col("upto") - F.col("n") <= place) & (place < F.col("upto")), F.col("v")))
    ends = [e for k, s in enumerate(shares) for e in (at(F.floor((F.col("total") - 1) * s)).alias(f"a{k}"), at(F.ceil((F.col("total") - 1) * s)).alias(f"b{k}"))]
    one = placed.agg(F.max("total").alias("total"), *ends)
    share = lambda s: (F.col("total") - 1) * s - F.floor((F.col("total") - 1) * s)
    return one.select(*[(F.col(f"a{k}") + (F.col(f"b{k}") - F.col(f"a{k}")) * share(s)).alias(f"q{k}") for k, s in enumerate(shares)])


def moments(df: DataFrame, value: str) -> DataFrame:
    """Mean, median, deviation, bias-corrected skewness and excess kurtosis, quartiles and values beyond the fences."""
    c = F.col(value).cast("double")
    n, g, k = F.count(c), F.skewness(c), F.kurtosis(c)
    base = df.agg(
        n.alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        (g * F.sqrt(n * (n - 1.0)) / (n - 2)).alias("skew"), (((n + 1) * k + 6) * (n - 1) / ((n - 2.0) * (n - 3))).alias("kurtosis"),
    )
    q = quantiles(df, value, (0.25, 0.5, 0.75)).toDF("q1", "median", "q3")
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    beyond = df.select(c.alias("_v")).crossJoin(F.broadcast(q)).filter((F.col("_v") < F.col("q1") - fence) | (F.col("_v") > F.col("q3") + fence)).agg(F.count("*").alias("outliers"))
    return base.crossJoin(q).crossJoin(beyond)


def mode_of(df: DataFrame, keys: Sequence[str], column: str, into: str) -> DataFrame:
    """The most frequent value of each group; the smallest of equals."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).count()
    return counts.groupBy(*keys).agg(F.min_by(column, F.struct(-F.col("count"), F.col(column))).alias(into))


def joined_values(column: str, sep: str = " | ") -> Column:
    """Distinct values in order, as one text."""
    return F.array_join(F.array_sort(F.collect_set(column)), sep)


def weighted(value: str, weight: str) -> Column:
    """Weighted mean over rows that have both."""
    ok = F.col(value).isNotNull() & F.col(weight).isNotNull()
    return F.try_divide(F.sum(F.when(ok, F.col(value) * F.col(weight))), F.sum(F.when(ok, F.col(weight))))


def average_rank(column: str, by: Sequence[str] = ()) -> Column:
    """Rank with ties at the mean of their places."""
    w = Window.partitionBy(*by)
    return F.rank().over(w.orderBy(column)) + (F.count("*").over(Window.partitionBy(*by, column)) - 1) / 2.0


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson and Spearman correlation. Ranks come from value counts, so that equal values are ranked once; the running
    count over distinct values goes by ranges of the value, not through one task."""

    def ranked(c: str) -> DataFrame:
        counts = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n"))
        return running(counts, "v", "n").select(F.col("v").alias(c), (F.col("upto") - F.col("n") + (F.col("n") + 1) / 2.0).alias(f"rank_{c}"))

    both = df.select(x, y).join(ranked(x), x).join(ranked(y), y)
    return both.agg(F.corr(x, y).alias("pearson"), F.corr(f"rank_{x}", f"rank_{y}").alias("spearman"))


def running(df: DataFrame, order: str, value: str, parts: int = 64, descending: bool = False, tie: str | None = None) -> DataFrame:
    """``df`` with the running sum ``upto`` of ``value`` in the order, and the ``total``.

    Ranges of the order key are numbered from approximate quantiles; each range sums alone and adds what all ranges
    before it hold (``parts`` numbers), so no task sees the whole table."""
    cuts = df.agg(F.percentile_approx(order, F.array(*[F.lit(k / parts) for k in range(1, parts)]), F.lit(2000)).alias("c")).first()["c"] or []
    part = F.lit(0)
    for c in sorted(set(cuts)):
        part = part + (F.col(order) > F.lit(c)).cast("int")
    dealt = df.withColumn("_part", -part if descending else part)
    sums = dealt.groupBy("_part").agg(F.sum(value).alias("_s"))
    before = sums.select("_part", (F.sum("_s").over(Window.orderBy("_part")) - F.col("_s")).alias("_before"), F.sum("_s").over(Window.partitionBy(F.lit(0))).alias("total"))
    ordered = [F.desc(order) if descending else F.asc(order), *([F.asc(tie)] if tie else [])]
    own = F.sum(value).over(Window.partitionBy("_part").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(F.broadcast(before), "_part").withColumn("upto", own + F.col("_before")).drop("_part", "_before")


def horizon_metrics(df: DataFrame, keys: Sequence[str], horizon: str, actual: str, predicted: str) -> DataFrame:
    """Accuracy figures for each horizon and over all (horizon null, all_horizons 1), with and without the keys."""
    a, p = F.col(actual), F.col(predicted)
    ape = F.when(a > 0, F.abs(a - p) / a)
    sets = [[*keys, horizon], [*keys], [horizon], []]
    out = df.groupingSets(sets, *keys, horizon).agg(
        F.grouping(horizon).cast("int").alias("all_horizons"), F.sum(a).alias("total_actual"), F.sum(p).alias("total_predicted"),
        F.avg(ape * 100).alias("mape"), (1 - F.avg(F.when(a > 0, F.least(ape, F.lit(1.0))))).alias("accuracy"), F.avg(F.abs(a - p)).alias("mae"), F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
        F.avg(200 * F.abs(p - a) / (F.abs(p) + F.abs(a) + 1e-8)).alias("smape"), F.try_divide((F.sum(p) - F.sum(a)) * 100, F.sum(a)).alias("volume_error_pct"),
    )
    return out
