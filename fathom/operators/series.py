"""Time-series operators on monthly series of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.functions.dates import month_index


def spine(df: DataFrame, keys: Sequence[str], date: str, value: Column) -> DataFrame:
    """(keys, t, value) for every month index from the table's first to its last; months without rows have 0.

    One shuffle by group: months are summed, gathered into a map of one entry a month, and spread over the range that
    one aggregate of the same sums tells."""
    months = df.filter(F.col(date).isNotNull()).groupBy(*keys, month_index(date).alias("t")).agg(value.alias("value"))
    bounds = months.agg(F.min("t").alias("_first"), F.max("t").alias("_last"))
    held = months.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("t", F.col("value").cast("double")))).alias("m"))
    spread = held.crossJoin(F.broadcast(bounds)).select(*keys, F.explode(F.sequence("_first", "_last")).alias("t"), "m")
    return spread.select(*keys, "t", F.coalesce(F.try_element_at("m", F.col("t")), F.lit(0.0)).alias("value"))


def _w(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("t")


def moving_averages(series: DataFrame, keys: Sequence[str], spans: Sequence[int] = (3, 6, 12), decay: float = 0.7) -> DataFrame:
    """Simple and exponentially weighted means over the last months, the current one included; months before the
    series count as 0."""
    w = _w(keys)
    out = series
    for n in spans:
        lags = [F.coalesce(F.lag("value", k).over(w), F.lit(0.0)) if k else F.col("value") for k in range(n)]
        weights = [decay**k for k in range(n)]
        out = out.withColumn(f"sma_{n}m", sum(lags[1:], lags[0]) / n).withColumn(f"wma_{n}m", sum((x * v for x, v in zip(lags[1:], weights[1:], strict=True)), lags[0]) / sum(weights))
    return out


def growth(series: DataFrame, keys: Sequence[str], spans: Sequence[int] = (3, 6, 9), base: float = 5, bound: float = 300) -> DataFrame:
    """Percent change of the last n complete months over the n before; 0 where the base is under ``base``; clipped."""
    w = _w(keys)
    out = series
    for n in spans:
        recent, prior = F.coalesce(F.sum("value").over(w.rowsBetween(-n, -1)), F.lit(0.0)), F.coalesce(F.sum("value").over(w.rowsBetween(-2 * n, -n - 1)), F.lit(0.0))
        change = F.when(prior >= base, F.greatest(F.lit(-float(bound)), F.least(F.lit(float(bound)), (recent - prior) / prior * 100))).otherwise(0.0)
        out = out.withColumn(f"demand_growth_{n}m", change)
    return out


def ratio_and_slope(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of the last 3 complete months over that of the 9 before, in [0.2, 5] (1 without history); slope of the last
    6 complete months over their mean, in [-2, 2], 0 where they sum to less than 5."""
    w = _w(keys)
    recent, past = F.avg("value").over(w.rowsBetween(-3, -1)), F.avg("value").over(w.rowsBetween(-12, -4))
    ratio = F.when(past > 0, F.greatest(F.lit(0.2), F.least(F.lit(5.0), recent / past))).otherwise(1.0)
    lags = [F.coalesce(F.lag("value", 6 - k).over(w), F.lit(0.0)) for k in range(6)]
    total = sum(lags[1:], lags[0])
    slope = sum((x * (k - 2.5) for k, x in enumerate(lags)), F.lit(0.0)) / 17.5
    trend = F.when(total >= 5, F.greatest(F.lit(-2.0), F.least(F.lit(2.0), slope / (total / 6)))).otherwise(0.0)
    return series.withColumn("recent_vs_historical_ratio", ratio).withColumn("trend_slope_6m", trend)


def year_over_year(series: DataFrame, keys: Sequence[str], base: float = 5, bound: float = 300) -> DataFrame:
    """Percent change of the same month one year ago over two years ago."""
    w = _w(keys)
    one, two = F.lag("value", 12).over(w), F.lag("value", 24).over(w)
    change = F.when(two >= base, F.greatest(F.lit(-float(bound)), F.least(F.lit(float(bound)), (one - two) / two * 100))).otherwise(0.0)
    return series.withColumn("yoy_growth", F.coalesce(change, F.lit(0.0)))


def time_to_next(df: DataFrame, keys: Sequence[str], date: str, tie: str, censored: int = 365) -> DataFrame:
    """Days to the group's next row (1 at least); the last one has ``censored`` days and is marked."""
    following = F.lead(date).over(Window.partitionBy(*keys).orderBy(date, tie))
    days = F.when(following.isNull(), censored).otherwise(F.greatest(F.datediff(following, date), F.lit(1)))
    return df.withColumn("days_to_next", days).withColumn("is_censored", following.isNull().cast("int"))


def cutoffs(df: DataFrame, date: str, lead_days: int = 60) -> DataFrame:
    """(cutoff) monthly from the first date plus ``lead_days`` to the day before the last date."""
    ends = df.agg(F.date_add(F.min(date), lead_days).alias("a"), F.date_sub(F.max(date), 1).alias("b"))
    return ends.filter("a <= b").select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("cutoff"))


def events_before(events: DataFrame, points: DataFrame, keys: Sequence[str], date: str, cutoff: str, spans: Sequence[int] = (30, 90)) -> DataFrame:
    """For each (keys, cutoff) of ``points``: events in the n days before the cutoff, days since the last one (365
    without any), and the yearly rate of 30 days over that of 90.

    Events and cutoffs of a group are merged and ordered by day; running counts answer all ranges in one window pass,
    so nothing is multiplied by the number of cutoffs."""
    e = events.groupBy(*keys, F.col(date).alias("day")).agg(F.count("*").alias("n")).withColumn("point", F.lit(0))
    p = points.select(*keys, F.col(cutoff).alias("day")).distinct().withColumn("n", F.lit(0).cast("long")).withColumn("point", F.lit(1))
    both = e.unionByName(p).withColumn("d", F.datediff("day", F.lit("1970-01-01")))
    w = Window.partitionBy(*keys).orderBy("d")
    out = both
    for n in spans:
        out = out.withColumn(f"events_last_{n}d", F.coalesce(F.sum("n").over(w.rangeBetween(-n, -1)), F.lit(0)))
    last = F.max(F.when(F.col("point") == 0, F.col("d"))).over(w.rangeBetween(Window.unboundedPreceding, -1))
    out = out.withColumn("days_since_last_event", F.coalesce(F.col("d") - last, F.lit(365))).filter("point = 1")
    if {30, 90} <= set(spans):
        rate30, rate90 = F.col("events_last_30d") / 30.0 * 365, F.col("events_last_90d") / 90.0 * 365
        out = out.withColumn("momentum_30_vs_90", F.when(rate90 > 0, rate30 / rate90).otherwise(0.0))
    return out.withColumnRenamed("day", cutoff).drop("n", "point", "d")


def horizons(points: DataFrame, n: int = 6) -> DataFrame:
    return points.withColumn("months_ahead", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def trajectory(yearly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(cagr, trend_strength, cv, trajectory_class) from (keys, year, n): growth over the years seen, the correlation
    of count and year, and a class by fixed rules."""
    first, last = F.min_by("n", "year"), F.max_by("n", "year")
    span = F.max("year") - F.min("year")
    cagr = F.when((span > 0) & (first > 0), F.pow(last / first, 1.0 / span) - 1).otherwise(0.0)
    g = yearly.groupBy(*keys).agg(cagr.alias("cagr"), F.abs(F.coalesce(F.try_divide(F.covar_pop("year", F.col("n").cast("double")), F.stddev_pop("year") * F.stddev_pop("n")), F.lit(0.0))).alias("trend_strength"), F.coalesce(F.try_divide(F.stddev_pop("n"), F.avg("n")), F.lit(0.0)).alias("cv"))
    rule = F.when(F.col("cv") > 0.8, "Volatile").when((F.col("cagr") > 0.15) & (F.col("trend_strength") > 0.6), "Growing").when((F.col("cagr") < -0.15) & (F.col("trend_strength") > 0.6), "Declining").otherwise("Stable")
    return g.withColumn("trajectory_class", rule)


def pareto(groups: DataFrame, order: str, value: str, share: float, tie: str) -> DataFrame:
    """The largest groups that together reach the share, the crossing one included."""
    from fathom.operators.aggregate import running

    return running(groups, order, value, descending=True, tie=tie).filter(F.col("upto") - F.col(value) < share * F.col("total")).drop("upto", "total")


def rank_changes(counts: DataFrame, name: str, year: str, n: str) -> DataFrame:
    """(name, first and last rank, change, pct change, trend): ranks by count, then by name, within each year; a name
    that a year lacks ranks after all that it has."""
    rank = F.row_number().over(Window.partitionBy(year).orderBy(F.desc(n), F.lower(name), name))
    ranked = counts.withColumn("rank", rank)
    ends = counts.agg(F.min(year).alias("a"), F.max(year).alias("b"))
    sizes = counts.crossJoin(F.broadcast(ends)).agg(F.count_if(F.col(year) == F.col("a")).alias("na"), F.count_if(F.col(year) == F.col("b")).alias("nb"), F.first("a").alias("a"), F.first("b").alias("b"))
    at = lambda c, y: F.max(F.when(F.col(year) == F.col(y), F.col(c)))
    wide = ranked.crossJoin(F.broadcast(sizes)).groupBy(name).agg(at("rank", "a").alias("ra"), at("rank", "b").alias("rb"), at(n, "a").alias("ca"), at(n, "b").alias("cb"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    first, last = F.coalesce("ra", F.col("na") + 1), F.coalesce("rb", F.col("nb") + 1)
    pct = F.when(F.col("ca") > 0, (F.coalesce("cb", F.lit(0)) - F.col("ca")) * 100.0 / F.col("ca"))
    out = wide.select(name, first.alias("rank_first"), last.alias("rank_last"), pct.alias("demand_pct_change"))
    change = F.col("rank_first") - F.col("rank_last")
    return out.withColumn("rank_change", change).withColumn("trend", F.when(change > 0, "up").when(change < 0, "down").otherwise("same"))


def tail_split(df: DataFrame, keys: Sequence[str], order: Sequence[str], share: float = 0.1) -> DataFrame:
    """Marks the last share of each group's rows in time as validation."""
    w = Window.partitionBy(*keys)
    return df.withColumn("is_validation", (F.row_number().over(w.orderBy(*order)) > F.count("*").over(w) * (1 - share)).cast("int"))


def totals_before(events: DataFrame, points: DataFrame, keys: Sequence[str], date: str, cutoff: str) -> DataFrame:
    """(keys, cutoff, total): events of the group before each cutoff, from one running count over merged days."""
    e = events.groupBy(*keys, F.col(date).alias("_day")).agg(F.count("*").alias("_n")).withColumn("_point", F.lit(1))
    p = points.select(*keys, F.col(cutoff).alias("_day")).distinct().withColumn("_n", F.lit(0).cast("long")).withColumn("_point", F.lit(0))
    w = Window.partitionBy(*keys).orderBy("_day", "_point").rowsBetween(Window.unboundedPreceding, 0)
    return e.unionByName(p).withColumn("total", F.sum("_n").over(w)).filter("_point = 0").select(*keys, F.col("_day").alias(cutoff), "total")


def targets(events: DataFrame, points: DataFrame, keys: Sequence[str], date: str, cutoff: str, horizon: str, least: int = 3) -> DataFrame:
    """``points`` (keys, cutoff, months ahead) with the events of the month meant. Months past the data's last go; groups
    need ``least`` events in all, and as many before the cutoff."""
    last = events.agg(F.trunc(F.max(date), "month").alias("_last"))
    monthly = events.groupBy(*keys, F.trunc(date, "month").alias("month")).agg(F.count("*").alias("target"))
    big = events.groupBy(*keys).agg(F.count("*").alias("_all")).filter(F.col("_all") >= least).select(*keys)
    enough = totals_before(events, points, keys, date, cutoff).filter(F.col("total") >= least).select(*keys, cutoff)
    p = points.join(enough, [*keys, cutoff]).join(big, list(keys), "left_semi").withColumn("month", F.trunc(F.add_months(cutoff, F.col(horizon)), "month"))
    p = p.crossJoin(F.broadcast(last)).filter("month <= _last").drop("_last")
    return p.join(monthly, [*keys, "month"], "left").withColumn("target", F.coalesce("target", F.lit(0)))


def count_slope(events: DataFrame, keys: Sequence[str], date: str, cutoff: str, days: int = 90) -> DataFrame:
    """(keys, slope): least-squares slope of the running event count over days, in the window before the cutoff; 0 with
    fewer than two days. Events of a day take places in a row, so sums by day are enough."""
    inside = events.filter((F.col(date) < F.lit(cutoff)) & (F.col(date) >= F.date_sub(F.lit(cutoff).cast("date"), days)))
    daily = inside.groupBy(*keys, F.col(date).alias("_d")).agg(F.count("*").alias("_n")).withColumn("_x", F.datediff("_d", F.lit("1970-01-01")).cast("double"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_x")) - F.col("_n")
    y = daily.withColumn("_sy", F.col("_n") * before + F.col("_n") * (F.col("_n") - 1) / 2.0)  # the sum of the day's places
    x0 = F.min("_x").over(Window.partitionBy(*keys))
    y = y.withColumn("_x", F.col("_x") - x0)
    n, sx, sy = F.sum("_n"), F.sum(F.col("_n") * F.col("_x")), F.sum("_sy")
    sxy, sxx = F.sum(F.col("_x") * F.col("_sy")), F.sum(F.col("_n") * F.col("_x") * F.col("_x"))
    return y.groupBy(*keys).agg(F.coalesce(F.try_divide(sxy - sx * sy / n, sxx - sx * sx / n), F.lit(0.0)).alias("slope"))
