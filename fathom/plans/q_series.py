"""Queries of the time-series operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.functions import dates
from fathom.operators import series
from fathom.plans.adapt import load, query, service_orders

_SPINE = """, g AS (SELECT DISTINCT bu, cluster FROM so), ts AS (SELECT unnest(range(a, b + 1)) AS t FROM (SELECT min(year(rsd) * 12 + month(rsd) - 1) AS a, max(year(rsd) * 12 + month(rsd) - 1) AS b FROM so) e),
c AS (SELECT bu, cluster, year(rsd) * 12 + month(rsd) - 1 AS t, count(*)::DOUBLE AS v FROM so GROUP BY ALL),
s AS (SELECT g.bu, g.cluster, ts.t, coalesce(v, 0) AS value FROM g CROSS JOIN ts LEFT JOIN c ON c.bu = g.bu AND c.cluster = g.cluster AND c.t = ts.t),
l AS (SELECT *, """ + ", ".join(f"coalesce(lag(value, {k}) OVER w, 0) AS l{k}" for k in range(1, 25)) + """, row_number() OVER w AS rn FROM s WINDOW w AS (PARTITION BY bu, cluster ORDER BY t))"""
KEYS = ["bu", "cluster"]


def monthly(spark: SparkSession, d: str) -> DataFrame:
    return series.spine(service_orders(spark, d), KEYS, "rsd", F.count("*"))


@query("month_spine", _SPINE + " SELECT bu, cluster, t, value FROM s", orders=True)
def month_spine(spark: SparkSession, d: str) -> DataFrame:
    return monthly(spark, d)


def _sum(a: int, b: int, weight: str = "") -> str:
    return " + ".join((f"{'value' if k == 0 else f'l{k}'}" + (f" * pow(0.7, {k})" if weight else "")) for k in range(a, b))


@query("sma_wma", _SPINE + " SELECT bu, cluster, t, " + ", ".join(f"round(({_sum(0, n)}) / {n}, 6) AS sma_{n}m, round(({_sum(0, n, 'w')}) / {sum(0.7**k for k in range(n))!r}, 6) AS wma_{n}m" for n in (3, 6, 12)) + " FROM l", orders=True)
def sma_wma(spark: SparkSession, d: str) -> DataFrame:
    out = series.moving_averages(monthly(spark, d), KEYS)
    return out.select(*KEYS, "t", *[F.round(f"{x}_{n}m", 6).alias(f"{x}_{n}m") for n in (3, 6, 12) for x in ("sma", "wma")])


@query("growth_3_6_9", _SPINE + " SELECT bu, cluster, t, " + ", ".join(f"round(CASE WHEN ({_sum(n + 1, 2 * n + 1)}) >= 5 THEN greatest(-300, least(300, (({_sum(1, n + 1)}) - ({_sum(n + 1, 2 * n + 1)})) / ({_sum(n + 1, 2 * n + 1)}) * 100)) ELSE 0 END, 5) AS demand_growth_{n}m" for n in (3, 6, 9)) + " FROM l", orders=True)
def growth_3_6_9(spark: SparkSession, d: str) -> DataFrame:
    return series.growth(monthly(spark, d), KEYS).select(*KEYS, "t", *[F.round(f"demand_growth_{n}m", 5).alias(f"demand_growth_{n}m") for n in (3, 6, 9)])


@query(
    "ratio_slope",
    _SPINE + f""", r AS (SELECT *, avg(value) OVER (PARTITION BY bu, cluster ORDER BY t ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS recent, avg(value) OVER (PARTITION BY bu, cluster ORDER BY t ROWS BETWEEN 12 PRECEDING AND 4 PRECEDING) AS past, ({_sum(1, 7)}) AS total, (l6 * -2.5 + l5 * -1.5 + l4 * -0.5 + l3 * 0.5 + l2 * 1.5 + l1 * 2.5) / 17.5 AS slope FROM l)
    SELECT bu, cluster, t, round(CASE WHEN past > 0 THEN greatest(0.2, least(5, recent / past)) ELSE 1 END, 5) AS recent_vs_historical_ratio, round(CASE WHEN total >= 5 THEN greatest(-2, least(2, slope / (total / 6))) ELSE 0 END, 5) AS trend_slope_6m FROM r""",
    orders=True,
)
def ratio_slope(spark: SparkSession, d: str) -> DataFrame:
    out = series.ratio_and_slope(monthly(spark, d), KEYS)
    return out.select(*KEYS, "t", *[F.round(c, 5).alias(c) for c in ("recent_vs_historical_ratio", "trend_slope_6m")])


@query("yoy_growth", _SPINE + " SELECT bu, cluster, t, round(CASE WHEN rn > 24 AND l24 >= 5 THEN greatest(-300, least(300, (l12 - l24) / l24 * 100)) ELSE 0 END, 5) AS yoy_growth FROM l", orders=True)
def yoy_growth(spark: SparkSession, d: str) -> DataFrame:
    return series.year_over_year(monthly(spark, d), KEYS).select(*KEYS, "t", F.round("yoy_growth", 5).alias("yoy_growth"))


@query(
    "bridge_features",
    _SPINE + """, b AS (SELECT *, lag(value) OVER (PARTITION BY bu, cluster ORDER BY t) AS before_1, avg(value) OVER (PARTITION BY bu, cluster ORDER BY t ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS m FROM s)
    SELECT bu, cluster, t, value AS m0, before_1, round(m, 6) AS before_mean, round(CASE WHEN round(m, 6) > 0 THEN value / round(m, 6) ELSE 0 END, 6) AS bridge_ratio FROM b""",
    orders=True,
)
def bridge_features(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy(*KEYS).orderBy("t")
    mean = F.round(F.avg("value").over(w.rowsBetween(-3, -1)), 6)
    out = monthly(spark, d).withColumn("before_1", F.lag("value", 1).over(w)).withColumn("before_mean", mean)
    return out.select(*KEYS, "t", F.col("value").alias("m0"), "before_1", "before_mean", F.round(F.when(F.col("before_mean") > 0, F.col("value") / F.col("before_mean")).otherwise(0.0), 6).alias("bridge_ratio"))


@query(
    "time_to_next",
    """WITH n AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS day, lead(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS following FROM orders)
    SELECT o_custkey, o_orderkey, CASE WHEN following IS NULL THEN 365 ELSE greatest(date_diff('day', day, following), 1) END AS days_to_next, (following IS NULL)::INTEGER AS is_censored FROM n""",
)
def time_to_next(spark: SparkSession, d: str) -> DataFrame:
    df = load(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return series.time_to_next(df, ["o_custkey"], "day", "o_orderkey").drop("day")


@query(
    "top_demand_prefix",
    """, g AS (SELECT country, cluster, count(*) AS n FROM so GROUP BY ALL), r AS (SELECT *, sum(n) OVER (ORDER BY n DESC, country || '/' || cluster) AS upto, sum(n) OVER () AS total FROM g) SELECT country, cluster, n FROM r WHERE upto - n < 0.8 * total""",
    orders=True,
)
def top_demand_prefix(spark: SparkSession, d: str) -> DataFrame:
    g = service_orders(spark, d).groupBy("country", "cluster").agg(F.count("*").alias("n")).withColumn("tie", F.concat_ws("/", "country", "cluster"))
    return series.pareto(g, "n", "n", 0.8, "tie").select("country", "cluster", "n")


@query(
    "pareto_counts",
    """, g AS (SELECT country, cluster, count(*) AS n FROM so GROUP BY ALL), r AS (SELECT *, sum(n) OVER (ORDER BY n DESC, country || '/' || cluster) AS upto, sum(n) OVER () AS total FROM g)
    SELECT count(*) FILTER (upto - n < 0.8 * total) AS n80, count(*) FILTER (upto - n < 0.9 * total) AS n90, count(*) AS groups FROM r""",
    orders=True,
)
def pareto_counts(spark: SparkSession, d: str) -> DataFrame:
    from fathom.operators.aggregate import running

    g = service_orders(spark, d).groupBy("country", "cluster").agg(F.count("*").alias("n")).withColumn("tie", F.concat_ws("/", "country", "cluster"))
    r = running(g, "n", "n", descending=True, tie="tie")
    under = lambda s: F.count_if(F.col("upto") - F.col("n") < s * F.col("total"))
    return r.agg(under(0.8).alias("n80"), under(0.9).alias("n90"), F.count("*").alias("groups"))


@query(
    "rank_change",
    """, c AS (SELECT cluster, year(rsd) AS y, count(*) AS n FROM so WHERE year(rsd) BETWEEN 1996 AND 1999 GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY n DESC, lower(cluster), cluster) AS k FROM c),
    w AS (SELECT cluster, max(k) FILTER (y = 1996) AS ra, max(k) FILTER (y = 1999) AS rb, max(n) FILTER (y = 1996) AS ca, max(n) FILTER (y = 1999) AS cb FROM r GROUP BY cluster),
    z AS (SELECT cluster, coalesce(ra, (SELECT count(*) + 1 FROM c WHERE y = 1996)) AS rank_first, coalesce(rb, (SELECT count(*) + 1 FROM c WHERE y = 1999)) AS rank_last, round(CASE WHEN ca > 0 THEN (coalesce(cb, 0) - ca) * 100.0 / ca END, 5) AS demand_pct_change FROM w)
    SELECT *, rank_first - rank_last AS rank_change, CASE WHEN rank_first > rank_last THEN 'up' WHEN rank_first < rank_last THEN 'down' ELSE 'same' END AS trend FROM z""",
    orders=True,
)
def rank_change(spark: SparkSession, d: str) -> DataFrame:
    c = service_orders(spark, d).filter(F.year("rsd").between(1996, 1999)).groupBy("cluster", F.year("rsd").alias("y")).agg(F.count("*").alias("n"))
    return series.rank_changes(c, "cluster", "y", "n").withColumn("demand_pct_change", F.round("demand_pct_change", 5))


@query(
    "topn_cv_gate",
    """, m AS (SELECT country, cluster, date_trunc('month', rsd) AS m, count(*) AS n FROM so GROUP BY ALL), g AS (SELECT country, cluster, sum(n) AS total, stddev_samp(n) / avg(n) AS cv FROM m GROUP BY ALL),
    k AS (SELECT *, count(*) OVER () AS groups, row_number() OVER (PARTITION BY coalesce(cv, 9) <= 0.45 ORDER BY total DESC, country, cluster) AS place FROM g)
    SELECT country, cluster, total, groups <= 100 OR (coalesce(cv, 9) <= 0.45 AND place <= 100) AS individual FROM k""",
    orders=True,
)
def topn_cv_gate(spark: SparkSession, d: str) -> DataFrame:
    m = service_orders(spark, d).groupBy("country", "cluster", F.trunc("rsd", "month").alias("m")).agg(F.count("*").alias("n"))
    g = m.groupBy("country", "cluster").agg(F.sum("n").alias("total"), (F.stddev_samp("n") / F.avg("n")).alias("cv"))
    top = g.filter("cv <= 0.45").orderBy(F.desc("total"), "country", "cluster").limit(100).select("country", "cluster", F.lit(True).alias("_top"))
    few = g.agg((F.count("*") <= 100).alias("_few"))
    return g.join(F.broadcast(top), ["country", "cluster"], "left").crossJoin(F.broadcast(few)).select("country", "cluster", "total", (F.col("_few") | F.coalesce("_top", F.lit(False))).alias("individual"))


_POINTS = """, k AS (SELECT DISTINCT bu FROM so), ends AS (SELECT min(rsd) + 60 AS a, max(rsd) - 1 AS b FROM so), i AS (SELECT unnest(range(0, 200)) AS i),
pt AS (SELECT bu, (a + to_months(i::INTEGER))::DATE AS cutoff FROM k, ends, i WHERE a + to_months(i::INTEGER) <= b)"""


@query("rolling_cutoffs", _POINTS + " SELECT bu, cutoff, months_ahead FROM pt, (SELECT unnest(range(0, 6)) AS months_ahead) h", orders=True, dates=("cutoff",))
def rolling_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    so = service_orders(spark, d)
    return series.horizons(so.select("bu").distinct().crossJoin(series.cutoffs(so, "rsd")))


@query(
    "range_event_join",
    _POINTS + """, e AS (SELECT bu, rsd FROM so), j AS (SELECT pt.bu, pt.cutoff, count(*) FILTER (rsd >= cutoff - 30) AS events_last_30d, count(*) FILTER (rsd >= cutoff - 90) AS events_last_90d, coalesce(min(cutoff - rsd), 365) AS days_since_last_event FROM pt LEFT JOIN e ON e.bu = pt.bu AND rsd < cutoff GROUP BY ALL)
    SELECT *, round(CASE WHEN events_last_90d > 0 THEN (events_last_30d / 30.0) / (events_last_90d / 90.0) ELSE 0 END, 6) AS momentum_30_vs_90 FROM j""",
    orders=True,
    dates=("cutoff",),
)
def range_event_join(spark: SparkSession, d: str) -> DataFrame:
    so = service_orders(spark, d)
    points = so.select("bu").distinct().crossJoin(series.cutoffs(so, "rsd"))
    return series.events_before(so, points, ["bu"], "rsd", "cutoff").withColumn("momentum_30_vs_90", F.round("momentum_30_vs_90", 6))


@query(
    "hierarchy_features",
    """SELECT bu, count(*) AS bu_total, count(*) FILTER (rsd >= DATE '2001-01-01' - 90) AS bu_last_90d, count(DISTINCT cluster) AS bu_clusters, round(count(*) / nullif(count(DISTINCT cluster), 0), 5) AS bu_density FROM so WHERE rsd < DATE '2001-01-01' GROUP BY bu""",
    orders=True,
)
def hierarchy_features(spark: SparkSession, d: str) -> DataFrame:
    before = service_orders(spark, d).filter(F.col("rsd") < "2001-01-01")
    n, k = F.count("*"), F.count_distinct("cluster")
    return before.groupBy("bu").agg(n.alias("bu_total"), F.count_if(F.col("rsd") >= F.date_sub(F.lit("2001-01-01").cast("date"), 90)).alias("bu_last_90d"), k.alias("bu_clusters"), F.round(n / F.nullif(k, F.lit(0)), 5).alias("bu_density"))


@query(
    "country_seasonality",
    """, m AS (SELECT country, cluster, month(rsd) AS m, count(*) AS n FROM so WHERE rsd < DATE '2001-01-01' GROUP BY ALL) SELECT country, cluster, round((max(n) - min(n)) / greatest(avg(n), 1), 5) AS seasonality FROM m GROUP BY ALL""",
    orders=True,
)
def country_seasonality(spark: SparkSession, d: str) -> DataFrame:
    m = service_orders(spark, d).filter(F.col("rsd") < "2001-01-01").groupBy("country", "cluster", F.month("rsd").alias("m")).agg(F.count("*").alias("n"))
    return m.groupBy("country", "cluster").agg(F.round((F.max("n") - F.min("n")) / F.greatest(F.avg("n"), F.lit(1.0)), 5).alias("seasonality"))


@query(
    "trajectory",
    """, y AS (SELECT country, cluster, year(rsd) AS year, count(*) AS n FROM so WHERE rsd < DATE '2001-01-01' GROUP BY ALL),
    g AS (SELECT country, cluster, CASE WHEN max(year) > min(year) THEN pow(max_by(n, year) / min_by(n, year), 1.0 / (max(year) - min(year))) - 1 ELSE 0 END AS cagr, abs(coalesce(covar_pop(year, n) / nullif(stddev_pop(year) * stddev_pop(n), 0), 0)) AS trend_strength, coalesce(stddev_pop(n) / avg(n), 0) AS cv FROM y GROUP BY ALL)
    SELECT country, cluster, round(cagr, 5) AS cagr, round(trend_strength, 5) AS trend_strength, round(cv, 5) AS cv, CASE WHEN cv > 0.8 THEN 'Volatile' WHEN cagr > 0.15 AND trend_strength > 0.6 THEN 'Growing' WHEN cagr < -0.15 AND trend_strength > 0.6 THEN 'Declining' ELSE 'Stable' END AS trajectory_class FROM g""",
    orders=True,
)
def trajectory(spark: SparkSession, d: str) -> DataFrame:
    y = service_orders(spark, d).filter(F.col("rsd") < "2001-01-01").groupBy("country", "cluster", F.year("rsd").alias("year")).agg(F.count("*").alias("n"))
    return series.trajectory(y, ["country", "cluster"]).select("country", "cluster", *[F.round(c, 5).alias(c) for c in ("cagr", "trend_strength", "cv")], "trajectory_class")


@query(
    "tail_split",
    "WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) SELECT o_custkey, o_orderkey, (k > n * 0.9)::INTEGER AS is_validation FROM r",
)
def tail_split(spark: SparkSession, d: str) -> DataFrame:
    return series.tail_split(load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("recency_semi", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2000-10-03' AND o_orderdate < DATE '2001-01-01')")
def recency_semi(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders")
    recent = orders.filter((F.col("o_orderdate") >= "2000-10-03") & (F.col("o_orderdate") < "2001-01-01")).select("o_custkey").distinct()
    return orders.join(recent, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("cyclic_month", "SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS month_sin, round(cos(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS month_cos, (month(o_orderdate) % 3 = 0)::INTEGER AS quarter_end, (month(o_orderdate) + 8) % 12 + 1 AS fiscal_month FROM orders")
def cyclic_month(spark: SparkSession, d: str) -> DataFrame:
    m = F.month("o_orderdate")
    s, c = dates.cyclic(m)
    return load(spark, d, "orders").select("o_orderkey", (F.round(s, 6) + 0.0).alias("month_sin"), (F.round(c, 6) + 0.0).alias("month_cos"), dates.is_quarter_end(m).alias("quarter_end"), dates.fiscal_month("o_orderdate").alias("fiscal_month"))


@query("latest_per_key", "SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").groupBy("user_id").agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_ts"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))


@query(
    "event_buckets",
    "SELECT event_type, date_trunc('day', ts)::DATE AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    dates=("day",),
)
def event_buckets(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
