"""Queries of the aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.operators import aggregate as agg
from fathom.plans.adapt import load, query, service_orders


@query("value_counts_share", "SELECT grade AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM so), 4) AS pct FROM so GROUP BY grade", orders=True)
def value_counts_share(spark: SparkSession, d: str) -> DataFrame:
    return agg.value_counts(service_orders(spark, d), "grade").drop("label")


@query("value_counts_by_market", "SELECT market, bu AS value, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY market), 4) AS pct FROM so GROUP BY market, bu", orders=True)
def value_counts_by_market(spark: SparkSession, d: str) -> DataFrame:
    return agg.value_counts(service_orders(spark, d), "bu", ["market"]).drop("label")


@query("demand_grouping_sets", "SELECT market, year(rsd) AS y, bu, sum(qty) AS demand, grouping(year(rsd)) AS all_years FROM so GROUP BY GROUPING SETS ((market, bu), (market, year(rsd), bu))", orders=True)
def demand_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    df = service_orders(spark, d).withColumn("y", F.year("rsd"))
    return df.groupingSets([["market", "bu"], ["market", "y", "bu"]], "market", "y", "bu").agg(F.sum("qty").alias("demand"), F.grouping("y").cast("long").alias("all_years"))


@query(
    "demand_monthly",
    """SELECT market, bu, year(rsd) AS year, month(rsd) AS month, sum(qty) AS demand, sum(CASE WHEN status = 'O' THEN qty ELSE 0 END) AS open_demand, sum(CASE WHEN status = 'P' THEN qty ELSE 0 END) AS cancelled,
    CASE WHEN sum(qty) > 0 THEN round(sum(CASE WHEN status = 'P' THEN qty ELSE 0 END) * 100 / sum(qty), 2) ELSE 0 END AS cancellation_pct FROM so GROUP BY ALL""",
    orders=True,
)
def demand_monthly(spark: SparkSession, d: str) -> DataFrame:
    return agg.monthly_demand(service_orders(spark, d), ["market", "bu"])


@query(
    "four_level_demand",
    """SELECT bu, country, grade, cluster, grouping_id(bu, country, grade, cluster) AS level, count(*) AS n, sum(qty) AS demand FROM so
    GROUP BY GROUPING SETS ((cluster), (bu, cluster), (country, grade, cluster), (bu, grade, country, cluster))""",
    orders=True,
)
def four_level_demand(spark: SparkSession, d: str) -> DataFrame:
    keys = ["bu", "country", "grade", "cluster"]
    sets = [["cluster"], ["bu", "cluster"], ["country", "grade", "cluster"], keys]
    return service_orders(spark, d).groupingSets(sets, *keys).agg(F.grouping_id(*keys).alias("level"), F.count("*").alias("n"), F.sum("qty").alias("demand"))


@query(
    "freshness",
    "SELECT count(*) AS n, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day, count(DISTINCT o_custkey) AS accounts, count(*) FILTER (o_orderstatus = 'O') AS open_orders, count(*) FILTER (o_orderstatus = 'O') / count(*) AS open_share FROM orders",
    dates=("first_day", "last_day"),
)
def freshness(spark: SparkSession, d: str) -> DataFrame:
    open_ = F.count_if(F.col("o_orderstatus") == "O")
    return load(spark, d, "orders").agg(F.count("*").alias("n"), F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"), F.count_distinct("o_custkey").alias("accounts"), open_.alias("open_orders"), (open_ / F.count("*")).alias("open_share"))


@query("model_accuracy_rollup", "SELECT event_type, count(*) FILTER (value > 50) AS n_high, count(*) AS n, round(avg(value), 6) AS avg_value FROM events GROUP BY event_type")
def model_accuracy_rollup(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("n_high"), F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("avg_value"))


@query(
    "pipeline_health",
    "SELECT user_id, count(*) AS n, 100.0 * count(*) FILTER (event_type = 'error') / nullif(count(*), 0) AS drop_pct, epoch(max(ts)) - epoch(min(ts)) AS seconds FROM events GROUP BY user_id",
)
def pipeline_health(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("ts").cast("timestamp").cast("double")
    n = F.count("*")
    return load(spark, d, "events").groupBy("user_id").agg(n.alias("n"), (100.0 * F.count_if(F.col("event_type") == "error") / F.nullif(n, F.lit(0))).alias("drop_pct"), (F.max(t) - F.min(t)).alias("seconds"))


@query(
    "ssd_floors",
    """SELECT bu, cluster, (year(rsd) - 2001) * 12 + month(rsd) - 1 AS "window", count(*) AS floor FROM so WHERE ssd < DATE '2001-01-01' AND (year(rsd) - 2001) * 12 + month(rsd) - 1 BETWEEN 0 AND 5 GROUP BY ALL""",
    orders=True,
)
def ssd_floors(spark: SparkSession, d: str) -> DataFrame:
    return agg.months_ahead_floors(service_orders(spark, d), ["bu", "cluster"], F.lit("2001-01-01").cast("date"))


_YEARS = ", y AS (SELECT cluster, year(rsd) AS year, count(*) AS n FROM so GROUP BY ALL)"


@query("cv_pop", f"{_YEARS} SELECT cluster, round(stddev_pop(n) / avg(n), 6) AS cv FROM y GROUP BY cluster", orders=True)
def cv_pop(spark: SparkSession, d: str) -> DataFrame:
    by = service_orders(spark, d).groupBy("cluster", F.year("rsd").alias("year")).agg(F.count("*").alias("n"))
    return agg.variation(by, ["cluster"], "n").select("cluster", F.round("cv", 6).alias("cv"))


@query(
    "cv_sample_monthly",
    ", m AS (SELECT country, cluster, date_trunc('month', rsd) AS m, count(*) AS n FROM so GROUP BY ALL) SELECT country, cluster, round(coalesce(stddev_samp(n) / avg(n), 0), 6) AS cv FROM m GROUP BY ALL",
    orders=True,
)
def cv_sample_monthly(spark: SparkSession, d: str) -> DataFrame:
    by = service_orders(spark, d).groupBy("country", "cluster", F.trunc("rsd", "month").alias("m")).agg(F.count("*").alias("n"))
    return agg.variation(by, ["country", "cluster"], "n", sample=True, missing=0.0).withColumn("cv", F.round("cv", 6))


@query(
    "xyz",
    """, m AS (SELECT country, cluster, date_trunc('month', rsd) AS m, count(*) AS n FROM so GROUP BY ALL), c AS (SELECT country, cluster, round(coalesce(stddev_samp(n) / avg(n), 0), 6) AS cv FROM m GROUP BY ALL)
    SELECT country, CASE WHEN cv < 0.5 THEN 'X' WHEN cv <= 1.0 THEN 'Y' ELSE 'Z' END AS segment, count(*) AS n, round(avg(greatest(0, least(1, 1 - cv))), 4) AS stability FROM c GROUP BY ALL""",
    orders=True,
)
def xyz(spark: SparkSession, d: str) -> DataFrame:
    stability = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("cv")))
    return cv_sample_monthly(spark, d).groupBy("country", agg.xyz("cv").alias("segment")).agg(F.count("*").alias("n"), F.round(F.avg(stability), 4).alias("stability"))


@query(
    "eligibility",
    """, m AS (SELECT bu, cluster, date_trunc('month', rsd) AS m, sum(qty) AS target FROM so GROUP BY ALL)
    SELECT bu, cluster, count(*) AS rows, round(avg(target), 6) AS mean, sum(target) AS total, count(DISTINCT m) AS windows, count(*) >= 70 AND avg(target) >= 10 AS eligible FROM m GROUP BY bu, cluster""",
    orders=True,
)
def eligibility(spark: SparkSession, d: str) -> DataFrame:
    by = service_orders(spark, d).groupBy("bu", "cluster", F.trunc("rsd", "month").alias("m")).agg(F.sum("qty").alias("target"))
    ok = (F.count("*") >= 70) & (F.avg("target") >= 10)
    return by.groupBy("bu", "cluster").agg(F.count("*").alias("rows"), F.round(F.avg("target"), 6).alias("mean"), F.sum("target").alias("total"), F.count_distinct("m").alias("windows"), ok.alias("eligible"))


@query(
    "backfill_ratio",
    ", g AS (SELECT bu, cluster, count(*) FILTER (req_type = 'Backfill') / count(*) AS ratio FROM so GROUP BY ALL) SELECT bu, cluster, round(ratio, 6) AS ratio, round(coalesce(avg(ratio) OVER (PARTITION BY bu), 0.07), 6) AS level_ratio FROM g",
    orders=True,
)
def backfill_ratio(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    by = service_orders(spark, d).groupBy("bu", "cluster").agg((F.count_if(F.col("req_type") == "Backfill") / F.count("*")).alias("ratio"))
    level = F.coalesce(F.avg("ratio").over(Window.partitionBy("bu")), F.lit(0.07))
    return by.select("bu", "cluster", F.round("ratio", 6).alias("ratio"), F.round(level, 6).alias("level_ratio"))


@query(
    "mode_feature",
    ", c AS (SELECT cluster, grade, count(*) AS n FROM so GROUP BY ALL) SELECT cluster, grade AS usual FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, grade) AS k FROM c) t WHERE k = 1",
    orders=True,
)
def mode_feature(spark: SparkSession, d: str) -> DataFrame:
    return agg.mode_of(service_orders(spark, d), ["cluster"], "grade", "usual")


@query("distinct_join_string", "SELECT account, string_agg(DISTINCT practice, ' | ' ORDER BY practice) AS practices FROM so GROUP BY account", orders=True)
def distinct_join_string(spark: SparkSession, d: str) -> DataFrame:
    return service_orders(spark, d).groupBy("account").agg(agg.joined_values("practice").alias("practices"))


@query("any_value_flag", "SELECT o_orderkey, nullif(o_orderstatus, 'O') IS NOT NULL OR nullif(o_orderpriority, '1-URGENT') IS NOT NULL AS has_any FROM orders")
def any_value_flag(spark: SparkSession, d: str) -> DataFrame:
    cols = [F.nullif("o_orderstatus", F.lit("O")), F.nullif("o_orderpriority", F.lit("1-URGENT"))]
    return load(spark, d, "orders").select("o_orderkey", F.coalesce(*cols).isNotNull().alias("has_any"))


@query("geography_stats", "SELECT market, country, sum(qty) AS total, round(avg(qty), 6) AS mean, count(*) AS n, round(sum(qty) / sum(sum(qty)) OVER (), 8) AS share FROM so GROUP BY ALL", orders=True)
def geography_stats(spark: SparkSession, d: str) -> DataFrame:
    by = service_orders(spark, d).groupBy("market", "country").agg(F.sum("qty").alias("total"), F.round(F.avg("qty"), 6).alias("mean"), F.count("*").alias("n"))
    return by.crossJoin(by.agg(F.sum("total").alias("_t"))).withColumn("share", F.round(F.col("total") / F.col("_t"), 8)).drop("_t")


@query(
    "trailing_year_totals",
    ", t AS (SELECT * FROM so WHERE rsd >= (SELECT max(rsd) FROM so) - INTERVAL 365 DAY) SELECT dim, value, total, round(total / sum(total) OVER (PARTITION BY dim), 8) AS share FROM (SELECT 'bu' AS dim, bu AS value, sum(qty) AS total FROM t GROUP BY ALL UNION ALL SELECT 'country', country, sum(qty) FROM t GROUP BY ALL UNION ALL SELECT 'grade', grade, sum(qty) FROM t GROUP BY ALL UNION ALL SELECT 'practice', practice, sum(qty) FROM t GROUP BY ALL) u",
    orders=True,
)
def trailing_year_totals(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    last = load(spark, d, "orders").join(load(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").agg(F.to_date(F.max("o_orderdate")).alias("last"))
    recent = service_orders(spark, d).crossJoin(F.broadcast(last)).filter(F.col("rsd") >= F.date_sub("last", 365))
    dims = ["bu", "country", "grade", "practice"]
    one = recent.groupingSets([[c] for c in dims], *dims).agg(F.sum("qty").alias("total"), F.grouping_id(*dims).alias("g"))
    value = F.coalesce(*dims)
    dim = F.when(F.col("g") == 0b0111, "bu").when(F.col("g") == 0b1011, "country").when(F.col("g") == 0b1101, "grade").otherwise("practice")
    return one.select(dim.alias("dim"), value.alias("value"), "total").withColumn("share", F.round(F.col("total") / F.sum("total").over(Window.partitionBy("dim")), 8))


@query("market_totals", "SELECT market, sum(qty) AS total, count(*) AS n FROM so GROUP BY market", orders=True)
def market_totals(spark: SparkSession, d: str) -> DataFrame:
    return service_orders(spark, d).groupBy("market").agg(F.sum("qty").alias("total"), F.count("*").alias("n"))


@query(
    "describe_stats",
    """WITH s AS (SELECT count(*) AS n, avg(o_totalprice) AS mean, quantile_cont(o_totalprice, 0.5) AS median, stddev_samp(o_totalprice) AS std, skewness(o_totalprice) AS skew, kurtosis(o_totalprice) AS kurtosis,
    quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
    SELECT n, round(mean, 4) AS mean, round(median, 4) AS median, round(std, 4) AS std, round(skew, 6) AS skew, round(kurtosis, 6) AS kurtosis, round(q1, 4) AS q1, round(q3, 4) AS q3,
    (SELECT count(*) FROM orders WHERE o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS outliers FROM s""",
)
def describe_stats(spark: SparkSession, d: str) -> DataFrame:
    out = agg.moments(load(spark, d, "orders"), "o_totalprice")
    return out.select("n", *[F.round(c, 4).alias(c) for c in ("mean", "median", "std", "q1", "q3")], *[F.round(c, 6).alias(c) for c in ("skew", "kurtosis")], "outliers")


def _bucket_sql(unit: str) -> str:
    return f""", b AS (SELECT bu, date_trunc('{unit}', rsd) AS bucket, sum(qty) AS total FROM so GROUP BY ALL)
    SELECT bu, count(*) AS buckets, round(avg(total), 6) AS mean, round(stddev_samp(total), 6) AS std, round(stddev_samp(total) / avg(total), 6) AS cv FROM b GROUP BY bu"""


def _buckets(spark: SparkSession, d: str, unit: str) -> DataFrame:
    by = service_orders(spark, d).groupBy("bu", F.date_trunc(unit, "rsd").alias("bucket")).agg(F.sum("qty").alias("total"))
    return by.groupBy("bu").agg(F.count("*").alias("buckets"), F.round(F.avg("total"), 6).alias("mean"), F.round(F.stddev_samp("total"), 6).alias("std"), F.round(F.stddev_samp("total") / F.avg("total"), 6).alias("cv"))


for _unit in ("day", "week", "month"):
    query(f"bucket_{_unit}", _bucket_sql(_unit), orders=True)(lambda spark, d, u=_unit: _buckets(spark, d, u))


@query(
    "weekday_means",
    ", b AS (SELECT rsd, sum(qty) AS total FROM so GROUP BY ALL) SELECT isodow(rsd) AS weekday, round(avg(total), 6) AS mean, count(*) AS days FROM b GROUP BY ALL",
    orders=True,
)
def weekday_means(spark: SparkSession, d: str) -> DataFrame:
    by = service_orders(spark, d).groupBy("rsd").agg(F.sum("qty").alias("total"))
    return by.groupBy((F.weekday("rsd") + 1).alias("weekday")).agg(F.round(F.avg("total"), 6).alias("mean"), F.count("*").alias("days"))


@query(
    "stable_volatile",
    """, m AS (SELECT bu, date_trunc('month', rsd) AS m, sum(qty) AS t FROM so GROUP BY ALL), s AS (SELECT *, avg(t) OVER (PARTITION BY bu) AS a, stddev_samp(t) OVER (PARTITION BY bu) AS sd FROM m)
    SELECT bu, count(*) FILTER (t BETWEEN a - sd AND a + sd) AS stable, count(*) FILTER (NOT (t BETWEEN a - sd AND a + sd)) AS volatile FROM s GROUP BY bu""",
    orders=True,
)
def stable_volatile(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    w = Window.partitionBy("bu")
    by = service_orders(spark, d).groupBy("bu", F.trunc("rsd", "month").alias("m")).agg(F.sum("qty").alias("t"))
    inside = F.col("t").between(F.col("a") - F.col("sd"), F.col("a") + F.col("sd"))
    return by.withColumn("a", F.avg("t").over(w)).withColumn("sd", F.stddev_samp("t").over(w)).groupBy("bu").agg(F.count_if(inside).alias("stable"), F.count_if(~inside).alias("volatile"))


@query(
    "bu_trend_stats",
    ", m AS (SELECT bu, year(rsd) AS y, month(rsd) AS m, sum(qty) AS t FROM so GROUP BY ALL) SELECT bu, m AS month, round(avg(t), 4) AS mean, round(quantile_cont(t, 0.5), 4) AS median, round(stddev_samp(t), 4) AS std FROM m GROUP BY bu, m",
    orders=True,
)
def bu_trend_stats(spark: SparkSession, d: str) -> DataFrame:
    by = service_orders(spark, d).groupBy("bu", F.year("rsd").alias("y"), F.month("rsd").alias("month")).agg(F.sum("qty").alias("t"))
    return by.groupBy("bu", "month").agg(F.round(F.avg("t"), 4).alias("mean"), F.round(F.percentile("t", F.lit(0.5)), 4).alias("median"), F.round(F.stddev_samp("t"), 4).alias("std"))


@query(
    "pearson_spearman",
    """WITH r AS (SELECT l_quantity AS x, l_extendedprice AS y, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx,
    rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem) SELECT round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM r""",
)
def pearson_spearman(spark: SparkSession, d: str) -> DataFrame:
    return agg.spearman(load(spark, d, "lineitem"), "l_quantity", "l_extendedprice").select(F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"))


@query(
    "target_encoding",
    """, c AS (SELECT country, count(*) AS n FROM so GROUP BY ALL), top AS (SELECT country FROM (SELECT country, row_number() OVER (ORDER BY n DESC, country) AS k FROM c) t WHERE k <= 10),
    e AS (SELECT coalesce(top.country, '__OTHER__') AS level, qty FROM so LEFT JOIN top USING (country)) SELECT level, round(avg(qty), 6) AS encoded, count(*) AS n FROM e GROUP BY level""",
    orders=True,
)
def target_encoding(spark: SparkSession, d: str) -> DataFrame:
    df = service_orders(spark, d)
    top = df.groupBy("country").count().orderBy(F.desc("count"), "country").limit(10).select("country", F.col("country").alias("level"))
    return df.join(F.broadcast(top), "country", "left").groupBy(F.coalesce("level", F.lit("__OTHER__")).alias("level")).agg(F.round(F.avg("qty"), 6).alias("encoded"), F.count("*").alias("n"))


@query(
    "correlated_features",
    """SELECT round(corr(l_quantity, l_extendedprice), 6) AS quantity_price, round(corr(l_quantity, l_discount), 6) AS quantity_discount, round(corr(l_extendedprice, l_tax), 6) AS price_tax, count(DISTINCT l_linestatus) = 1 AS status_constant FROM lineitem""",
)
def correlated_features(spark: SparkSession, d: str) -> DataFrame:
    pair = lambda a, b: F.round(F.corr(a, b), 6)
    return load(spark, d, "lineitem").agg(pair("l_quantity", "l_extendedprice").alias("quantity_price"), pair("l_quantity", "l_discount").alias("quantity_discount"), pair("l_extendedprice", "l_tax").alias("price_tax"), (F.count_distinct("l_linestatus") == 1).alias("status_constant"))


@query("split_month_counts", "SELECT CASE WHEN rsd < DATE '2000-07-01' THEN 'train' WHEN rsd < DATE '2001-01-01' THEN 'dev' ELSE 'test' END AS split, date_trunc('month', rsd)::DATE AS month, count(*) AS n FROM so GROUP BY ALL", orders=True, dates=("month",))
def split_month_counts(spark: SparkSession, d: str) -> DataFrame:
    split = F.when(F.col("rsd") < "2000-07-01", "train").when(F.col("rsd") < "2001-01-01", "dev").otherwise("test")
    return service_orders(spark, d).groupBy(split.alias("split"), F.trunc("rsd", "month").alias("month")).agg(F.count("*").alias("n"))


_FORECAST = """, a AS (SELECT bu, cluster, (year(rsd) - 2001) * 12 + month(rsd) - 1 AS h, sum(qty) AS actual FROM so WHERE rsd >= DATE '2001-01-01' AND rsd < DATE '2001-07-01' GROUP BY ALL),
p AS (SELECT bu, cluster, month(rsd) - 1 AS h, sum(qty) AS predicted FROM so WHERE rsd >= DATE '2000-01-01' AND rsd < DATE '2000-07-01' GROUP BY ALL),
f AS (SELECT coalesce(a.bu, p.bu) AS bu, coalesce(a.cluster, p.cluster) AS cluster, coalesce(a.h, p.h) AS h, coalesce(actual, 0) AS actual, coalesce(predicted, 0) AS predicted FROM a FULL JOIN p ON a.bu = p.bu AND a.cluster = p.cluster AND a.h = p.h)"""


def forecast(spark: SparkSession, d: str) -> DataFrame:
    """(bu, cluster, h, actual, predicted): the first half of 2001 forecast by the same months a year before."""
    so = service_orders(spark, d).filter((F.col("rsd") >= "2000-01-01") & (F.col("rsd") < "2001-07-01") & (F.month("rsd") <= 6))
    year = F.year("rsd")
    part = lambda y: F.coalesce(F.sum(F.when(year == y, F.col("qty"))), F.lit(0.0))
    return so.groupBy("bu", "cluster", (F.month("rsd") - 1).alias("h")).agg(part(2001).alias("actual"), part(2000).alias("predicted"))


@query(
    "pivot_horizon",
    _FORECAST + " SELECT bu, cluster, " + ", ".join(f"coalesce(sum(actual) FILTER (h = {k}), 0) AS M{k}_Actual, coalesce(sum(predicted) FILTER (h = {k}), 0) AS M{k}_Predicted" for k in range(6)) + " FROM f GROUP BY bu, cluster",
    orders=True,
)
def pivot_horizon(spark: SparkSession, d: str) -> DataFrame:
    p = forecast(spark, d).groupBy("bu", "cluster").pivot("h", list(range(6))).agg(F.sum("actual").alias("Actual"), F.sum("predicted").alias("Predicted")).na.fill(0)
    return p.select("bu", "cluster", *[F.col(f"{k}_{x}").alias(f"M{k}_{x}") for k in range(6) for x in ("Actual", "Predicted")])


@query(
    "horizon_metrics",
    _FORECAST + """ SELECT bu, h, grouping(h) AS all_horizons, sum(actual) AS total_actual, sum(predicted) AS total_predicted, round(avg(CASE WHEN actual > 0 THEN abs(actual - predicted) / actual * 100 END), 5) AS mape,
    round(1 - avg(CASE WHEN actual > 0 THEN least(abs(actual - predicted) / actual, 1) END), 6) AS accuracy, round(avg(abs(actual - predicted)), 5) AS mae, round(sqrt(avg((actual - predicted) ** 2)), 5) AS rmse,
    round(avg(200 * abs(predicted - actual) / (abs(predicted) + abs(actual) + 1e-8)), 5) AS smape, round((sum(predicted) - sum(actual)) * 100 / nullif(sum(actual), 0), 5) AS volume_error_pct
    FROM f GROUP BY GROUPING SETS ((bu, h), (bu), (h), ())""",
    orders=True,
)
def horizon_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = agg.horizon_metrics(forecast(spark, d), ["bu"], "h", "actual", "predicted")
    return out.select("bu", "h", F.col("all_horizons").cast("long").alias("all_horizons"), "total_actual", "total_predicted", *[F.round(c, 5).alias(c) for c in ("mape", "mae", "rmse", "smape", "volume_error_pct")], F.round("accuracy", 6).alias("accuracy"))


@query(
    "weighted_avg",
    _FORECAST + ", g AS (SELECT bu, sum(actual) AS w, CASE WHEN sum(actual) > 0 THEN 100 * (1 - least(1, abs(sum(actual) - sum(predicted)) / sum(actual))) END AS acc FROM f GROUP BY bu, cluster) SELECT bu, round(sum(acc * w) / sum(w) FILTER (acc IS NOT NULL), 5) AS weighted_accuracy, round(avg(acc), 5) AS plain_accuracy FROM g GROUP BY bu",
    orders=True,
)
def weighted_avg(spark: SparkSession, d: str) -> DataFrame:
    a, p = F.sum("actual"), F.sum("predicted")
    g = forecast(spark, d).groupBy("bu", "cluster").agg(a.alias("w"), F.when(a > 0, 100 * (1 - F.least(F.lit(1.0), F.abs(a - p) / a))).alias("acc"))
    return g.groupBy("bu").agg(F.round(agg.weighted("acc", "w"), 5).alias("weighted_accuracy"), F.round(F.avg("acc"), 5).alias("plain_accuracy"))
