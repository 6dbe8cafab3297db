"""Queries of joins, forecast figures, planning views and warehouse changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.operators import forecast as fc
from fathom.operators import clean, match, warehouse
from fathom.plans.adapt import load, query, service_orders
from fathom.plans.q_aggregate import _FORECAST, forecast, ssd_floors

_FL = _FORECAST + """, fl AS (SELECT bu, cluster, (year(rsd) - 2001) * 12 + month(rsd) - 1 AS h, count(*) AS floor FROM so WHERE ssd < DATE '2001-01-01' AND (year(rsd) - 2001) * 12 + month(rsd) - 1 BETWEEN 0 AND 5 GROUP BY ALL),
g AS (SELECT f.*, coalesce(floor, 0) AS floor, greatest(predicted, coalesce(floor, 0)) AS corrected, coalesce(floor, 0) > predicted AS was_corrected FROM f LEFT JOIN fl USING (bu, cluster, h))"""


def guarded(spark: SparkSession, d: str) -> DataFrame:
    return fc.guardrail(forecast(spark, d), ssd_floors(spark, d).withColumnRenamed("window", "h"), ["bu", "cluster", "h"])


@query("equal_allocation", """, t AS (SELECT c_nationkey, count(*) AS k FROM customer GROUP BY 1), s AS (SELECT s_nationkey, sum(s_acctbal) AS bal FROM supplier GROUP BY 1) SELECT c_custkey, round(bal / k, 4) AS share FROM customer JOIN t USING (c_nationkey) LEFT JOIN s ON s_nationkey = c_nationkey""".replace(", t AS", "WITH t AS", 1))
def equal_allocation(spark: SparkSession, d: str) -> DataFrame:
    c, s = load(spark, d, "customer"), load(spark, d, "supplier").select(F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("share"))
    return match.equal_allocation(c, s, ["c_nationkey"], ["share"]).select("c_custkey", F.round("share", 4).alias("share"))


@query("key_overlap", "SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def key_overlap(spark: SparkSession, d: str) -> DataFrame:
    return match.shared_keys(load(spark, d, "customer").select(F.col("c_nationkey").alias("nation")), load(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")), ["nation"])


@query("group_size", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS group_size FROM orders")
def group_size(spark: SparkSession, d: str) -> DataFrame:
    return match.group_size(load(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"]).select("o_orderkey", "group_size")


@query("semi_anti_counts", "SELECT (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS with_lines, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS without_lines")
def semi_anti_counts(spark: SparkSession, d: str) -> DataFrame:
    o, line = load(spark, d, "orders"), load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    have = o.join(line, "o_orderkey", "left_semi").agg(F.count("*").alias("with_lines"))
    return have.crossJoin(o.join(line, "o_orderkey", "left_anti").agg(F.count("*").alias("without_lines")))


@query("fk_star_resolve", "SELECT c_custkey, n_nationkey AS nation_id, CASE WHEN c_custkey % 3 <> 2 THEN r_regionkey END AS region_id FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def fk_star_resolve(spark: SparkSession, d: str) -> DataFrame:
    nation, region = load(spark, d, "nation"), load(spark, d, "region")
    c = load(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    area = F.when(F.col("c_custkey") % 3 == 0, F.lower("r_name")).when(F.col("c_custkey") % 3 == 1, F.col("r_regionkey").cast("string")).otherwise("unknown")
    fact = c.select("c_custkey", F.concat(F.lit(" "), F.lower("n_name")).alias("country"), area.alias("area"))
    dims = {
        "nation_id": (nation.select("n_nationkey", "n_name"), ["country"], "n_nationkey"),
        "region_id": (match.either_name(region, "r_regionkey", ["r_name", "r_regionkey"]), ["area"], "r_regionkey"),
    }
    return match.resolved(fact, dims).select("c_custkey", "nation_id", "region_id")


@query("lateral_split", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS skill FROM part")
def lateral_split(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("skill"))


@query("null_safe_floor", """WITH a AS (SELECT nullif(o_orderstatus, 'P') AS s, nullif(o_orderpriority, '5-LOW') AS g, count(*) AS n FROM orders WHERE o_orderdate < DATE '1999-01-01' GROUP BY ALL),
b AS (SELECT nullif(o_orderstatus, 'P') AS s, nullif(o_orderpriority, '5-LOW') AS g, count(*) AS floor FROM orders WHERE o_orderdate >= DATE '1999-01-01' GROUP BY ALL) SELECT a.s, a.g, n, floor FROM a JOIN b ON a.s IS NOT DISTINCT FROM b.s AND a.g IS NOT DISTINCT FROM b.g""")
def null_safe_floor(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").withColumn("s", F.nullif("o_orderstatus", F.lit("P"))).withColumn("g", F.nullif("o_orderpriority", F.lit("5-LOW")))
    early = o.filter(F.col("o_orderdate") < "1999-01-01").groupBy("s", "g").agg(F.count("*").alias("n"))
    late = o.filter(F.col("o_orderdate") >= "1999-01-01").groupBy("s", "g").agg(F.count("*").alias("floor"))
    return match.null_safe(early, late, ["s", "g"])


@query("prior_horizon_lag", _FORECAST + " SELECT x.bu, x.cluster, x.h, x.predicted, y.predicted AS prior FROM f x LEFT JOIN f y ON x.bu = y.bu AND x.cluster = y.cluster AND x.h = y.h + 1", orders=True)
def prior_horizon_lag(spark: SparkSession, d: str) -> DataFrame:
    return match.against_prior(forecast(spark, d).select("bu", "cluster", "h", "predicted"), ["bu", "cluster"], "h", "predicted")


_TWO = "WITH a AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE year(o_orderdate) = 1999 GROUP BY 1)"


def _two(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = load(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"))
    return tuple(o.filter(F.col("y") == y).groupBy("k").agg(F.count("*").alias("v")) for y in (1996, 1999))  # type: ignore[return-value]


@query("full_outer_compare", _TWO + " SELECT coalesce(a.k, b.k) AS k, a.v AS individual, b.v AS global, a.v - b.v AS difference, CASE WHEN a.v IS NULL THEN 'global only' WHEN b.v IS NULL THEN 'individual only' ELSE 'both' END AS present FROM a FULL JOIN b ON a.k = b.k")
def full_outer_compare(spark: SparkSession, d: str) -> DataFrame:
    a, b = _two(spark, d)
    return match.compared(a, b, ["k"], "v", ("individual", "global"))


@query("anti_union", _TWO + " SELECT k, v FROM a UNION ALL SELECT k, v FROM b WHERE k NOT IN (SELECT k FROM a)")
def anti_union(spark: SparkSession, d: str) -> DataFrame:
    a, b = _two(spark, d)
    return match.preferred(a, b, ["k"])


@query("ssd_guardrail", _FL + " SELECT bu, cluster, h, actual, predicted, floor, corrected, was_corrected, CASE WHEN actual > 0 THEN round(100 * (1 - least(1, abs(actual - corrected) / actual)), 2) END AS accuracy, CASE WHEN actual > 0 THEN round(100 - abs(corrected - actual) * 100 / actual, 4) END AS uncapped FROM g", orders=True)
def ssd_guardrail(spark: SparkSession, d: str) -> DataFrame:
    g, a, c = guarded(spark, d), F.col("actual"), F.col("corrected")
    return g.withColumn("accuracy", fc.row_accuracy(a, c)).withColumn("uncapped", F.round(fc.uncapped_accuracy(a, c), 4))


@query("guardrail_summary", _FL + """ SELECT bu, cluster, sum(actual) AS total_actual, sum(predicted) AS total_predicted, sum(corrected) AS total_corrected, bool_or(was_corrected) AS any_corrected, count(*) FILTER (was_corrected) AS n_corrected,
CASE WHEN sum(actual) > 0 THEN round(100 * (1 - least(1, abs(sum(actual) - sum(predicted)) / sum(actual))), 2) END AS accuracy_before, CASE WHEN sum(actual) > 0 THEN round(100 * (1 - least(1, abs(sum(actual) - sum(corrected)) / sum(actual))), 2) END AS accuracy_after FROM g GROUP BY bu, cluster""", orders=True)
def guardrail_summary(spark: SparkSession, d: str) -> DataFrame:
    return fc.group_summary(guarded(spark, d), ["bu", "cluster"])


@query("improvement_summary", _FL + " SELECT h, count(*) FILTER (was_corrected) AS n_corrected, round(sum(corrected - predicted), 4) AS added, round(avg(abs(actual - predicted)) - avg(abs(actual - corrected)), 5) AS mae_gain FROM g GROUP BY GROUPING SETS ((h), ())", orders=True)
def improvement_summary(spark: SparkSession, d: str) -> DataFrame:
    a, p, c = F.col("actual"), F.col("predicted"), F.col("corrected")
    return guarded(spark, d).rollup("h").agg(F.count_if("was_corrected").alias("n_corrected"), F.round(F.sum(c - p), 4).alias("added"), F.round(F.avg(F.abs(a - p)) - F.avg(F.abs(a - c)), 5).alias("mae_gain"))


@query("demand_type_split", _FORECAST + ", r AS (SELECT bu, cluster, count(*) FILTER (req_type = 'Backfill') / count(*) AS ratio FROM so WHERE rsd < DATE '1995-06-01' GROUP BY ALL) SELECT bu, cluster, h, round(predicted * coalesce(ratio, 0.07), 5) AS backfill, round(predicted * (1 - coalesce(ratio, 0.07)), 5) AS new_demand FROM f LEFT JOIN r USING (bu, cluster)", orders=True)
def demand_type_split(spark: SparkSession, d: str) -> DataFrame:
    r = service_orders(spark, d).filter(F.col("rsd") < "1995-06-01").groupBy("bu", "cluster").agg((F.count_if(F.col("req_type") == "Backfill") / F.count("*")).alias("ratio"))
    out = fc.demand_split(forecast(spark, d).join(r, ["bu", "cluster"], "left"), "ratio")
    return out.select("bu", "cluster", "h", F.round("backfill", 5).alias("backfill"), F.round("new_demand", 5).alias("new_demand"))


@query("bias_class", _FORECAST + """, e AS (SELECT bu, cluster, CASE WHEN actual > 0 THEN (predicted - actual) / actual END AS e FROM f), b AS (SELECT bu, cluster, avg(e) AS m, stddev_samp(e) AS s, count(e) AS n, count(*) FILTER (e > 0.05) AS o, count(*) FILTER (e < -0.05) AS u FROM e GROUP BY ALL)
SELECT bu, cluster, round(m, 5) AS mean_error, round(s, 5) AS std_error, n, CASE WHEN o >= 0.75 * n AND m > 0.1 THEN 'systematic over' WHEN u >= 0.75 * n AND m < -0.1 THEN 'systematic under' WHEN s > 0.25 AND n >= 3 THEN 'high variance' ELSE 'fine' END AS bias FROM b""", orders=True)
def bias_class(spark: SparkSession, d: str) -> DataFrame:
    return fc.bias(forecast(spark, d), ["bu", "cluster"]).withColumn("mean_error", F.round("mean_error", 5)).withColumn("std_error", F.round("std_error", 5))


@query("alerts", _FL + """, pp AS (SELECT x.*, y.predicted AS prior FROM g x LEFT JOIN g y ON x.bu = y.bu AND x.cluster = y.cluster AND x.h = y.h + 1) SELECT bu, cluster, h, 'Demand Spike' AS alert, CASE WHEN predicted > 2 * prior THEN 'High' ELSE 'Medium' END AS severity FROM pp WHERE predicted > 1.5 * prior AND predicted > 50
UNION ALL SELECT bu, cluster, h, 'Accuracy Drop', 'Medium' FROM g WHERE CASE WHEN actual > 0 THEN round(100 * (1 - least(1, abs(actual - predicted) / actual)), 2) END < 80 UNION ALL SELECT bu, cluster, h, 'Short Fuse Surge', 'High' FROM g WHERE floor > 1.2 * predicted""", orders=True)
def alerts(spark: SparkSession, d: str) -> DataFrame:
    return fc.alerts(guarded(spark, d), ["bu", "cluster"])


@query("model_variant_choice", _FL + " SELECT variant FROM (SELECT 'seasonal' AS variant, sum(abs(actual - predicted)) AS e UNION ALL SELECT 'guarded', sum(abs(actual - corrected)) FROM g) t ORDER BY e, variant LIMIT 1".replace("SELECT 'seasonal' AS variant, sum(abs(actual - predicted)) AS e", "SELECT 'seasonal' AS variant, sum(abs(actual - predicted)) AS e FROM g"), orders=True)
def model_variant_choice(spark: SparkSession, d: str) -> DataFrame:
    e = guarded(spark, d).select(F.explode(F.array(F.struct(F.lit("seasonal").alias("variant"), F.abs(F.col("actual") - F.col("predicted")).alias("e")), F.struct(F.lit("guarded").alias("variant"), F.abs(F.col("actual") - F.col("corrected")).alias("e")))).alias("x"))
    return e.groupBy("x.variant").agg(F.sum("x.e").alias("e")).orderBy("e", "variant").limit(1).select("variant")


@query("forecast_overview", """, m AS (SELECT date_trunc('month', rsd) AS m, sum(qty) AS fte, sum(CASE WHEN status = 'P' THEN qty ELSE 0 END) AS cancelled FROM so GROUP BY ALL)
SELECT strftime(m, '%Y-%m') AS month, fte, round(cancelled * 100 / fte, 4) AS cancellation_pct, round((fte - lag(fte) OVER (ORDER BY m)) * 100 / lag(fte) OVER (ORDER BY m), 4) AS mom_pct, round((fte - lag(fte, 12) OVER (ORDER BY m)) * 100 / lag(fte, 12) OVER (ORDER BY m), 4) AS yoy_pct FROM m""", orders=True)
def forecast_overview(spark: SparkSession, d: str) -> DataFrame:
    m = service_orders(spark, d).groupBy(F.trunc("rsd", "month").alias("m")).agg(F.sum("qty").alias("fte"), F.sum(F.when(F.col("status") == "P", F.col("qty")).otherwise(0)).alias("cancelled"))
    w = Window.partitionBy(F.lit(0)).orderBy("m")  # one row a month
    change = lambda n: F.round((F.col("fte") - F.lag("fte", n).over(w)) * 100 / F.lag("fte", n).over(w), 4)
    return m.select(F.date_format("m", "yyyy-MM").alias("month"), "fte", F.round(F.col("cancelled") * 100 / F.col("fte"), 4).alias("cancellation_pct"), change(1).alias("mom_pct"), change(12).alias("yoy_pct"))


@query("month_grid", ", q AS (SELECT bu, month(rsd) AS m, sum(qty) AS v FROM so WHERE year(rsd) = 2000 GROUP BY ALL) SELECT bu, " + ", ".join(f"coalesce(sum(v) FILTER (m = {k}), 0) AS m{k:02d}" for k in range(1, 13)) + ", " + ", ".join(f"coalesce(sum(v) FILTER (m BETWEEN {3 * k - 2} AND {3 * k}), 0) AS q{k}" for k in range(1, 5)) + " FROM q GROUP BY bu", orders=True)
def month_grid(spark: SparkSession, d: str) -> DataFrame:
    so = clean.year_between(service_orders(spark, d), "rsd", 2000, 2000).withColumn("m", F.month("rsd"))
    p = so.groupBy("bu").pivot("m", list(range(1, 13))).agg(F.sum("qty")).na.fill(0.0)
    months = [F.col(str(k)).alias(f"m{k:02d}") for k in range(1, 13)]
    quarters = [sum((F.col(str(k)) for k in range(3 * q - 1, 3 * q + 1)), F.col(str(3 * q - 2))).alias(f"q{q}") for q in range(1, 5)]
    return p.select("bu", *months, *quarters)


@query("top_practices", "SELECT practice, total FROM (SELECT practice, sum(qty) AS total FROM so GROUP BY ALL) t ORDER BY total DESC, practice LIMIT 3", orders=True)
def top_practices(spark: SparkSession, d: str) -> DataFrame:
    return service_orders(spark, d).groupBy("practice").agg(F.sum("qty").alias("total")).orderBy(F.desc("total"), "practice").limit(3)


@query("demand_type_mix", "SELECT bu, strftime(rsd, '%Y-%m') AS month, sum(qty) AS total, sum(qty) FILTER (req_type = 'Backfill') AS backfill, round(coalesce(sum(qty) FILTER (req_type = 'Backfill'), 0) * 100 / sum(qty), 4) AS backfill_pct FROM so GROUP BY ALL", orders=True)
def demand_type_mix(spark: SparkSession, d: str) -> DataFrame:
    b = F.sum(F.when(F.col("req_type") == "Backfill", F.col("qty")))
    return service_orders(spark, d).groupBy("bu", F.date_format("rsd", "yyyy-MM").alias("month")).agg(F.sum("qty").alias("total"), b.alias("backfill"), F.round(F.coalesce(b, F.lit(0.0)) * 100 / F.sum("qty"), 4).alias("backfill_pct"))


@query("bu_performance", ", y AS (SELECT bu, sum(qty) FILTER (year(rsd) = 1999) AS a, sum(qty) FILTER (year(rsd) = 2000) AS b FROM so GROUP BY bu) SELECT bu, b AS demand, round(b / sum(b) OVER (), 6) AS share, round((b - a) * 100 / a, 4) AS yoy_pct, rank() OVER (ORDER BY b DESC) AS by_demand, rank() OVER (ORDER BY (b - a) / a DESC) AS by_growth FROM y", orders=True)
def bu_performance(spark: SparkSession, d: str) -> DataFrame:
    at = lambda y: F.sum(F.when(F.year("rsd") == y, F.col("qty")))
    y = service_orders(spark, d).groupBy("bu").agg(at(1999).alias("a"), at(2000).alias("b"))
    w = Window.partitionBy(F.lit(0))  # one row a business unit
    return y.select("bu", F.col("b").alias("demand"), F.round(F.col("b") / F.sum("b").over(w), 6).alias("share"), F.round((F.col("b") - F.col("a")) * 100 / F.col("a"), 4).alias("yoy_pct"), F.rank().over(w.orderBy(F.desc("b"))).cast("long").alias("by_demand"), F.rank().over(w.orderBy(F.desc((F.col("b") - F.col("a")) / F.col("a")))).cast("long").alias("by_growth"))


@query("country_month_grid", "SELECT country, " + ", ".join(f"coalesce(sum(qty) FILTER (month(rsd) = {k}), 0) AS m{k}" for k in range(1, 7)) + " FROM so WHERE year(rsd) = 2001 GROUP BY country", orders=True)
def country_month_grid(spark: SparkSession, d: str) -> DataFrame:
    so = clean.year_between(service_orders(spark, d), "rsd", 2001, 2001).withColumn("m", F.concat(F.lit("m"), F.month("rsd").cast("string")))
    return so.groupBy("country").pivot("m", [f"m{k}" for k in range(1, 7)]).agg(F.sum("qty")).na.fill(0.0)


@query("short_fuse_heatmap", """, h AS (SELECT grade, least(6, date_diff('day', ssd, rsd) // 7 + 1) AS week, count(*) AS n FROM so WHERE rsd >= ssd AND date_diff('day', ssd, rsd) < 42 GROUP BY ALL) SELECT grade, week, n, sum(n) OVER (PARTITION BY grade) AS row_total, round(n / max(n) OVER (), 6) AS intensity FROM h""", orders=True)
def short_fuse_heatmap(spark: SparkSession, d: str) -> DataFrame:
    days = F.datediff("rsd", "ssd")
    h = service_orders(spark, d).filter(days.between(0, 41)).groupBy("grade", F.least(F.lit(6), F.floor(days / 7) + 1).cast("long").alias("week")).agg(F.count("*").alias("n"))
    return h.withColumn("row_total", F.sum("n").over(Window.partitionBy("grade"))).withColumn("intensity", F.round(F.col("n") / F.max("n").over(Window.partitionBy(F.lit(0))), 6))


@query("grade_distribution", "SELECT grade, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(count(*) FILTER (date_diff('day', ssd, rsd) BETWEEN 0 AND 41) / count(*), 6) AS short_fuse_share FROM so GROUP BY grade", orders=True)
def grade_distribution(spark: SparkSession, d: str) -> DataFrame:
    g = service_orders(spark, d).groupBy("grade").agg(F.count("*").alias("n"), F.round(F.count_if(F.datediff("rsd", "ssd").between(0, 41)) / F.count("*"), 6).alias("short_fuse_share"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 6))


@query("demand_supply_gap", """, de AS (SELECT country, sum(qty) AS demand FROM so WHERE year(rsd) = 2000 GROUP BY ALL), su AS (SELECT n_name AS country, count(*) * 300.0 AS supply FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL), j AS (SELECT country, demand, coalesce(supply, 0) AS supply FROM de LEFT JOIN su USING (country))
SELECT country, demand, supply, demand - supply AS gap, round(CASE WHEN demand > 0 THEN (demand - supply) * 100 / demand ELSE 0 END, 4) AS gap_pct, CASE WHEN demand > 0 AND (demand - supply) * 100 / demand > 25 THEN 'Critical' WHEN demand > 0 AND (demand - supply) * 100 / demand > 15 THEN 'Warning' ELSE 'OK' END AS status FROM j""", orders=True)
def demand_supply_gap(spark: SparkSession, d: str) -> DataFrame:
    de = clean.year_between(service_orders(spark, d), "rsd", 2000, 2000).groupBy("country").agg(F.sum("qty").alias("demand"))
    su = load(spark, d, "supplier").join(load(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("country")).agg((F.count("*") * 300.0).alias("supply"))
    j = de.join(su, "country", "left").withColumn("supply", F.coalesce("supply", F.lit(0.0)))
    dm, sp = F.col("demand"), F.col("supply")
    return j.select("country", "demand", "supply", (dm - sp).alias("gap"), F.round(F.when(dm > 0, (dm - sp) * 100 / dm).otherwise(0.0), 4).alias("gap_pct"), fc.gap_status(dm, sp).alias("status"))


@query("executive_summary", "SELECT 'demand' AS kpi, round(sum(qty), 2) AS value FROM so UNION ALL SELECT 'orders', count(DISTINCT order_id) FROM so UNION ALL SELECT 'open_share', round(avg((status = 'O')::INT), 6) FROM so UNION ALL SELECT 'countries', count(DISTINCT country) FROM so UNION ALL SELECT 'backfill_share', round(avg((req_type = 'Backfill')::INT), 6) FROM so", orders=True)
def executive_summary(spark: SparkSession, d: str) -> DataFrame:
    one = service_orders(spark, d).agg(F.round(F.sum("qty"), 2).alias("demand"), F.count_distinct("order_id").cast("double").alias("orders"), F.round(F.avg((F.col("status") == "O").cast("int")), 6).alias("open_share"), F.count_distinct("country").cast("double").alias("countries"), F.round(F.avg((F.col("req_type") == "Backfill").cast("int")), 6).alias("backfill_share"))
    return one.unpivot([], one.columns, "kpi", "value")


@query("scenario_simulate", ", m AS (SELECT bu, month(rsd) AS m, sum(qty) AS v FROM so WHERE year(rsd) = 2000 GROUP BY ALL) SELECT bu, m, kind, amount FROM (SELECT bu, m, 'baseline' AS kind, floor(v)::BIGINT AS amount FROM m UNION ALL SELECT bu, m, 'scenario', floor(v * 1.25)::BIGINT FROM m UNION ALL SELECT bu, m, 'adjustment', floor(v * 1.25)::BIGINT - floor(v)::BIGINT FROM m) t", orders=True)
def scenario_simulate(spark: SparkSession, d: str) -> DataFrame:
    m = clean.year_between(service_orders(spark, d), "rsd", 2000, 2000).groupBy("bu", F.month("rsd").alias("m")).agg(F.sum("qty").alias("v"))
    return fc.scenario(m, "v", bu=0.125, market=0.25)


@query("scenario_impact", "SELECT bu, round(sum(qty) * (0.4 * 0.1 + 0.3 * 0.05 + 0.2 * 0.1 + 0.1 * 0.2), 4) AS demand_impact, round(sum(qty) * (0.4 * 0.1 + 0.3 * 0.05 + 0.2 * 0.1 + 0.1 * 0.2) * 0.55, 4) AS gap_impact FROM so GROUP BY bu", orders=True)
def scenario_impact(spark: SparkSession, d: str) -> DataFrame:
    factor = 0.4 * 0.1 + 0.3 * 0.05 + 0.2 * 0.1 + 0.1 * 0.2
    return service_orders(spark, d).groupBy("bu").agg(F.round(F.sum("qty") * factor, 4).alias("demand_impact"), F.round(F.sum("qty") * factor * 0.55, 4).alias("gap_impact"))


@query("feedback_totals", _FORECAST + ", aa AS (SELECT *, CASE WHEN h < 2 THEN 3 ELSE -1 END AS adj FROM f) SELECT bu, sum(predicted) AS system_forecast, sum(adj) AS adjustment, sum(predicted + adj) AS final_forecast, round(sum(adj) * 100 / sum(predicted), 5) AS impact_pct, round(0.92 * sum(predicted + adj), 4) AS hc_target FROM aa GROUP BY bu", orders=True)
def feedback_totals(spark: SparkSession, d: str) -> DataFrame:
    a = forecast(spark, d).withColumn("adj", F.when(F.col("h") < 2, 3).otherwise(-1))
    p, j = F.sum("predicted"), F.sum("adj")
    return a.groupBy("bu").agg(p.alias("system_forecast"), j.alias("adjustment"), F.sum(F.col("predicted") + F.col("adj")).alias("final_forecast"), F.round(j * 100 / p, 5).alias("impact_pct"), F.round(0.92 * F.sum(F.col("predicted") + F.col("adj")), 4).alias("hc_target"))


@query("status_counts", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("severity_order", "SELECT o_orderpriority AS severity, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END AS place, count(*) AS n FROM orders GROUP BY ALL ORDER BY place, severity LIMIT 4 OFFSET 1")
def severity_order(spark: SparkSession, d: str) -> DataFrame:
    place = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(3)
    return load(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("severity"), place.alias("place")).agg(F.count("*").alias("n")).orderBy("place", "severity").offset(1).limit(4)


@query("top_and_rest", "WITH g AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, k) AS p FROM g) SELECT k, n, CASE WHEN p <= 5 THEN 'top' WHEN p <= 15 THEN 'remainder' ELSE 'remaining' END AS part FROM r")
def top_and_rest(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    top = g.orderBy(F.desc("n"), "k").limit(15).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "k"))).alias("a")).select(F.posexplode("a").alias("p", "x")).select("x.k", "p")
    return g.join(F.broadcast(top), "k", "left").select("k", "n", F.when(F.col("p") < 5, "top").when(F.col("p") < 15, "remainder").otherwise("remaining").alias("part"))


@query("nulls_last_page", "SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS grade FROM orders ORDER BY grade ASC NULLS LAST, o_orderkey LIMIT 10 OFFSET 30")
def nulls_last_page(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("grade")).orderBy(F.asc_nulls_last("grade"), "o_orderkey").offset(30).limit(10)


@query("upsert_fact", "WITH o AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0) SELECT o_orderkey, round(o_totalprice, 2) AS price FROM n UNION ALL SELECT o_orderkey, round(o_totalprice, 2) FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)")
def upsert_fact(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    new = o.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return warehouse.upserted(o.filter("o_orderkey % 3 <> 0"), new, ["o_orderkey"]).select("o_orderkey", F.round("o_totalprice", 2).alias("price"))


@query("insert_if_absent", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS skill FROM part UNION SELECT 'welding'")
def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    old = spark.createDataFrame([("welding",), ("bolt",)], "skill string")
    return warehouse.with_missing(old, load(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("skill")), ["skill"])


@query("update_from", "SELECT c_custkey, CASE WHEN k IS NOT NULL THEN c_acctbal + k ELSE c_acctbal END AS balance FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) t ON c_custkey = o_custkey")
def update_from(spark: SparkSession, d: str) -> DataFrame:
    k = load(spark, d, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"))
    c = load(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    return warehouse.updated(c, k, ["c_custkey"], {"balance": F.col("balance") + F.col("k")})


@query("json_predictions", "SELECT u.user_id AS bu, (u.props::JSON->>'k')::INT AS k, count(*) AS n FROM events u GROUP BY ALL")
def json_predictions(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").select("user_id", F.from_json("props", "k int").alias("p"))
    return e.groupBy(F.col("user_id").alias("bu"), F.col("p.k").alias("k")).agg(F.count("*").alias("n"))


@query("batch_tagging", "SELECT o_orderstatus, 'b1' AS batch_id, count(*) AS n FROM orders GROUP BY ALL")
def batch_tagging(spark: SparkSession, d: str) -> DataFrame:
    return warehouse.tagged(load(spark, d, "orders"), "b1").groupBy("o_orderstatus", "batch_id").agg(F.count("*").alias("n"))
