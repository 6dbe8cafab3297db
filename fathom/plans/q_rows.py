"""Queries of fact bundles, lookups, point-in-time targets, sections, views, seeds and composite figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.operators import clean, match, series, sets, warehouse
from fathom.operators import forecast as fc
from fathom.operators.aggregate import weighted, xyz
from fathom.plans.adapt import load, query, service_orders
from fathom.plans.q_aggregate import _FORECAST, forecast
from fathom.plans.q_forecast import _FL, guarded
from fathom.plans.q_series import _POINTS, KEYS


@query("grade_nulled", "SELECT CASE WHEN lower(trim(o_orderpriority)) NOT IN ('5-low', '4-not specified') THEN o_orderpriority END AS grade, count(*) AS n FROM orders GROUP BY 1")
def grade_nulled(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").groupBy(clean.without_values("o_orderpriority", ["5-LOW", "4-NOT SPECIFIED"]).alias("grade")).agg(F.count("*").alias("n"))


@query(
    "fact_bundle",
    """SELECT market, bu, count(*) AS n, sum(qty) AS qty FROM (SELECT *, nullif(grade, '5-LOW') AS reason, nullif(grade, '4-NOT SPECIFIED') AS kept FROM so) q
    WHERE upper(trim(status)) IN ('O', 'F') AND upper(trim(market)) IN ('AMERICA', 'EUROPE') AND upper(trim(req_type)) = 'NEW DEMAND' AND upper(trim(bu)) IN ('BUILDING', 'MACHINERY', 'FURNITURE')
    AND (reason IS NULL OR trim(reason) IN ('NA', '1-URGENT', '2-HIGH')) AND kept IS NOT NULL AND (ssd IS NULL OR rsd >= ssd - 60) AND year(rsd) BETWEEN 1996 AND 1999
    AND practice IN (SELECT p_type FROM part WHERE p_size > 20) GROUP BY ALL""",
    orders=True,
)
def fact_bundle(spark: SparkSession, d: str) -> DataFrame:
    so = service_orders(spark, d).withColumn("reason", F.nullif("grade", F.lit("5-LOW"))).withColumn("kept", F.nullif("grade", F.lit("4-NOT SPECIFIED"))).withColumn("submitted", F.date_sub("ssd", 60))
    allowed = {"status": ["O", "F"], "market": ["AMERICA", "EUROPE"], "req_type": ["NEW DEMAND"], "bu": ["BUILDING", "MACHINERY", "FURNITURE"]}
    practices = load(spark, d, "part").filter("p_size > 20").select(F.col("p_type").alias("practice"))
    rows = clean.fact_rows(so, allowed, ("reason", ["1-URGENT", "2-HIGH"]), "kept", ("rsd", "submitted"), (1996, 1999), ("practice", practices))
    return rows.groupBy("market", "bu").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))


@query("row_matcher", "SELECT event_id FROM events WHERE coalesce(lower(props::JSON->>'k') IN ('3', '7', '12'), true) AND coalesce(lower(props::JSON->>'region') IN ('emea'), true)")
def row_matcher(spark: SparkSession, d: str) -> DataFrame:
    row = F.from_json("props", "map<string,string>")
    return load(spark, d, "events").filter(clean.matches(row, {"k": ["3", "7", "12"], "region": ["EMEA"]})).select("event_id")


_NAMES = [("bolt", "fastener"), ("nut", "fastener"), ("fastener", "fastener"), ("hot", "warm")]


@query(
    "ordered_normaliser",
    f"""WITH t AS (SELECT p_partkey, unnest(string_split(p_name || ' bolt nut', ' ')) AS t, generate_subscripts(string_split(p_name || ' bolt nut', ' '), 1) AS i FROM part),
    n AS (SELECT p_partkey, coalesce(c, t) AS name, min(i) AS i FROM t LEFT JOIN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _NAMES)}) AS v(v, c) ON v = trim(t) WHERE trim(t) <> '' GROUP BY ALL)
    SELECT p_partkey, string_agg(name, ', ' ORDER BY i) AS skills FROM n GROUP BY p_partkey""",
)
def ordered_normaliser(spark: SparkSession, d: str) -> DataFrame:
    cells = load(spark, d, "part").select("p_partkey", F.split(F.concat("p_name", F.lit(" bolt nut")), " ").alias("skills"))
    return sets.in_order(cells, "p_partkey", "skills", spark.createDataFrame(_NAMES, "variant string, canonical string")).withColumn("skills", F.array_join("skills", ", "))


_LOADED = """, g AS (SELECT bu, country, (month(rsd) - 1)::INT AS horizon, count(*)::DOUBLE AS predicted FROM so WHERE rsd >= DATE '2001-01-01' AND rsd < DATE '2001-07-01' GROUP BY ALL),
old AS (SELECT DISTINCT bu, n_nationkey AS country_id, h::INT AS horizon, -1.0::DOUBLE AS predicted FROM so JOIN nation ON n_name = country, (SELECT unnest(range(0, 8)) AS h) x)"""


@query(
    "load_predictions",
    _LOADED + """, new AS (SELECT bu, n_nationkey AS country_id, horizon, predicted FROM g JOIN nation ON n_name = country)
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.bu = old.bu AND new.country_id = old.country_id AND new.horizon = old.horizon)""",
    orders=True,
)
def load_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Predictions come as a JSON array for each business unit; names become ids; they replace rows of the same key."""
    so, nation = service_orders(spark, d), load(spark, d, "nation")
    rows = so.filter((F.col("rsd") >= "2001-01-01") & (F.col("rsd") < "2001-07-01")).groupBy("bu", F.lower("country").alias("country"), (F.month("rsd") - 1).alias("horizon")).agg(F.count("*").cast("double").alias("predicted"))
    payload = rows.groupBy("bu").agg(F.to_json(F.collect_list(F.struct("bu", "country", "horizon", "predicted"))).alias("json"))
    new = warehouse.predictions_from_json(payload, "json", {"country_id": (nation.select("n_nationkey", "n_name"), ["country"], "n_nationkey")}).select("bu", "country_id", "horizon", "predicted")
    places = so.select("bu", "country").distinct().join(nation, F.col("n_name") == F.col("country")).select("bu", F.col("n_nationkey").alias("country_id"))
    old = places.withColumn("horizon", F.explode(F.sequence(F.lit(0), F.lit(7)))).withColumn("predicted", F.lit(-1.0))
    return warehouse.upserted(old, new, ["bu", "country_id", "horizon"])


@query(
    "point_in_time_lookup",
    """, c AS (SELECT country, year(rsd) AS y, month(rsd) AS m, count(*) AS n FROM so GROUP BY ALL), k AS (SELECT DISTINCT country, cluster, date_trunc('month', rsd)::DATE AS month FROM so WHERE rsd >= DATE '2000-01-01')
    SELECT country, cluster, month, coalesce(n, 0) AS n FROM k LEFT JOIN c USING (country) WHERE false UNION ALL
    SELECT k.country, k.cluster, k.month, coalesce(c.n, 0) FROM k LEFT JOIN c ON c.country = k.country AND c.y = year(k.month - INTERVAL 1 MONTH) AND c.m = month(k.month - INTERVAL 1 MONTH)""",
    orders=True,
    dates=("month",),
)
def point_in_time_lookup(spark: SparkSession, d: str) -> DataFrame:
    """What the row's country had in the month before."""
    so = service_orders(spark, d)
    table = so.groupBy("country", F.year("rsd").alias("y"), F.month("rsd").alias("m")).agg(F.count("*").alias("n"))
    rows = so.filter(F.col("rsd") >= "2000-01-01").select("country", "cluster", F.trunc("rsd", "month").alias("month")).distinct()
    before = F.add_months("month", -1)
    return match.looked_up(rows.withColumn("y", F.year(before)).withColumn("m", F.month(before)), table, ["country", "y", "m"], "n").select("country", "cluster", "month", "n")


@query(
    "target_encoded_rows",
    """WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), top AS (SELECT c_nationkey FROM (SELECT *, row_number() OVER (ORDER BY n DESC, c_nationkey) AS k FROM c) q WHERE k <= 10),
    l AS (SELECT c_custkey, c_acctbal, coalesce(t.c_nationkey, -1) AS level FROM customer c LEFT JOIN top t ON t.c_nationkey = c.c_nationkey), e AS (SELECT level, avg(c_acctbal) AS encoded FROM l GROUP BY 1)
    SELECT c_custkey, l.level, round(encoded, 5) AS encoded FROM l JOIN e USING (level)""",
)
def target_encoded_rows(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    top = c.groupBy("c_nationkey").count().orderBy(F.desc("count"), "c_nationkey").limit(10).select("c_nationkey", F.col("c_nationkey").alias("level"))
    rows = c.join(F.broadcast(top), "c_nationkey", "left").withColumn("level", F.coalesce("level", F.lit(-1)))
    means = rows.groupBy("level").agg(F.round(F.avg("c_acctbal"), 5).alias("encoded"))
    return rows.join(means, "level").select("c_custkey", "level", "encoded")


@query(
    "view_model_accuracy",
    _FL + """, r AS (SELECT DISTINCT bu FROM so), pa AS (SELECT *, CASE WHEN actual > 0 THEN round(100 * (1 - least(1, abs(actual - corrected) / actual)), 2) END AS acc FROM g WHERE bu <> 'BUILDING')
    SELECT r.bu AS run, count(pa.h) AS prediction_rows, count(pa.h) FILTER (was_corrected) AS guardrail_corrections, round(avg(acc), 3) AS avg_corrected_accuracy FROM r LEFT JOIN pa ON pa.bu = r.bu GROUP BY r.bu""",
    orders=True,
)
def view_model_accuracy(spark: SparkSession, d: str) -> DataFrame:
    runs = load(spark, d, "customer").select(F.col("c_mktsegment").alias("run")).distinct()
    p = guarded(spark, d).filter("bu <> 'BUILDING'").withColumn("acc", fc.row_accuracy(F.col("actual"), F.col("corrected")))
    by_run = p.groupBy(F.col("bu").alias("run")).agg(F.count("h").alias("prediction_rows"), F.count_if("was_corrected").alias("guardrail_corrections"), F.round(F.avg("acc"), 3).alias("avg_corrected_accuracy"))
    return runs.join(by_run, "run", "left").na.fill(0, ["prediction_rows", "guardrail_corrections"])


@query(
    "view_open_alerts",
    _FL + """, al AS (SELECT bu, cluster, h, 'Short Fuse Surge' AS alert, 'High' AS severity FROM g WHERE floor > 1.2 * predicted UNION ALL SELECT bu, cluster, h, 'Accuracy Drop', 'Medium' FROM g WHERE CASE WHEN actual > 0 THEN round(100 * (1 - least(1, abs(actual - predicted) / actual)), 2) END < 80
    UNION ALL SELECT x.bu, x.cluster, x.h, 'Demand Spike', CASE WHEN x.predicted > 2 * y.predicted THEN 'High' ELSE 'Medium' END FROM g x JOIN g y ON x.bu = y.bu AND x.cluster = y.cluster AND x.h = y.h + 1 WHERE x.predicted > 1.5 * y.predicted AND x.predicted > 50),
    cl AS (SELECT p_brand AS cluster, min(p_type) AS maker FROM part WHERE p_brand <> 'Brand#11' GROUP BY 1)
    SELECT alert, severity, bu, al.cluster, maker, h, CASE severity WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS place FROM al LEFT JOIN cl ON cl.cluster = al.cluster WHERE h < 3""",
    orders=True,
)
def view_open_alerts(spark: SparkSession, d: str) -> DataFrame:
    makers = load(spark, d, "part").filter("p_brand <> 'Brand#11'").groupBy(F.col("p_brand").alias("cluster")).agg(F.min("p_type").alias("maker"))
    place = F.when(F.col("severity") == "High", 1).when(F.col("severity") == "Medium", 2).otherwise(3)
    rows = fc.alerts(guarded(spark, d), ["bu", "cluster"]).filter("h < 3").join(makers, "cluster", "left")
    return rows.select("alert", "severity", "bu", "cluster", "maker", "h", place.alias("place"))


@query(
    "view_skill_growth",
    """, g AS (SELECT cluster, market, count(*) FILTER (year(rsd) = 1998) AS demand_1998, count(*) FILTER (year(rsd) = 1999) AS demand_1999, count(*) FILTER (year(rsd) = 2000) AS demand_2000 FROM so GROUP BY ALL)
    SELECT cluster, maker, market, r_regionkey AS market_id, demand_1998, demand_1999, demand_2000, round((sqrt(demand_2000 / demand_1998) - 1) * 100, 4) AS cagr_pct FROM g JOIN (SELECT p_brand AS cluster, min(p_type) AS maker FROM part GROUP BY 1) p USING (cluster) JOIN region ON r_name = market WHERE demand_1998 > 0""",
    orders=True,
)
def view_skill_growth(spark: SparkSession, d: str) -> DataFrame:
    at = lambda y: F.count_if(F.year("rsd") == y).alias(f"demand_{y}")
    g = service_orders(spark, d).groupBy("cluster", "market").agg(at(1998), at(1999), at(2000)).filter("demand_1998 > 0")
    makers = load(spark, d, "part").groupBy(F.col("p_brand").alias("cluster")).agg(F.min("p_type").alias("maker"))
    region = load(spark, d, "region").select(F.col("r_name").alias("market"), F.col("r_regionkey").alias("market_id"))
    cagr = F.round((F.sqrt(F.col("demand_2000") / F.col("demand_1998")) - 1) * 100, 4).alias("cagr_pct")
    return g.join(makers, "cluster").join(region, "market").select("cluster", "maker", "market", "market_id", "demand_1998", "demand_1999", "demand_2000", cagr)


@query(
    "group_cv",
    """, m AS (SELECT country, cluster, date_trunc('month', rsd) AS m, count(*) FILTER (status = 'P') AS n FROM so GROUP BY ALL)
    SELECT country, cluster, round(CASE WHEN avg(n) <> 0 THEN stddev_samp(n) / avg(n) END, 5) AS cv, avg(n) = 0 AS endless FROM m GROUP BY ALL""",
    orders=True,
)
def group_cv(spark: SparkSession, d: str) -> DataFrame:
    """Variation of monthly counts; a mean of 0 counts as endless."""
    m = service_orders(spark, d).groupBy("country", "cluster", F.trunc("rsd", "month").alias("m")).agg(F.count_if(F.col("status") == "P").alias("n"))
    return m.groupBy("country", "cluster").agg(F.round(F.try_divide(F.stddev_samp("n"), F.avg("n")), 5).alias("cv"), (F.avg("n") == 0).alias("endless"))


@query("anchor_month", _POINTS + " SELECT year(max(cutoff)) AS year, month(max(cutoff)) AS month FROM pt", orders=True)
def anchor_month(spark: SparkSession, d: str) -> DataFrame:
    return series.cutoffs(service_orders(spark, d), "rsd").agg(F.year(F.max("cutoff")).cast("long").alias("year"), F.month(F.max("cutoff")).cast("long").alias("month"))


@query(
    "label_month_totals",
    _FORECAST + """, ind AS (SELECT * FROM f WHERE cluster < 'Brand#3'), glo AS (SELECT bu, cluster, h, actual, predicted * 2 AS predicted FROM f), w AS (SELECT * FROM ind UNION ALL SELECT * FROM glo WHERE (bu, cluster) NOT IN (SELECT (bu, cluster) FROM ind))
    SELECT bu, h, sum(actual) AS actual, sum(predicted) AS predicted FROM w GROUP BY ALL""",
    orders=True,
)
def label_month_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals by month over group labels; where a label was forecast by itself, that wins over the global forecast."""
    f = forecast(spark, d)
    best = match.preferred(f.filter("cluster < 'Brand#3'"), f.withColumn("predicted", F.col("predicted") * 2), ["bu", "cluster"])
    return best.groupBy("bu", "h").agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))


_M0 = _FORECAST + ", o AS (SELECT bu, cluster, coalesce(nullif(sum(actual) FILTER (h = 0), 0), count(*))::DOUBLE AS m0, coalesce(sum(actual) FILTER (h = 0), 0) > 0 AS known FROM f GROUP BY ALL)"


def m0_totals(spark: SparkSession, d: str) -> DataFrame:
    """What each group has in the first month; the number of its rows where that is nothing."""
    first = F.sum(F.when(F.col("h") == 0, F.col("actual")))
    return forecast(spark, d).groupBy("bu", "cluster").agg(F.coalesce(F.nullif(first, F.lit(0.0)), F.count("*").cast("double")).alias("m0"), (F.coalesce(first, F.lit(0.0)) > 0).alias("known"))


@query("m0_totals", _M0 + " SELECT bu, cluster, m0, known FROM o", orders=True)
def m0_total_query(spark: SparkSession, d: str) -> DataFrame:
    return m0_totals(spark, d)


@query("group_order", _M0 + " SELECT bu, cluster, m0, row_number() OVER (PARTITION BY bu ORDER BY known DESC, m0 DESC, cluster)::INT AS place FROM o", orders=True)
def group_order(spark: SparkSession, d: str) -> DataFrame:
    """The order in which a business unit's groups are shown: by first month, unknown ones last."""
    w = Window.partitionBy("bu").orderBy(F.desc("known"), F.desc("m0"), "cluster")
    return m0_totals(spark, d).select("bu", "cluster", "m0", F.row_number().over(w).alias("place"))


@query("top_candidates", "SELECT p_brand AS cluster, sum(l_quantity) AS demand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY demand DESC, cluster LIMIT 10")
def top_candidates(spark: SparkSession, d: str) -> DataFrame:
    return service_orders(spark, d).groupBy("cluster").agg(F.sum("qty").alias("demand")).orderBy(F.desc("demand"), "cluster").limit(10)


@query(
    "totals_per_cutoff",
    _POINTS + """ SELECT pt.bu, pt.cutoff, count(so.bu) AS bu_total, count(so.bu) FILTER (rsd >= cutoff - 90) AS bu_last_90d, round(count(so.bu) FILTER (month(rsd) = month(cutoff)) / greatest(count(DISTINCT year(rsd)), 1), 5) AS same_month_rate FROM pt LEFT JOIN so ON so.bu = pt.bu AND rsd < cutoff GROUP BY ALL""",
    orders=True,
    dates=("cutoff",),
)
def totals_per_cutoff(spark: SparkSession, d: str) -> DataFrame:
    """Hierarchy figures as they stood before each cutoff. The rate of the cutoff's calendar month comes from counts by
    (group, month), joined with the few cutoffs after them."""
    so = service_orders(spark, d).select("bu", "rsd")
    points = so.select("bu").distinct().crossJoin(series.cutoffs(so, "rsd"))
    total = series.totals_before(so, points, ["bu"], "rsd", "cutoff").withColumnRenamed("total", "bu_total")
    recent = series.events_before(so, points, ["bu"], "rsd", "cutoff", (90,)).select("bu", "cutoff", F.col("events_last_90d").alias("bu_last_90d"))
    daily = so.groupBy("bu", "rsd").agg(F.count("*").alias("n"))
    monthly = daily.groupBy("bu", F.month("rsd").alias("m"), F.year("rsd").alias("y")).agg(F.collect_list(F.struct("rsd", "n")).alias("days"), F.min("rsd").alias("first"))  # a month has 31 days at most
    p = points.withColumn("m", F.month("cutoff"))
    same = p.join(monthly.select("bu", "m", F.explode("days").alias("x")), ["bu", "m"]).filter("x.rsd < cutoff").groupBy("bu", "cutoff").agg(F.sum("x.n").alias("same"))
    years = p.join(monthly.groupBy("bu", "y").agg(F.min("first").alias("first")), "bu").filter("first < cutoff").groupBy("bu", "cutoff").agg(F.count("*").alias("years"))
    out = total.join(recent, ["bu", "cutoff"]).join(same, ["bu", "cutoff"], "left").join(years, ["bu", "cutoff"], "left")
    rate = F.round(F.coalesce("same", F.lit(0)) / F.greatest(F.coalesce("years", F.lit(0)), F.lit(1)), 5)
    return out.select("bu", "cutoff", "bu_total", "bu_last_90d", rate.alias("same_month_rate"))


@query(
    "bridge_from_predictions",
    _FORECAST + """, b AS (SELECT bu, cluster, count(*) FILTER (rsd >= DATE '2000-12-01') AS b1, count(*) / 3.0 AS bm FROM so WHERE rsd >= DATE '2000-10-01' AND rsd < DATE '2001-01-01' GROUP BY ALL), m AS (SELECT bu, cluster, coalesce(sum(predicted) FILTER (h = 0), 0) AS m0, coalesce(sum(predicted) FILTER (h = 1), 0) AS m1 FROM f GROUP BY ALL)
    SELECT bu, cluster, m0, m1, coalesce(b1, 0) AS before_1, round(coalesce(bm, 0), 6) AS before_mean, round(CASE WHEN bm > 0 THEN (m0 + m1) / 2 / bm ELSE 0 END, 5) AS bridge_ratio FROM m LEFT JOIN b USING (bu, cluster)""",
    orders=True,
)
def bridge_from_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Bridge features of the test months: the first two months are predictions, the three before are actuals."""
    at = lambda h: F.coalesce(F.sum(F.when(F.col("h") == h, F.col("predicted"))), F.lit(0.0))
    m = forecast(spark, d).groupBy(*KEYS).agg(at(0).alias("m0"), at(1).alias("m1"))
    b = service_orders(spark, d).filter((F.col("rsd") >= "2000-10-01") & (F.col("rsd") < "2001-01-01")).groupBy(*KEYS).agg(F.count_if(F.col("rsd") >= "2000-12-01").alias("b1"), (F.count("*") / 3.0).alias("bm"))
    ratio = F.when(F.col("bm") > 0, (F.col("m0") + F.col("m1")) / 2 / F.col("bm")).otherwise(0.0)
    return m.join(b, KEYS, "left").select(*KEYS, "m0", "m1", F.coalesce("b1", F.lit(0)).alias("before_1"), F.round(F.coalesce("bm", F.lit(0.0)), 6).alias("before_mean"), F.round(ratio, 5).alias("bridge_ratio"))


@query(
    "horizon_targets",
    _POINTS + """, c AS (SELECT pt.bu, pt.cutoff, count(so.bu) AS before FROM pt LEFT JOIN so ON so.bu = pt.bu AND rsd < cutoff GROUP BY ALL HAVING count(so.bu) >= 3), h AS (SELECT c.bu, cutoff, months_ahead, date_trunc('month', cutoff + to_months(months_ahead::INTEGER))::DATE AS month FROM c, (SELECT unnest(range(0, 6)) AS months_ahead) x),
    mc AS (SELECT bu, date_trunc('month', rsd)::DATE AS month, count(*) AS n FROM so GROUP BY ALL) SELECT h.bu, cutoff, months_ahead, coalesce(n, 0) AS target FROM h LEFT JOIN mc ON mc.bu = h.bu AND mc.month = h.month WHERE h.month <= (SELECT date_trunc('month', max(rsd)) FROM so) AND h.bu IN (SELECT bu FROM so GROUP BY bu HAVING count(*) >= 3)""",
    orders=True,
    dates=("cutoff",),
)
def horizon_targets(spark: SparkSession, d: str) -> DataFrame:
    so = service_orders(spark, d).select("bu", "rsd")
    points = series.horizons(so.select("bu").distinct().crossJoin(series.cutoffs(so, "rsd")))
    return series.targets(so, points, ["bu"], "rsd", "cutoff", "months_ahead").select("bu", "cutoff", "months_ahead", "target")


@query(
    "history_split",
    """SELECT split, count(*) AS n, min(rsd) AS first, max(rsd) AS last FROM (SELECT 'train' AS split, rsd FROM so WHERE rsd < DATE '2000-07-01' UNION ALL SELECT 'dev', rsd FROM so WHERE rsd >= DATE '2000-07-01' AND rsd < DATE '2001-01-01' UNION ALL SELECT 'test', rsd FROM so) q GROUP BY split""",
    orders=True,
    dates=("first", "last"),
)
def history_split(spark: SparkSession, d: str) -> DataFrame:
    """Train and dev by fixed dates; the test part keeps the whole history, as its features look back."""
    part = F.when(F.col("rsd") < "2000-07-01", "train").when(F.col("rsd") < "2001-01-01", "dev")
    rows = service_orders(spark, d).select("rsd", F.explode(F.array_compact(F.array(part, F.lit("test")))).alias("split"))
    return rows.groupBy("split").agg(F.count("*").alias("n"), F.min("rsd").alias("first"), F.max("rsd").alias("last"))


_MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


@query(
    "overlapping_split",
    """, c AS (SELECT country, year(rsd) AS year, month(rsd) AS month, nullif(count(*) FILTER (status <> 'P'), 0) AS n FROM so GROUP BY ALL) SELECT 'train' AS part, country, year, month, coalesce(n, 0) AS n FROM c WHERE year <= 2000 UNION ALL SELECT 'test', country, year, month, coalesce(n, 0) FROM c WHERE year >= 2000""",
    orders=True,
)
def overlapping_split(spark: SparkSession, d: str) -> DataFrame:
    """A series by month name, split into parts that both hold the year 2000; missing counts are 0."""
    named = service_orders(spark, d).groupBy("country", F.year("rsd").alias("year"), F.date_format("rsd", "MMM").alias("name")).agg(F.nullif(F.count_if(F.col("status") != "P"), F.lit(0)).alias("n"))
    number = F.create_map(*[F.lit(x) for k, m in enumerate(_MONTHS, 1) for x in (m, k)])
    numbered = named.withColumn("month", number[F.col("name")]).na.fill(0, ["n"])
    parts = F.array_compact(F.array(F.when(F.col("year") <= 2000, "train"), F.when(F.col("year") >= 2000, "test")))
    return numbered.select(F.explode(parts).alias("part"), "country", "year", "month", "n")


@query(
    "count_slope",
    """, w AS (SELECT country, cluster, rsd, row_number() OVER (PARTITION BY country, cluster ORDER BY rsd) - 1 AS y FROM so WHERE rsd < DATE '2001-01-01' AND rsd >= DATE '2001-01-01' - 90)
    SELECT country, cluster, round(coalesce(CASE WHEN count(DISTINCT rsd) > 1 THEN regr_slope(y, date_diff('day', DATE '2000-01-01', rsd)) END, 0), 5) AS slope FROM w GROUP BY ALL""",
    orders=True,
)
def count_slope(spark: SparkSession, d: str) -> DataFrame:
    return series.count_slope(service_orders(spark, d), ["country", "cluster"], "rsd", "2001-01-01").withColumn("slope", F.round("slope", 5) + 0.0)


@query(
    "uplf_features",
    """WITH u AS (SELECT c_mktsegment AS segment, c_custkey, unnest([24290, 24291, 24292]) AS t, unnest([c_acctbal, nullif(c_custkey % 3, 0) * 100.0, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 2 END]) AS value FROM customer),
    k AS (SELECT segment, row_number() OVER (ORDER BY segment) - 1 AS code FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer) q)
    SELECT c_custkey, code, coalesce(arg_max(value, t) FILTER (value IS NOT NULL), 0) AS last_forecast, coalesce(sum(value), 0) AS total FROM u JOIN k USING (segment) GROUP BY ALL""",
)
def uplf_features(spark: SparkSession, d: str) -> DataFrame:
    """From wide month columns: the last forecast there is, the total, and a code of the category."""
    from fathom.functions.dates import month_of_column

    c = load(spark, d, "customer")
    wide = c.select("c_custkey", "c_mktsegment", F.col("c_acctbal").alias("Mar-24_Forecast"), (F.nullif(F.col("c_custkey") % 3, F.lit(0)) * 100.0).alias("Apr-24_Forecast"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal") + 2).alias("May-24_Forecast"))
    ordered = [n for _, n in sorted((month_of_column(n), n) for n in wide.columns if month_of_column(n))]
    last = F.coalesce(*[F.col(f"`{n}`") for n in reversed(ordered)], F.lit(0.0))
    total = sum((F.coalesce(F.col(f"`{n}`"), F.lit(0.0)) for n in ordered), F.lit(0.0))
    codes = c.select("c_mktsegment").distinct().withColumn("code", F.row_number().over(Window.orderBy("c_mktsegment")).cast("long") - 1)  # a row for each category
    return wide.join(F.broadcast(codes), "c_mktsegment").select("c_custkey", "code", last.alias("last_forecast"), total.alias("total"))


@query("pipeline_steps", """, g AS (SELECT 1) SELECT * FROM (VALUES (0, 'grades', 'completed'), (1, 'bundle', 'completed'), (2, 'upsert', 'completed')) AS v(position, step, status) JOIN (SELECT 0 AS position, count(*) AS rows_out FROM orders UNION ALL SELECT 1, count(*) FROM orders WHERE o_orderstatus IN ('O', 'F') UNION ALL SELECT 2, count(DISTINCT o_custkey) FROM orders) c USING (position)""".replace(", g AS (SELECT 1) ", "", 1))
def pipeline_steps(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders")
    latest = lambda: warehouse.upserted(o.limit(0).select("o_custkey", "o_orderkey"), o.select("o_custkey", "o_orderkey"), ["o_custkey"], F.desc("o_orderkey"))
    steps = [("grades", lambda: o.withColumn("o_orderpriority", clean.without_values("o_orderpriority", ["5-LOW"]))), ("bundle", lambda: clean.keep_values(o, {"o_orderstatus": ["O", "F"]})), ("upsert", latest)]
    return warehouse.orchestrated(steps, spark)


@query("seeded_countries", "SELECT n_name AS country, n_regionkey AS market_id FROM nation UNION ALL SELECT 'ATLANTIS', r_regionkey FROM region WHERE r_name = 'EUROPE' UNION ALL SELECT 'LEMURIA', NULL")
def seeded_countries(spark: SparkSession, d: str) -> DataFrame:
    dim = load(spark, d, "nation").select(F.col("n_name").alias("country"), F.col("n_regionkey").alias("market_id"))
    rows = [("ATLANTIS", "EUROPE"), ("NATION_9", "ASIA"), ("LEMURIA", "NOWHERE")]
    return warehouse.seeded(dim, rows, "country string, market string", {"market": (load(spark, d, "region"), "r_name", "r_regionkey")})


_SUMMARY = _FL + """, su AS (SELECT bu, cluster, sum(actual) AS total_actual, sum(corrected) AS total_corrected, CASE WHEN sum(actual) > 0 THEN round(100 * (1 - least(1, abs(sum(actual) - sum(corrected)) / sum(actual))), 2) END AS accuracy_after FROM g GROUP BY ALL),
pl AS (SELECT *, row_number() OVER (ORDER BY total_actual DESC, bu, cluster) AS k FROM su), se AS (SELECT *, CASE WHEN k <= 5 THEN 'Individual' WHEN k <= 15 THEN 'Global' ELSE 'Remainder' END AS section FROM pl)"""


@query(
    "guardrail_sections",
    _SUMMARY + """ SELECT section, bu, cluster, total_actual, accuracy_after FROM se UNION ALL SELECT section, 'Weighted average', NULL, sum(total_actual), round(sum(accuracy_after * total_actual) FILTER (accuracy_after IS NOT NULL) / sum(total_actual) FILTER (accuracy_after IS NOT NULL), 4) FROM se GROUP BY section""",
    orders=True,
)
def guardrail_sections(spark: SparkSession, d: str) -> DataFrame:
    """The summary's sections, each with its average accuracy weighted by demand."""
    s = fc.sections(fc.group_summary(guarded(spark, d), KEYS), "total_actual", 5, 10, KEYS)
    means = s.groupBy("section").agg(F.sum("total_actual").alias("total_actual"), F.round(weighted("accuracy_after", "total_actual"), 4).alias("accuracy_after"))
    head = means.select("section", F.lit("Weighted average").alias("bu"), F.lit(None).cast("string").alias("cluster"), "total_actual", "accuracy_after")
    return s.select(*head.columns).unionByName(head)


@query(
    "rescaled_split",
    _FL + """, r AS (SELECT bu, cluster, count(*) FILTER (req_type = 'Backfill') / count(*) AS ratio FROM so WHERE rsd < DATE '1995-06-01' GROUP BY ALL)
    SELECT bu, cluster, h, round(predicted * coalesce(ratio, 0.07) * CASE WHEN predicted > 0 THEN corrected / predicted ELSE 1 END, 5) AS backfill, round(predicted * (1 - coalesce(ratio, 0.07)) * CASE WHEN predicted > 0 THEN corrected / predicted ELSE 1 END, 5) AS new_demand FROM g LEFT JOIN r USING (bu, cluster)""",
    orders=True,
)
def rescaled_split(spark: SparkSession, d: str) -> DataFrame:
    r = service_orders(spark, d).filter(F.col("rsd") < "1995-06-01").groupBy(*KEYS).agg((F.count_if(F.col("req_type") == "Backfill") / F.count("*")).alias("ratio"))
    out = fc.rescaled(fc.demand_split(guarded(spark, d).join(r, KEYS, "left"), "ratio"), ["backfill", "new_demand"], "predicted", "corrected")
    return out.select(*KEYS, "h", F.round("backfill", 5).alias("backfill"), F.round("new_demand", 5).alias("new_demand"))


@query(
    "late_horizon_bias",
    _FORECAST + """, g AS (SELECT bu, cluster, count(*) FILTER (predicted < 1e-6) AS none, avg(abs(predicted - actual) / actual) AS a, avg((predicted - actual) / actual) AS m FROM f WHERE h BETWEEN 3 AND 6 AND actual > 0 GROUP BY ALL)
    SELECT bu, cluster, CASE WHEN g.m IS NULL THEN 'none' WHEN none >= 1 OR a > 0.5 THEN 'low visibility' WHEN m < -0.15 THEN 'underprediction' WHEN m > 0.15 THEN 'overprediction' ELSE 'none' END AS late FROM (SELECT DISTINCT bu, cluster FROM f) k LEFT JOIN g USING (bu, cluster)""",
    orders=True,
)
def late_horizon_bias(spark: SparkSession, d: str) -> DataFrame:
    return fc.late_bias(forecast(spark, d), KEYS)


@query(
    "quarter_growth",
    """, q AS (SELECT year(rsd) * 4 + quarter(rsd) - 1 AS q, sum(qty) AS fte FROM so GROUP BY ALL) SELECT q.q AS quarter, q.fte, round((q.fte - p.fte) * 100 / p.fte, 4) AS qoq_pct, round((q.fte - y.fte) * 100 / y.fte, 4) AS yoy_pct FROM q LEFT JOIN q p ON p.q = q.q - 1 LEFT JOIN q y ON y.q = q.q - 4""",
    orders=True,
)
def quarter_growth(spark: SparkSession, d: str) -> DataFrame:
    q = service_orders(spark, d).groupBy((F.year("rsd") * 4 + F.quarter("rsd") - 1).cast("long").alias("quarter")).agg(F.sum("qty").alias("fte"))
    w = Window.partitionBy(F.lit(0)).orderBy("quarter")  # one row a quarter

    def change(n: int) -> F.Column:
        was = F.when(F.lag("quarter", n).over(w) == F.col("quarter") - n, F.lag("fte", n).over(w))
        return F.round((F.col("fte") - was) * 100 / was, 4)

    return q.select("quarter", "fte", change(1).alias("qoq_pct"), change(4).alias("yoy_pct"))


@query(
    "week_growth",
    """, q AS (SELECT date_trunc('week', rsd)::DATE AS week, sum(qty) AS fte FROM so WHERE rsd >= DATE '2000-01-01' AND rsd < DATE '2001-01-01' GROUP BY ALL) SELECT q.week, q.fte, round((q.fte - p.fte) * 100 / p.fte, 4) AS wow_pct FROM q LEFT JOIN q p ON p.week = q.week - 7""",
    orders=True,
    dates=("week",),
)
def week_growth(spark: SparkSession, d: str) -> DataFrame:
    q = service_orders(spark, d).filter((F.col("rsd") >= "2000-01-01") & (F.col("rsd") < "2001-01-01")).groupBy(F.trunc("rsd", "week").alias("week")).agg(F.sum("qty").alias("fte"))
    w = Window.partitionBy(F.lit(0)).orderBy("week")  # one row a week
    was = F.when(F.datediff("week", F.lag("week").over(w)) == 7, F.lag("fte").over(w))
    return q.select("week", "fte", F.round((F.col("fte") - was) * 100 / was, 4).alias("wow_pct"))


@query("contract_mix", "SELECT bu, status AS contract, sum(qty) AS qty, round(sum(qty) * 100 / sum(sum(qty)) OVER (PARTITION BY bu), 4) AS mix_pct FROM so GROUP BY bu, status", orders=True)
def contract_mix(spark: SparkSession, d: str) -> DataFrame:
    by = service_orders(spark, d).groupBy("bu", F.col("status").alias("contract")).agg(F.sum("qty").alias("qty"))
    return by.withColumn("mix_pct", F.round(F.col("qty") * 100 / F.sum("qty").over(Window.partitionBy("bu")), 4))


_CV = """, m AS (SELECT cluster, date_trunc('month', rsd) AS m, sum(qty) AS v FROM so GROUP BY ALL), k AS (SELECT cluster, sum(v) AS demand, CASE WHEN stddev_samp(v) / avg(v) < 0.5 THEN 'X' WHEN stddev_samp(v) / avg(v) <= 1.0 THEN 'Y' ELSE 'Z' END AS segment FROM m GROUP BY cluster)"""


def segments(spark: SparkSession, d: str) -> DataFrame:
    m = service_orders(spark, d).groupBy("cluster", F.trunc("rsd", "month").alias("m")).agg(F.sum("qty").alias("v"))
    return m.groupBy("cluster").agg(F.sum("v").alias("demand"), xyz(F.stddev_samp("v") / F.avg("v")).alias("segment"))


@query(
    "skill_distribution",
    _CV + """, t AS (SELECT *, row_number() OVER (ORDER BY demand DESC, cluster) AS k FROM k) SELECT 'top' AS kind, cluster AS name, demand AS value FROM t WHERE k <= 5
    UNION ALL SELECT 'share', CASE WHEN segment = 'X' THEN 'stable' ELSE 'volatile' END, round(sum(demand) * 100 / (SELECT sum(demand) FROM k), 4) FROM k GROUP BY 2""",
    orders=True,
)
def skill_distribution(spark: SparkSession, d: str) -> DataFrame:
    """The largest clusters, and how much demand lies in stable (X) and in volatile ones."""
    k = segments(spark, d)
    top = k.orderBy(F.desc("demand"), "cluster").limit(5).select(F.lit("top").alias("kind"), F.col("cluster").alias("name"), F.col("demand").alias("value"))
    by = k.groupBy(F.when(F.col("segment") == "X", "stable").otherwise("volatile").alias("name")).agg(F.sum("demand").alias("part"))
    share = by.select(F.lit("share").alias("kind"), "name", F.round(F.col("part") * 100 / F.sum("part").over(Window.partitionBy(F.lit(0))), 4).alias("value"))  # two rows
    return top.unionByName(share)


@query(
    "executive_composite",
    _CV + """, de AS (SELECT country, sum(qty) AS demand FROM so WHERE rsd >= DATE '2000-01-01' AND rsd < DATE '2001-01-01' GROUP BY ALL), sp AS (SELECT n_name AS country, count(*) * 300.0 AS supply FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
    SELECT 'forecast' AS part, 'fte' AS kpi, round(sum(qty), 2) AS value FROM so UNION ALL SELECT 'forecast', 'cancellation_pct', round(sum(CASE WHEN status = 'P' THEN qty ELSE 0 END) * 100 / sum(qty), 4) FROM so
    UNION ALL SELECT 'demand_type', 'backfill_pct', round(sum(CASE WHEN req_type = 'Backfill' THEN qty ELSE 0 END) * 100 / sum(qty), 4) FROM so UNION ALL SELECT 'geography', 'countries', count(DISTINCT country) FROM so
    UNION ALL SELECT 'grades', 'short_fuse_pct', round(sum(CASE WHEN date_diff('day', ssd, rsd) BETWEEN 0 AND 41 THEN 1 ELSE 0 END) * 100 / count(*), 4) FROM so UNION ALL SELECT 'skills', 'stable_clusters', count(*) FILTER (segment = 'X') FROM k
    UNION ALL SELECT 'supply', 'countries_short', count(*) FILTER (demand > coalesce(supply, 0)) FROM de LEFT JOIN sp USING (country)""",
    orders=True,
)
def executive_composite(spark: SparkSession, d: str) -> DataFrame:
    """One row for each figure of each view, from one pass over the orders and two small aggregates."""
    so, qty = service_orders(spark, d), F.col("qty")
    share = lambda c: F.round(F.sum(F.when(c, qty).otherwise(0)) * 100 / F.sum(qty), 4)
    one = so.agg(
        F.round(F.sum(qty), 2).alias("forecast/fte"), share(F.col("status") == "P").alias("forecast/cancellation_pct"), share(F.col("req_type") == "Backfill").alias("demand_type/backfill_pct"),
        F.count_distinct("country").cast("double").alias("geography/countries"), F.round(F.count_if(F.datediff("rsd", "ssd").between(0, 41)) * 100 / F.count("*"), 4).alias("grades/short_fuse_pct"),
    )
    stable = segments(spark, d).agg(F.count_if(F.col("segment") == "X").cast("double").alias("skills/stable_clusters"))
    demand = so.filter((F.col("rsd") >= "2000-01-01") & (F.col("rsd") < "2001-01-01")).groupBy("country").agg(F.sum("qty").alias("demand"))
    supply = load(spark, d, "supplier").join(load(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("country")).agg((F.count("*") * 300.0).alias("supply"))
    short = demand.join(supply, "country", "left").agg(F.count_if(F.col("demand") > F.coalesce("supply", F.lit(0.0))).cast("double").alias("supply/countries_short"))
    rows = [df.unpivot([], df.columns, "name", "value") for df in (one, stable, short)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).select(F.split_part("name", F.lit("/"), F.lit(1)).alias("part"), F.split_part("name", F.lit("/"), F.lit(2)).alias("kpi"), "value")


@query("scenario_accuracy", "SELECT bu, round(sum(qty) * 0.095, 4) AS demand_delta, round(sum(qty) * 0.095 * 0.55, 4) AS gap_delta, -0.76 AS accuracy_impact FROM so GROUP BY bu", orders=True)
def scenario_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """What drivers of 10, 5, 20 and 0 percent do to demand, to the supply gap and to accuracy."""
    pct = 10 * 0.4 + 5 * 0.3 + 20 * 0.2 + 0 * 0.1
    delta = F.sum("qty") * (pct / 100)
    return service_orders(spark, d).groupBy("bu").agg(F.round(delta, 4).alias("demand_delta"), F.round(delta * 0.55, 4).alias("gap_delta"), F.lit(round(-abs(pct) * 0.08, 2)).alias("accuracy_impact"))


@query("html_references", "SELECT p_partkey, p_name || ' &amp; é – ' || '''x''' || ' &unknown; <b>' AS text FROM part")
def html_references(spark: SparkSession, d: str) -> DataFrame:
    coded = F.concat("p_name", F.lit(" &amp;amp; &eacute; &#8211; &#x27;x&apos; &unknown; &lt;b&gt;"))
    return load(spark, d, "part").select("p_partkey", clean.unescaped(coded).alias("text"))
