"""Queries of the cleaning and filtering operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions.dates import monday_weekday
from fathom.operators import clean
from fathom.plans.adapt import load, query, service_orders


@query("drop_empty_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def drop_empty_columns(spark: SparkSession, d: str) -> DataFrame:
    df = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.lit(None).cast("string").alias("nothing"), F.lit("x").alias("listed"))
    return clean.drop_empty_columns(df, ["listed"])


@query("business_filter", "SELECT order_id, qty, bu, market FROM so WHERE bu IN ('BUILDING', 'MACHINERY') AND market IN ('ASIA', 'EUROPE')", orders=True)
def business_filter(spark: SparkSession, d: str) -> DataFrame:
    return clean.keep_values(service_orders(spark, d), {"bu": ["BUILDING", "MACHINERY"], "market": ["ASIA", "EUROPE"]}).select("order_id", "qty", "bu", "market")


@query(
    "grade_combine",
    """SELECT o_orderkey, CASE upper(trim(o_orderpriority)) WHEN '1-URGENT' THEN 'Senior' WHEN '2-HIGH' THEN 'Senior' WHEN '3-MEDIUM' THEN 'Mid'
    ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE upper(trim(o_orderpriority)) <> '5-LOW'""",
)
def grade_combine(spark: SparkSession, d: str) -> DataFrame:
    df = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return clean.relabel(df, "o_orderpriority", ["5-low"], {"1-urgent": "Senior", "2-HIGH": "Senior", "3-Medium": "Mid"})


@query("date_multi_parse", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE o_orderdate::DATE END AS parsed FROM orders", dates=("parsed",))
def date_multi_parse(spark: SparkSession, d: str) -> DataFrame:
    df = load(spark, d, "orders")
    k = F.col("o_orderkey") % 7
    text = F.lit("garbage")
    for n, p in enumerate(("yyyy-MM-dd", "MM-dd-yyyy", "yyyy/MM/dd", "M/d/yyyy", "dd-MMM-yyyy", "yyyy-M-d")):
        text = F.when(k == n, F.date_format("o_orderdate", p)).otherwise(text)
    return df.select("o_orderkey", clean.parse_date(text).alias("parsed"))


@query("rsd_year_window", "SELECT order_id, rsd, qty FROM so WHERE year(rsd) BETWEEN 1997 AND 1999", orders=True, dates=("rsd",))
def rsd_year_window(spark: SparkSession, d: str) -> DataFrame:
    return clean.year_between(service_orders(spark, d), "rsd", 1997, 1999).select("order_id", "rsd", "qty")


@query("chronology_filter", "SELECT order_id, rsd, ssd FROM so WHERE rsd >= ssd", orders=True, dates=("rsd", "ssd"))
def chronology_filter(spark: SparkSession, d: str) -> DataFrame:
    return clean.chronological(service_orders(spark, d), "rsd", "ssd").select("order_id", "rsd", "ssd")


_NULLED = "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS grade FROM orders"


def _nulled(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("grade"))


@query("drop_nulls", f"SELECT * FROM ({_NULLED}) t WHERE status IS NOT NULL AND grade IS NOT NULL")
def drop_nulls(spark: SparkSession, d: str) -> DataFrame:
    return _nulled(spark, d).na.drop("any")


@query(
    "drop_nulls_audit",
    f"""WITH t AS ({_NULLED}) SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS nulls FROM t
    UNION ALL SELECT 'status', count(*) FILTER (status IS NULL) FROM t UNION ALL SELECT 'grade', count(*) FILTER (grade IS NULL) FROM t""",
)
def drop_nulls_audit(spark: SparkSession, d: str) -> DataFrame:
    return clean.null_audit(_nulled(spark, d))


@query(
    "column_profile",
    f"""WITH t AS ({_NULLED}), n AS (SELECT count(*) AS n FROM t) SELECT 'o_orderkey' AS "column", 'bigint' AS type, count(*) FILTER (o_orderkey IS NULL) AS nulls, count(*) FILTER (o_orderkey IS NULL) / max(n.n) AS share FROM t, n
    UNION ALL SELECT 'status', 'string', count(*) FILTER (status IS NULL), count(*) FILTER (status IS NULL) / max(n.n) FROM t, n
    UNION ALL SELECT 'grade', 'string', count(*) FILTER (grade IS NULL), count(*) FILTER (grade IS NULL) / max(n.n) FROM t, n""",
)
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return clean.profile(_nulled(spark, d))


@query(
    "bu_correction",
    "SELECT c_custkey, CASE WHEN r_name = 'AMERICA' AND n_name IN ('NATION_1', 'NATION_11') THEN 'BU-' || n_name ELSE c_mktsegment END AS bu FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def bu_correction(spark: SparkSession, d: str) -> DataFrame:
    nation, region = load(spark, d, "nation"), load(spark, d, "region")
    base = load(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    lookup = spark.createDataFrame([(" Nation_1 ", "BU-NATION_1"), ("NATION_11", "BU-NATION_11"), ("NATION_2", "BU-NATION_2")], "key string, value string")
    return clean.corrected_by_lookup(base.withColumn("bu", F.col("c_mktsegment")), lookup, "n_name", "bu", F.col("r_name") == "AMERICA").select("c_custkey", "bu")


@query(
    "market_remap",
    """SELECT n_nationkey, m AS market FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN CASE r_name WHEN 'MIDDLE EAST' THEN 'EMEA' WHEN 'EUROPE' THEN 'EMEA' WHEN 'ASIA' THEN 'APJ' ELSE r_name END ELSE r_name END AS m
    FROM nation JOIN region ON n_regionkey = r_regionkey) t WHERE m <> 'APJ'""",
)
def market_remap(spark: SparkSession, d: str) -> DataFrame:
    df = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("market"))
    return clean.remapped(df, "market", {"MIDDLE EAST": "EMEA", "EUROPE": "EMEA", "ASIA": "APJ"}, F.col("n_nationkey") % 2 == 0, ["APJ"])


@query(
    "bu_rules",
    """WITH a AS (SELECT c_custkey, c_nationkey, c_mktsegment AS bu FROM customer WHERE c_mktsegment <> 'FURNITURE'),
    b AS (SELECT c_custkey, c_nationkey, CASE WHEN bu LIKE 'AUTO%' THEN 'MOTOR' ELSE bu END AS bu FROM a),
    c AS (SELECT c_custkey, c_nationkey, CASE WHEN bu = 'MOTOR' THEN 'MACHINERY' ELSE bu END AS bu FROM b)
    SELECT c_custkey, CASE WHEN bu = 'MACHINERY' AND c_nationkey < 12 THEN 'MACHINERY-A' WHEN bu = 'MACHINERY' THEN 'MACHINERY-B' ELSE bu END AS bu FROM c""",
)
def bu_rules(spark: SparkSession, d: str) -> DataFrame:
    bu = F.col("bu")
    rules = [
        (bu == "FURNITURE", None),
        (bu.startswith("AUTO"), "MOTOR"),
        (bu == "MOTOR", "MACHINERY"),
        (bu == "MACHINERY", F.when(F.col("c_nationkey") < 12, "MACHINERY-A").otherwise("MACHINERY-B")),
    ]
    return clean.rewritten(load(spark, d, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("bu")), "bu", rules).select("c_custkey", "bu")


@query(
    "near_zero_removal",
    """, c AS (SELECT market, country, year(rsd) AS y, count(*) AS n FROM so GROUP BY ALL),
    w AS (SELECT market, country, sum(n) AS n FROM c GROUP BY ALL), t AS (SELECT market, sum(n) AS t FROM c GROUP BY ALL), ty AS (SELECT market, y, sum(n) AS t FROM c GROUP BY ALL),
    bad AS (SELECT market, country FROM w JOIN t USING (market) WHERE n < 0.18 * t UNION SELECT c.market, c.country FROM c JOIN ty USING (market, y) WHERE c.n < 0.15 * ty.t)
    SELECT so.market, so.country, count(*) AS n FROM so WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.market = so.market AND bad.country = so.country) GROUP BY ALL""",
    orders=True,
)
def near_zero_removal(spark: SparkSession, d: str) -> DataFrame:
    df = service_orders(spark, d).withColumn("y", F.year("rsd"))
    return clean.without_rare(df, "market", "country", "y", 0.18, 0.15).groupBy("market", "country").agg(F.count("*").alias("n"))


_GAPPY = "SELECT market, country, year(rsd) AS y, qty FROM so WHERE NOT (year(rsd) = 1998 AND country LIKE 'NATION_1%')"


@query(
    "incomplete_panel",
    f""", g AS ({_GAPPY}), own AS (SELECT DISTINCT market, country, y FROM g), al AS (SELECT DISTINCT market, y FROM g)
    SELECT market, country, string_agg(y::VARCHAR, ',' ORDER BY y) AS missing FROM (SELECT c.market, c.country, al.y FROM (SELECT DISTINCT market, country FROM g) c JOIN al USING (market)
    WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.market = c.market AND own.country = c.country AND own.y = al.y)) m GROUP BY market, country""",
    orders=True,
)
def incomplete_panel(spark: SparkSession, d: str) -> DataFrame:
    df = service_orders(spark, d).withColumn("y", F.year("rsd")).filter(~((F.col("y") == 1998) & F.col("country").startswith("NATION_1")))
    return clean.incomplete(df, "market", "country", "y").withColumn("missing", F.concat_ws(",", F.transform("missing", lambda x: x.cast("string"))))


@query(
    "complete_panel",
    f""", g AS ({_GAPPY}), al AS (SELECT market, count(DISTINCT y) AS k FROM g GROUP BY market), own AS (SELECT market, country, count(DISTINCT y) AS k, count(*) AS n FROM g GROUP BY ALL)
    SELECT own.market, country, n FROM own JOIN al ON al.market = own.market AND al.k = own.k""",
    orders=True,
)
def complete_panel(spark: SparkSession, d: str) -> DataFrame:
    df = service_orders(spark, d).withColumn("y", F.year("rsd")).filter(~((F.col("y") == 1998) & F.col("country").startswith("NATION_1")))
    return clean.without_incomplete(df, "market", "country", "y").groupBy("market", "country").agg(F.count("*").alias("n"))


@query("exclude_contains", "SELECT p_partkey, p_type FROM part WHERE NOT contains(upper(p_type), 'PROMO') AND NOT contains(upper(p_type), 'SMALL')")
def exclude_contains(spark: SparkSession, d: str) -> DataFrame:
    return clean.excluding_text(load(spark, d, "part").select("p_partkey", "p_type"), "p_type", "promo", "small")


@query("group_keys_present", f"SELECT * FROM ({_NULLED}) t WHERE status IS NOT NULL AND trim(status) <> '' AND grade IS NOT NULL AND trim(grade) <> ''")
def group_keys_present(spark: SparkSession, d: str) -> DataFrame:
    return clean.with_keys(_nulled(spark, d), ["status", "grade"])


@query("optional_filters", "SELECT order_id, bu, country FROM so WHERE upper(bu) = 'BUILDING'", orders=True)
def optional_filters(spark: SparkSession, d: str) -> DataFrame:
    return clean.optional_filters(service_orders(spark, d), bu="building", country=None, grade=None).select("order_id", "bu", "country")


@query("html_unescape", "SELECT page_id, replace(replace(replace(replace(replace(replace(url || '&amp;lt;&quot;', '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS url FROM pages")
def html_unescape(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pages").select("page_id", clean.unescaped(F.concat("url", F.lit("&amp;lt;&quot;"))).alias("url"))


@query("requirement_type", "SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN 'New Demand' WHEN l_returnflag = 'R' THEN 'Backfill' ELSE 'Other' END AS kind, count(*) AS n FROM lineitem GROUP BY ALL")
def requirement_type(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("l_returnflag") == "R", " backFILL - internal").when(F.col("l_returnflag") == "N", "Other")
    return load(spark, d, "lineitem").withColumn("raw", raw).select("l_orderkey", clean.requirement_type("raw").alias("kind")).groupBy("l_orderkey", "kind").agg(F.count("*").alias("n"))


@query("delivery_mode", "SELECT CASE o_orderstatus WHEN 'O' THEN 'Onsite' WHEN 'F' THEN 'Offshore' END AS delivery_mode, count(*) AS n FROM orders GROUP BY ALL")
def delivery_mode(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "O", "ONSITE").when(F.col("o_orderstatus") == "F", " off-shore")
    return load(spark, d, "orders").withColumn("raw", raw).groupBy(clean.delivery_mode("raw").alias("delivery_mode")).agg(F.count("*").alias("n"))


@query("date_features", "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, quarter(o_orderdate) AS q, isodow(o_orderdate) AS wd, week(o_orderdate) AS wk, dayofyear(o_orderdate) AS doy FROM orders")
def date_features(spark: SparkSession, d: str) -> DataFrame:
    t = F.to_date("o_orderdate")
    return load(spark, d, "orders").select("o_orderkey", F.year(t).alias("y"), F.month(t).alias("m"), F.quarter(t).alias("q"), monday_weekday(t).alias("wd"), F.weekofyear(t).alias("wk"), F.dayofyear(t).alias("doy"))
