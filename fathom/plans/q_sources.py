"""Queries of workbooks, staging and other files, correlation over many columns, and codes by first appearance."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.operators import clean, features
from fathom.plans.adapt import load, query, service_orders
from fathom.plans.q_aggregate import _FORECAST, forecast
from fathom.sources import files, staging, workbook


def _place(spark: SparkSession, name: str) -> str:
    return f"{files.scratch(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "workbook_round_trip",
    "SELECT n_name AS country, r_name AS market, '=' || n_name AS formula, min(o_orderdate)::DATE AS first_day, max(o_orderdate) AS last_moment, count(o_orderkey) AS orders, sum(o_totalprice) / 4 AS quarter FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL",
    dates=("first_day", "last_moment"),
)
def workbook_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Orders by country through a workbook of three sheets."""
    path = _place(spark, "book") + ".xlsx"
    by = load(spark, d, "customer").join(load(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.to_date(F.min("o_orderdate")).alias("first_day"), F.max("o_orderdate").alias("last_moment"), F.count("*").alias("orders"), (F.sum("o_totalprice") / 4).alias("quarter"))
    countries = load(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey", F.concat(F.lit("="), "n_name").alias("formula"))
    workbook.write_workbook({"Countries": countries, "Markets": load(spark, d, "region"), "Orders by country": by}, path)
    sheet = lambda name: workbook.read_sheet(spark, path, name)
    told = sheet("Countries").join(sheet("Markets"), F.col("n_regionkey") == F.col("r_regionkey")).join(sheet("Orders by country"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return told.select(F.col("n_name").alias("country"), F.col("r_name").alias("market"), "formula", "first_day", "last_moment", F.coalesce("orders", F.lit(0)).alias("orders"), "quarter")


#: What is wrong in the staged lines: by the order's number.
_LINES = """WITH l AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, CASE WHEN o_orderkey % 17 = 0 THEN 'x' || o_totalprice ELSE o_totalprice::VARCHAR END AS price, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END AS grade, o_orderkey % 19 = 0 AS broken FROM orders)"""


def _staged(spark: SparkSession, d: str) -> DataFrame:
    o, k = load(spark, d, "orders"), F.col("o_orderkey")
    day = F.when(k % 13 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    price = F.when(k % 17 == 0, F.concat(F.lit("x"), F.col("o_totalprice").cast("string"))).otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", k.cast("string"), day, price, F.when(k % 11 == 0, "").otherwise(F.col("o_orderpriority")), F.when(k % 19 == 0, "too much"))
    path = _place(spark, "lines")
    o.select(line.alias("value")).write.text(path)
    return staging.stage(spark, path, ["id", "day", "price", "grade"], "2024-01", header=False)


_KINDS = {"id": "long", "day": "date", "price": "double", "grade": "string"}


@query("staged_load", _LINES + " SELECT id, day, price::DOUBLE AS price, grade, '2024-01' AS batch FROM l WHERE NOT broken AND id % 13 <> 0 AND id % 17 <> 0 AND id % 11 <> 0")
def staged_load(spark: SparkSession, d: str) -> DataFrame:
    """Orders from text lines, loaded twice: the second load of the batch replaces the first."""
    good, _ = staging.convert(_staged(spark, d), _KINDS, ["id", "grade"])
    target = _place(spark, "loaded")
    for _ in range(2):
        staging.append(good, target)
    return spark.read.parquet(target).select("id", F.date_format("day", "yyyy-MM-dd").alias("day"), "price", "grade", F.col("batch").cast("string").alias("batch"))


@query("staged_rejects", _LINES + """ SELECT id, CASE WHEN broken THEN 'malformed line' ELSE array_to_string(list_filter([CASE WHEN id % 13 = 0 THEN 'day: unreadable' END, CASE WHEN id % 17 = 0 THEN 'price: unreadable' END, CASE WHEN id % 11 = 0 THEN 'grade: missing' END], lambda x: x IS NOT NULL), '; ') END AS reasons FROM l WHERE broken OR id % 13 = 0 OR id % 17 = 0 OR id % 11 = 0""")
def staged_rejects(spark: SparkSession, d: str) -> DataFrame:
    _, bad = staging.convert(_staged(spark, d), _KINDS, ["id", "grade"])
    return bad.select(F.coalesce(F.col("id"), F.split("malformed", ",")[0]).cast("long").alias("id"), F.array_join("reasons", "; ").alias("reasons"))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "p_retailprice", "p_size", "o_totalprice"]
_WIDE = "WITH x AS (SELECT " + ", ".join(_NUMBERS) + " FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey), c AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {i} AS i, {j} AS j, corr({a}, {b}) AS r, count(*) AS n FROM x" for i, a in enumerate(_NUMBERS) for j, b in enumerate(_NUMBERS) if i < j) + ")"


def _wide(spark: SparkSession, d: str) -> DataFrame:
    line, part, order = load(spark, d, "lineitem"), load(spark, d, "part"), load(spark, d, "orders")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(*_NUMBERS)


@query("correlation_matrix", _WIDE + " SELECT a, b, round(r, 6) AS pearson, n FROM c")
def correlation_matrix(spark: SparkSession, d: str) -> DataFrame:
    return features.correlations(_wide(spark, d), _NUMBERS).select("a", "b", F.round("pearson", 6).alias("pearson"), "n")


@query("uncorrelated_columns", _WIDE.replace("WITH x", "WITH RECURSIVE x") + f""", g AS (SELECT 0 AS i, ['{_NUMBERS[0]}'] AS kept UNION ALL SELECT g.i + 1, CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.j = g.i + 1 AND abs(r) > 0.003 AND list_contains(kept, a)) THEN kept ELSE list_append(kept, ({_NUMBERS!r})[g.i + 2]) END FROM g WHERE g.i < {len(_NUMBERS) - 1}) SELECT unnest(kept) AS feature FROM g WHERE i = {len(_NUMBERS) - 1}""")
def uncorrelated_columns(spark: SparkSession, d: str) -> DataFrame:
    pairs = features.correlations(_wide(spark, d), _NUMBERS)
    return spark.createDataFrame([(c,) for c in features.uncorrelated(pairs, _NUMBERS, 0.003)], "feature string")


@query("first_seen_codes", "SELECT user_id, min(event_id) AS first, row_number() OVER (ORDER BY min(event_id)) - 1 AS code FROM events GROUP BY user_id")
def first_seen_codes(spark: SparkSession, d: str) -> DataFrame:
    return features.first_seen(load(spark, d, "events"), "user_id", "event_id")


@query("short_dates", "SELECT DISTINCT day, strftime(d, '%Y-%m-%d') AS parsed FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%m-%d-%Y') END AS day, o_orderdate::DATE AS d FROM orders) q")
def short_dates(spark: SparkSession, d: str) -> DataFrame:
    form = lambda p: F.date_format("o_orderdate", p)
    day = F.when(F.col("o_orderkey") % 3 == 0, form("yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, form("MM/dd/yyyy")).otherwise(form("MM-dd-yyyy"))
    told = load(spark, d, "orders").select(day.alias("day")).distinct()
    return told.withColumn("parsed", F.date_format(clean.parse_date("day", clean.SHORT_DATE_PATTERNS), "yyyy-MM-dd"))


@query("stripped_test_rows", "SELECT bu, cluster, strftime(rsd, '%Y-%m-%d') AS rsd, qty FROM so WHERE rsd >= DATE '2001-01-01'", orders=True)
def stripped_test_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows to forecast, with nothing that is unknown then; a feature from elsewhere would be an error."""
    rows = service_orders(spark, d).filter(F.col("rsd") >= "2001-01-01")
    kept = features.known_in_advance(rows, ["bu", "cluster"], ["rsd"], ["qty"])
    features.refuse_leaks(kept.columns, ["bu", "cluster", "rsd", "qty"], [])
    return kept.select("bu", "cluster", F.date_format("rsd", "yyyy-MM-dd").alias("rsd"), "qty")


@query("many_files", "SELECT 'nation' AS source, n_name AS name, n_regionkey::VARCHAR AS region FROM nation UNION ALL SELECT 'region', r_name, NULL FROM region")
def many_files(spark: SparkSession, d: str) -> DataFrame:
    """Two CSV folders of different columns, read as text and stacked by name."""
    parts = []
    for name, cols in (("nation", {"name": "n_name", "region": "n_regionkey"}), ("region", {"name": "r_name"})):
        path = _place(spark, name)
        files.write_csv(load(spark, d, name).select(F.lit(name).alias("source"), *[F.col(c).alias(k) for k, c in cols.items()]), path)
        parts.append(files.read_csv(spark, [path]))
    return files.stacked(parts, as_text=True)


@query("json_round_trip", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "json")
    files.write_json(load(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n")), path)
    return spark.read.schema("p_brand string, n long").json(path)


@query("group_files", "SELECT c_mktsegment, CASE WHEN c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS split, count(*) AS rows, count(*) AS stored FROM customer GROUP BY ALL")
def group_files(spark: SparkSession, d: str) -> DataFrame:
    """Files by group and split: what the manifest says beside what the files hold."""
    path = _place(spark, "groups")
    rows = load(spark, d, "customer").withColumn("split", F.when(F.col("c_custkey") % 5 == 0, "test").otherwise("train"))
    told = files.write_groups(rows, path, ["c_mktsegment"], "split")
    held = spark.read.parquet(path).groupBy("c_mktsegment", "split").agg(F.count("*").alias("stored"))
    return told.join(held, ["c_mktsegment", "split"])


_OVERVIEW = _FORECAST + """, dm AS (SELECT year(rsd) AS year, month(rsd) AS month, cluster, sum(qty) AS demand, sum(CASE WHEN status = 'P' THEN qty ELSE 0 END) AS cancelled FROM so WHERE rsd >= DATE '2000-07-01' AND rsd < DATE '2001-07-01' GROUP BY ALL),
pc AS (SELECT cluster, h, sum(actual) AS actual, sum(predicted) AS predicted FROM f GROUP BY ALL)"""


@query("overview_with_predictions", _OVERVIEW + " SELECT year::INTEGER AS year, month::INTEGER AS month, dm.cluster, demand, round(cancelled * 100 / demand, 4) AS cancelled_pct, h::INTEGER AS months_ahead, predicted, round(CASE WHEN actual > 0 THEN greatest(0, 100 - abs(actual - predicted) * 100 / actual) END, 4) AS accuracy_pct FROM dm LEFT JOIN pc ON pc.cluster = dm.cluster", orders=True)
def overview_with_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Demand of a year by month and cluster, with every month ahead that is predicted for the cluster."""
    so = service_orders(spark, d).filter((F.col("rsd") >= "2000-07-01") & (F.col("rsd") < "2001-07-01"))
    dm = so.groupBy(F.year("rsd").alias("year"), F.month("rsd").alias("month"), "cluster").agg(F.sum("qty").alias("demand"), F.sum(F.when(F.col("status") == "P", F.col("qty")).otherwise(0)).alias("cancelled"))
    pc = forecast(spark, d).groupBy("cluster", F.col("h").cast("int").alias("months_ahead")).agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))
    right = F.when(F.col("actual") > 0, F.greatest(F.lit(0.0), 100 - F.abs(F.col("actual") - F.col("predicted")) * 100 / F.col("actual")))
    return dm.join(pc, "cluster", "left").select("year", "month", "cluster", "demand", F.round(F.col("cancelled") * 100 / F.col("demand"), 4).alias("cancelled_pct"), "months_ahead", "predicted", F.round(right, 4).alias("accuracy_pct"))
