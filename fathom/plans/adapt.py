"""The service-order view of the order tables, for Spark and as SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, orders: bool = False, dates: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query; ``orders`` puts the service-order view before the SQL as the table ``so``; ``dates`` are
    columns that both sides give as text (yyyy-mm-dd)."""

    def register(f: Query) -> Query:
        QUERIES[name] = f if not dates else lambda spark, d: f(spark, d).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates})
        if sql:
            text = f"WITH so AS ({SO_SQL}) {sql}" if orders else sql
            ORACLE_SQL[name] = f"SELECT * REPLACE ({', '.join(f'strftime({c}, $$%Y-%m-%d$$) AS {c}' for c in dates)}) FROM ({text}) AS told" if dates else text
        return f

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SO_SQL = """
SELECT o_orderkey AS order_id, o_custkey AS account, l_quantity AS qty, l_extendedprice AS revenue,
  CAST(o_orderdate AS DATE) AS rsd, CAST(l_shipdate AS DATE) AS ssd, o_orderstatus AS status, o_orderpriority AS grade,
  CASE WHEN l_returnflag = 'R' THEN 'Backfill' ELSE 'New Demand' END AS req_type, c_mktsegment AS bu, n_name AS country,
  r_name AS market, p_brand AS cluster, p_name AS skills, p_type AS practice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
"""


def service_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each order line, with the fields of a service order. Columns that a query does not use are pruned
    from the scans; the size of the dimension tables decides how they are joined."""
    line, order, customer = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    nation, region, part = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region"), load(spark, sf_dir, "part")
    place = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    joined = (
        line.join(order, line["l_orderkey"] == order["o_orderkey"])
        .join(customer, order["o_custkey"] == customer["c_custkey"])
        .join(place, customer["c_nationkey"] == place["n_nationkey"])
        .join(part, line["l_partkey"] == part["p_partkey"])
    )
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("account"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("revenue"),
        F.to_date("o_orderdate").alias("rsd"),
        F.to_date("l_shipdate").alias("ssd"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("grade"),
        F.when(F.col("l_returnflag") == "R", "Backfill").otherwise("New Demand").alias("req_type"),
        F.col("c_mktsegment").alias("bu"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("market"),
        F.col("p_brand").alias("cluster"),
        F.col("p_name").alias("skills"),
        F.col("p_type").alias("practice"),
    )
