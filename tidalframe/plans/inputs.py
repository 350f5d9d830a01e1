"""Inputs shared by the registered queries, with the SQL that says the same.

Every panel is added up to one row per series and date before anything else
happens to it. A query that reads its panel more than once takes it through
``kept``, so that the raw tables are scanned and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions.exact import decimal, exact_mean, exact_sum
from tidalframe.session import cut_lineage
from tidalframe.sources.tables import table


def kept(panel: DataFrame) -> DataFrame:
    """A panel written down: small beside the raw rows it was added up from."""
    return cut_lineage(panel)


def order_days(spark: SparkSession, root: str) -> DataFrame:
    """Spend per customer and day: a busy customer is at most one row per day."""
    orders = table(spark, root, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("date"), "o_totalprice"
    )
    return orders.groupBy("o_custkey", "date").agg(F.sum(decimal("o_totalprice")).alias("spend"))


def daily_panel(spark: SparkSession, root: str) -> DataFrame:
    """Spend per market segment and day."""
    customers = table(spark, root, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("id")
    )
    return (
        order_days(spark, root)
        .join(customers, "o_custkey")
        .groupBy("id", "date")
        .agg(F.sum("spend").cast("double").alias("value"))
    )


DAILY = """daily AS (
  SELECT c_mktsegment AS id, CAST(o_orderdate AS DATE) AS date,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def monthly_panel(spark: SparkSession, root: str) -> DataFrame:
    """Spend per market segment and month."""
    days = daily_panel(spark, root)
    return days.groupBy("id", F.trunc("date", "month").alias("date")).agg(exact_sum("value").alias("value"))


MONTHLY = f"""{DAILY}, monthly AS (
  SELECT id, CAST(date_trunc('month', date) AS DATE) AS date,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM daily GROUP BY 1, 2)"""


def nation_monthly(spark: SparkSession, root: str) -> DataFrame:
    """Spend per customer nation and month."""
    customers = table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, root, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("id")
    )
    return (
        order_days(spark, root)
        .join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .groupBy("id", F.trunc("date", "month").alias("date"))
        .agg(F.sum("spend").cast("double").alias("value"))
    )


def transactions(spark: SparkSession, root: str) -> DataFrame:
    """The purchase log: customer, date, price."""
    return table(spark, root, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("price"),
    )


LOG = """log AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price FROM orders)"""


def price_panel(spark: SparkSession, root: str) -> DataFrame:
    """Mean line price per flag, status and ship day: the 'stock price' series."""
    lines = table(spark, root, "lineitem")
    return lines.groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"), F.col("l_shipdate").cast("date").alias("date")
    ).agg(exact_mean("l_extendedprice").alias("adjusted"))


PRICES = """prices AS (
  SELECT l_returnflag || l_linestatus AS symbol, CAST(l_shipdate AS DATE) AS date,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_extendedprice) AS adjusted
  FROM lineitem GROUP BY 1, 2)"""

SYMBOLS = ["AF", "AO", "NF", "NO", "RF", "RO"]


def event_days(spark: SparkSession, root: str) -> DataFrame:
    """Event value per type and day."""
    return (
        table(spark, root, "events")
        .groupBy(F.col("event_type").alias("id"), F.col("ts").cast("date").alias("date"))
        .agg(exact_sum("value").alias("value"))
    )


EVENT_DAYS = """event_days AS (
  SELECT event_type AS id, CAST(ts AS DATE) AS date,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM events GROUP BY 1, 2)"""


def unknown_prices(spark: SparkSession, root: str) -> DataFrame:
    """Orders whose price is unknown while they are pending."""
    return table(spark, root, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )


UNKNOWN = """unknown AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
  FROM orders)"""


def parts(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"
    )


def labelled(spark: SparkSession, root: str) -> DataFrame:
    """Documents with a quality label, described by size, language and source."""
    docs = table(spark, root, "documents").select("doc_id", "lang", "source", "n_chars")
    marks = table(spark, root, "labels").select("doc_id", "quality", "toxic")
    return docs.join(marks, "doc_id")
