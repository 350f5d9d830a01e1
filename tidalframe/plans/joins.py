"""Joins and row binding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions.exact import exact_sum
from tidalframe.operators import joins
from tidalframe.plans.inputs import DAILY, daily_panel
from tidalframe.plans.registry import query
from tidalframe.sources.tables import table


@query(
    "jon_left",
    """SELECT c_custkey, c_nationkey, n_name FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON c_nationkey = n_nationkey""",
)
def jon_left(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, root, "nation").where("n_regionkey <> 0").select("n_nationkey", "n_name")
    return joins.left_join_by(customers, nations, "c_nationkey", "n_nationkey")


@query(
    "jon_left_natural",
    """WITH spend AS (SELECT o_custkey AS customer_id, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
                      FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
       SELECT c_custkey AS customer_id, c_mktsegment AS segment, spend FROM customer
       LEFT JOIN spend ON c_custkey = customer_id""",
)
def jon_left_natural(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )
    urgent = table(spark, root, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    spend = urgent.groupBy(F.col("o_custkey").alias("customer_id")).agg(exact_sum("o_totalprice").alias("spend"))
    return joins.natural_left(customers, spend)


@query(
    "jon_right",
    """WITH n AS (SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_size > 25 GROUP BY 1, 2),
            best AS (SELECT DISTINCT p_brand, p_type FROM part)
       SELECT b.p_brand, b.p_type, n.n FROM n RIGHT JOIN best b ON n.p_brand = b.p_brand AND n.p_type = b.p_type""",
)
def jon_right(spark: SparkSession, root: str) -> DataFrame:
    parts = table(spark, root, "part")
    counts = parts.where("p_size > 25").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return joins.natural_right(counts, parts.select("p_brand", "p_type").distinct())


BUYERS = "SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01'"


@query("jon_semi", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN ({BUYERS})")
def jon_semi(spark: SparkSession, root: str) -> DataFrame:
    """Customers with an order in the last month."""
    customers = table(spark, root, "customer").select("c_custkey", "c_name")
    return joins.members(customers, recent_buyers(spark, root), "c_custkey")


@query("jon_anti", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN ({BUYERS})")
def jon_anti(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select("c_custkey", "c_name")
    return joins.non_members(customers, recent_buyers(spark, root), "c_custkey")


def recent_buyers(spark: SparkSession, root: str) -> DataFrame:
    recent = table(spark, root, "orders").where(F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz"))
    return recent.select(F.col("o_custkey").alias("c_custkey")).distinct()


@query(
    "set_bind_rows",
    """SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""",
)
def set_bind_rows(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, root, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id")
    )
    return joins.bind_rows(customers, suppliers)


@query(
    "jon_bind_cols",
    """SELECT o_orderkey, o_totalprice, o_totalprice * 0.001 + 5 AS prediction FROM orders""",
)
def jon_bind_cols(spark: SparkSession, root: str) -> DataFrame:
    """Predictions beside their inputs, matched by key and not by position."""
    inputs = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    scores = table(spark, root, "orders").select(
        "o_orderkey", (F.col("o_totalprice") * 0.001 + 5).alias("prediction")
    )
    return joins.bind_columns(inputs, scores, "o_orderkey")


@query(
    "jon_cross",
    f"""WITH {DAILY}, ids AS (SELECT id, count(*) AS n_days FROM daily GROUP BY 1),
        designs(design) AS (VALUES ('calendar'), ('lags'), ('hybrid')),
        learners(learner) AS (VALUES ('linear'), ('boosted'), ('forest'))
        SELECT id, n_days, design, learner FROM ids, designs, learners""",
)
def jon_cross(spark: SparkSession, root: str) -> DataFrame:
    """Every series with every pairing of a design and a learner."""
    ids = daily_panel(spark, root).groupBy("id").agg(F.count(F.lit(1)).alias("n_days"))
    return joins.pairings(ids, design=["calendar", "lags", "hybrid"], learner=["linear", "boosted", "forest"])
