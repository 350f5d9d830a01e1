"""Reading and writing: CSV, directories of CSV, delimited text, Parquet, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import models
from tidalframe.operators.models import Design
from tidalframe.plans.inputs import MONTHLY, monthly_panel, parts
from tidalframe.plans.registry import query
from tidalframe.session import scratch
from tidalframe.sources import files
from tidalframe.sources.tables import table


@query(
    "src_csv",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""",
)
def src_csv(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )
    path = files.write_csv(orders, scratch(spark, "src_csv"))
    return files.read_csv(spark, path, orders.schema)


@query(
    "src_csv_multi",
    """SELECT o_orderstatus AS source, count(*) AS n, count(DISTINCT o_custkey) AS n_customers,
       min(CAST(o_orderdate AS DATE)) AS first_date,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
       FROM orders GROUP BY 1""",
)
def src_csv_multi(spark: SparkSession, root: str) -> DataFrame:
    """One directory per status; the status is known only from the file path."""
    orders = table(spark, root, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("Customer Key"),
        F.col("o_orderdate").cast("date").alias("ORDER DATE"),
        F.col("o_totalprice").alias("Total Price"),
    )
    path = scratch(spark, "src_csv_multi")
    orders.write.partitionBy("status").option("header", True).csv(path)
    schema = "`Customer Key` long, `ORDER DATE` date, `Total Price` double"
    rows = files.read_csv_dir(spark, path, schema)
    return rows.groupBy(F.regexp_extract("path", "status=([^/]+)", 1).alias("source")).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("customer_key").alias("n_customers"),
        F.min("order_date").alias("first_date"),
        F.sum(F.col("total_price").cast("decimal(18,2)")).cast("double").alias("total_price"),
    )


@query(
    "src_delim",
    """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price FROM orders""",
)
def src_delim(spark: SparkSession, root: str) -> DataFrame:
    """A blank-padded log without header; fields are chosen by position."""
    line = F.format_string(
        " %6d  %s %10d   %.2f",
        F.col("o_orderkey"),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.col("o_custkey"),
        F.col("o_totalprice"),
    )
    path = scratch(spark, "src_delim")
    table(spark, root, "orders").select(line.alias("value")).write.text(path)
    log = files.read_blank_separated(spark, path, 4)
    return log.select(
        F.col("X3").try_cast("long").alias("customer_id"),
        F.try_to_date("X2", "yyyyMMdd").alias("date"),
        F.col("X4").try_cast("double").alias("price"),
    )


@query("src_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def src_parquet(spark: SparkSession, root: str) -> DataFrame:
    return files.read_parquet(spark, f"{root}/lineitem.parquet", "l_orderkey", "l_linenumber", "l_quantity")


@query(
    "src_inline",
    """WITH names(o_orderstatus, status_name) AS (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending'))
       SELECT status_name, count(*) AS n FROM orders JOIN names USING (o_orderstatus) GROUP BY 1""",
)
def src_inline(spark: SparkSession, root: str) -> DataFrame:
    names = spark.createDataFrame(
        [("F", "finished"), ("O", "open"), ("P", "pending")], "o_orderstatus string, status_name string"
    )
    orders = table(spark, root, "orders").select("o_orderstatus")
    return orders.join(names, "o_orderstatus").groupBy("status_name").agg(F.count(F.lit(1)).alias("n"))


@query("snk_csv", f"WITH {MONTHLY} SELECT id, date, value FROM monthly")
def snk_csv(spark: SparkSession, root: str) -> DataFrame:
    panel = monthly_panel(spark, root)
    path = files.write_csv(panel, scratch(spark, "snk_csv"))
    return files.read_csv(spark, path, "id string, date date, value double")


@query(
    "snk_model_line",
    """WITH fit AS (SELECT regr_slope(p_retailprice, p_size) AS b, regr_intercept(p_retailprice, p_size) AS a FROM part)
SELECT p_partkey, round(a + b * p_size, 3) AS prediction FROM part, fit""",
)
def snk_model_line(spark: SparkSession, root: str) -> DataFrame:
    """A reloaded line scores every row as the fitted one does."""
    rows = parts(spark, root)
    fitted = models.fit(Design("p_retailprice", ("p_size",)), models.linear(), rows)
    again = models.load(models.save(fitted, scratch(spark, "snk_model_line")))
    return models.predict(again, rows, ["p_partkey"]).withColumn("prediction", F.round("prediction", 3))


@query("snk_model")
def snk_model(spark: SparkSession, root: str) -> DataFrame:
    """A stored specification with nominal columns, reloaded: its score of every row beside that of the fitted one."""
    rows = parts(spark, root)
    fitted = models.fit(Design("p_retailprice", ("p_size",), ("p_brand", "p_type")), models.elastic_net(0.1, 0.5), rows)
    again = models.load(models.save(fitted, scratch(spark, "snk_model")))
    one = models.predict(fitted, rows, rows.columns).withColumnRenamed("prediction", "before")
    return models.predict(again, one, ["p_partkey", "before"])
