"""Filters, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions import dates
from tidalframe.operators import calendar, joins
from tidalframe.plans.inputs import DAILY, UNKNOWN, daily_panel, kept, unknown_prices
from tidalframe.plans.flagship import BY_SERIES, holdout_predictions
from tidalframe.operators import metrics
from tidalframe.plans.registry import query
from tidalframe.sources.tables import table


@query(
    "flt_compare",
    """SELECT l_orderkey, l_linenumber FROM lineitem
       WHERE (l_quantity > 45 AND l_discount < 0.03) OR NOT (l_extendedprice >= 1000)""",
)
def flt_compare(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem")
    wanted = ((F.col("l_quantity") > 45) & (F.col("l_discount") < 0.03)) | ~(F.col("l_extendedprice") >= 1000)
    return lines.where(wanted).select("l_orderkey", "l_linenumber")


@query(
    "flt_in",
    f"""WITH {UNKNOWN} SELECT o_orderkey, status IS NOT NULL AND status IN ('F') AS is_in FROM unknown
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def flt_in(spark: SparkSession, root: str) -> DataFrame:
    """Membership is true or false, also for an unknown status."""
    rows = unknown_prices(spark, root).where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return rows.select("o_orderkey", joins.null_safe_in(F.col("status"), ["F"]).alias("is_in"))


@query(
    "flt_null",
    f"""WITH {UNKNOWN} SELECT o_orderpriority, count(*) FILTER (price IS NULL) AS n_unknown,
        count(*) FILTER (price IS NOT NULL) AS n_known FROM unknown GROUP BY 1""",
)
def flt_null(spark: SparkSession, root: str) -> DataFrame:
    rows = unknown_prices(spark, root)
    missing = F.col("price").isNull() | F.isnan("price")
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.when(missing, 1)).alias("n_unknown"), F.count(F.when(~missing, 1)).alias("n_known")
    )


@query(
    "flt_dropna",
    f"WITH {UNKNOWN} SELECT o_orderkey, status, price FROM unknown WHERE status IS NOT NULL AND price IS NOT NULL",
)
def flt_dropna(spark: SparkSession, root: str) -> DataFrame:
    return unknown_prices(spark, root).select("o_orderkey", "status", "price").dropna(how="any")


@query("flt_like", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'ring|^red')")
def flt_like(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").where(F.col("p_name").rlike("ring|^red")).select("p_partkey", "p_name")


@query(
    "flt_time",
    f"""WITH {DAILY}
SELECT 'bounds' AS kind, id, date, value FROM daily WHERE date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'
UNION ALL
SELECT 'last', id, date, value FROM (SELECT *, max(date) OVER (PARTITION BY id) AS e FROM daily)
WHERE date >= CAST(e - INTERVAL 3 MONTH AS DATE)""",
)
def flt_time(spark: SparkSession, root: str) -> DataFrame:
    """Partial dates as bounds, and the last three months of each series."""
    panel = kept(daily_panel(spark, root))
    bounds = calendar.filter_by_time(panel, "date", "1997-01", "1997-03")
    last = calendar.last_period(panel, ["id"], "date", "3 months")
    cols = ["id", "date", "value"]
    return bounds.select(F.lit("bounds").alias("kind"), *cols).union(last.select(F.lit("last").alias("kind"), *cols))


@query(
    "dat_minus",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH AS DATE) AS three_months_before,
       CAST(o_orderdate AS DATE) - 14 AS two_weeks_before,
       CAST(CAST(o_orderdate AS DATE) - DATE '2001-08-01' AS INT) AS days_to_end FROM orders""",
)
def dat_minus(spark: SparkSession, root: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, root, "orders").select(
        "o_orderkey",
        dates.minus(day, "3 months").alias("three_months_before"),
        dates.minus(day, "2 weeks").alias("two_weeks_before"),
        dates.days_between(day, F.to_date(F.lit("2001-08-01"))).alias("days_to_end"),
    )


@query(
    "flt_group",
    f"""WITH {BY_SERIES}
SELECT model_id, id, rmse FROM acc QUALIFY model_id = 2 OR rmse = min(rmse) OVER (PARTITION BY id)""",
)
def flt_group(spark: SparkSession, root: str) -> DataFrame:
    """Each series' best model, and always the reference model."""
    _, predictions = holdout_predictions(spark, root)
    accuracy = metrics.accuracy_table(predictions, ["model_id", "id"], "date")
    lowest = accuracy.groupBy("id").agg(F.min("rmse").alias("_lowest"))
    kept = joins.by_group(accuracy, lowest, ["id"]).where((F.col("model_id") == 2) | (F.col("rmse") == F.col("_lowest")))
    return kept.select("model_id", "id", "rmse")


@query(
    "flt_fillna",
    f"WITH {UNKNOWN} SELECT o_orderkey, coalesce(status, '?') AS status, coalesce(price, 0.0) AS price FROM unknown",
)
def flt_fillna(spark: SparkSession, root: str) -> DataFrame:
    rows = unknown_prices(spark, root).select("o_orderkey", "status", "price")
    return rows.fillna({"status": "?", "price": 0.0})


@query(
    "srt_sort",
    f"""WITH {UNKNOWN} SELECT o_orderkey, price FROM unknown ORDER BY price DESC NULLS LAST, o_orderkey""",
)
def srt_sort(spark: SparkSession, root: str) -> DataFrame:
    """Nulls go last in either direction."""
    rows = unknown_prices(spark, root).select("o_orderkey", "price")
    return rows.orderBy(F.col("price").desc_nulls_last(), "o_orderkey")


@query(
    "srt_topk",
    """SELECT o_orderkey, o_totalprice, CAST(pos AS INT) AS pos FROM (
         SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos FROM orders)
       WHERE pos BETWEEN 3 AND 12""",
)
def srt_topk(spark: SparkSession, root: str) -> DataFrame:
    """Ten rows of a sort after its first two: a distributed top-k, then positions."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    top = orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(12)
    rows = F.sort_array(F.collect_list(F.struct(-F.col("o_totalprice"), "o_orderkey", "o_totalprice")))
    placed = top.agg(rows.alias("r")).select(F.posexplode("r").alias("p", "row"))
    return placed.where(F.col("p") >= 2).select(
        "row.o_orderkey", "row.o_totalprice", (F.col("p") + 1).alias("pos")
    )


@query(
    "srt_tail",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
       ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50""",
)
def srt_tail(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return orders.orderBy(F.col("date").desc(), F.col("o_orderkey").desc()).limit(50)


@query(
    "srt_array",
    """SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS segments
       FROM customer GROUP BY 1""",
)
def srt_array(spark: SparkSession, root: str) -> DataFrame:
    """Sorted list of a column with few values."""
    return table(spark, root, "customer").groupBy("c_nationkey").agg(
        F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments")
    )
