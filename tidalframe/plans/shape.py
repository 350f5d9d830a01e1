"""Projections, renames and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions import selectors as sel
from tidalframe.functions import text
from tidalframe.functions.exact import exact_sum
from tidalframe.functions.names import clean_names
from tidalframe.operators import ordered, shape, windows
from tidalframe.plans.inputs import DAILY, PRICES, SYMBOLS, daily_panel, price_panel
from tidalframe.plans.registry import query
from tidalframe.sources.tables import table


@query("prj_select", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def prj_select(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "prj_helpers",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate::DATE AS l_shipdate, l_quantity, l_extendedprice,
       l_discount, l_returnflag, l_linestatus FROM lineitem""",
)
def prj_helpers(spark: SparkSession, root: str) -> DataFrame:
    """Keys, a date, a range of columns and whatever a pattern finds, in that order."""
    lines = table(spark, root, "lineitem")
    picked = sel.pick(
        lines,
        sel.ends_with("key"),
        sel.contains("ship"),
        sel.span("l_quantity", "l_discount"),
        sel.matches("^l_(return|line)[a-z]*(flag|status)$"),
    )
    return picked.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query("prj_drop", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def prj_drop(spark: SparkSession, root: str) -> DataFrame:
    return sel.omit(table(spark, root, "part"), sel.starts_with("p_b"), "p_type")


@query("prj_rename", "SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment FROM customer")
def prj_rename(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return customers.withColumnRenamed("c_custkey", "customer_id").toDF("customer_id", "name", "segment")


@query(
    "prj_clean_names",
    """SELECT s_suppkey AS supplier_key, s_name AS x1st_name, s_nationkey AS nation_number,
       s_acctbal AS account_balance, s_acctbal / 1000 AS account_balance_2 FROM supplier""",
)
def prj_clean_names(spark: SparkSession, root: str) -> DataFrame:
    raw = table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("Supplier Key"),
        F.col("s_name").alias("1st Name"),
        F.col("s_nationkey").alias("nation #"),
        F.col("s_acctbal").alias("AccountBalance"),
        (F.col("s_acctbal") / 1000).alias("account.balance"),
    )
    return clean_names(raw)


@query(
    "prj_mutate",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge, l_quantity > 25 AS bulk FROM lineitem""",
)
def prj_mutate(spark: SparkSession, root: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        net.alias("net"),
        (net * (1 + F.col("l_tax"))).alias("charge"),
        (F.col("l_quantity") > 25).alias("bulk"),
    )


@query(
    "prj_across",
    """SELECT p_partkey, TRY_CAST(p_brand AS DOUBLE) AS p_brand, TRY_CAST(p_type AS DOUBLE) AS p_type,
       CAST(p_size AS DOUBLE) AS p_size, TRY_CAST(replace(p_name, p_name, CAST(p_partkey AS VARCHAR)) AS DOUBLE) AS p_name
       FROM part""",
)
def prj_across(spark: SparkSession, root: str) -> DataFrame:
    """Every chosen column to a number; text that is none becomes null."""
    rows = table(spark, root, "part").select(
        "p_partkey",
        "p_brand",
        "p_type",
        F.col("p_size").cast("string").alias("p_size"),
        F.col("p_partkey").cast("string").alias("p_name"),
    )
    return shape.across(rows, ["p_brand", "p_type", "p_size", "p_name"], text.to_number)


@query("prj_const", "SELECT 'orders' AS source, 1 AS version, o_orderkey, o_totalprice FROM orders")
def prj_const(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return orders.select(F.lit("orders").alias("source"), F.lit(1).alias("version"), "*")


@query(
    "prj_rowid",
    "SELECT row_number() OVER (ORDER BY o_orderkey) AS row_id, o_orderkey, o_custkey FROM orders",
)
def prj_rowid(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey")
    return ordered.row_index(orders, "o_orderkey")


WIDE = """wide AS (
  SELECT c_nationkey,
    CAST(SUM(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS bal_AUTOMOBILE,
    CAST(SUM(CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS bal_BUILDING,
    CAST(SUM(CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS bal_FURNITURE,
    CAST(SUM(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS bal_HOUSEHOLD,
    CAST(SUM(CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS bal_MACHINERY
  FROM customer GROUP BY 1)"""

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def wide_balances(spark: SparkSession, root: str) -> DataFrame:
    sums = (
        table(spark, root, "customer")
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(exact_sum("c_acctbal").alias("balance"))
    )
    return shape.wider(sums, ["c_nationkey"], "c_mktsegment", "balance", SEGMENTS, prefix="bal_")


@query(
    "rsh_longer",
    f"""WITH {WIDE}
SELECT c_nationkey, 'bal_AUTOMOBILE' AS segment, bal_AUTOMOBILE AS balance FROM wide
UNION ALL SELECT c_nationkey, 'bal_BUILDING', bal_BUILDING FROM wide
UNION ALL SELECT c_nationkey, 'bal_FURNITURE', bal_FURNITURE FROM wide
UNION ALL SELECT c_nationkey, 'bal_HOUSEHOLD', bal_HOUSEHOLD FROM wide
UNION ALL SELECT c_nationkey, 'bal_MACHINERY', bal_MACHINERY FROM wide""",
)
def rsh_longer(spark: SparkSession, root: str) -> DataFrame:
    wide = wide_balances(spark, root)
    return shape.longer(wide, ["c_nationkey"], sel.names(wide, sel.starts_with("bal_")), "segment", "balance")


@query(
    "rsh_wider",
    f"""WITH {PRICES}, returns AS (
  SELECT symbol, date, (adjusted - lag(adjusted) OVER w) / lag(adjusted) OVER w AS ret
  FROM prices WINDOW w AS (PARTITION BY symbol ORDER BY date)),
cells AS (SELECT date, symbol, ret, 1 AS present FROM returns)
SELECT date, """
    + ", ".join(
        f"CASE WHEN max(CASE WHEN symbol = '{s}' THEN 1 END) IS NULL THEN 0.0 ELSE max(CASE WHEN symbol = '{s}' THEN ret END) END AS r_{s}"
        for s in SYMBOLS
    )
    + " FROM cells GROUP BY date",
)
def rsh_wider(spark: SparkSession, root: str) -> DataFrame:
    """Returns by symbol in columns; absent days are 0, a first day stays null."""
    returns = windows.add_return(price_panel(spark, root), ["symbol"], "date", "adjusted")
    return shape.wider(returns, ["date"], "symbol", "ret", SYMBOLS, fill=0.0, prefix="r_")


@query(
    "rsh_separate",
    """SELECT c_custkey, split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number FROM customer""",
)
def rsh_separate(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select("c_custkey", "c_name")
    return shape.separate(customers, "c_name", ["kind", "number"], "#")


YEARS = list(range(1995, 2002))
YEARLY = f"""{PRICES}, yearly AS (
  SELECT symbol, year(date) AS year,
         (arg_max(adjusted, date) - arg_min(adjusted, date)) / arg_min(adjusted, date) AS perf
  FROM prices GROUP BY 1, 2)"""


@query(
    "rsh_rowwise",
    f"""WITH {WIDE}, cells AS (
  SELECT c_nationkey, bal_AUTOMOBILE AS v FROM wide UNION ALL SELECT c_nationkey, bal_BUILDING FROM wide
  UNION ALL SELECT c_nationkey, bal_FURNITURE FROM wide UNION ALL SELECT c_nationkey, bal_HOUSEHOLD FROM wide
  UNION ALL SELECT c_nationkey, bal_MACHINERY FROM wide)
SELECT c_nationkey, round(avg(v), 5) AS bal_mean, round(median(v), 5) AS bal_median, round(stddev_samp(v), 5) AS bal_stdev,
       CAST(count(*) FILTER (v IS NULL) AS INT) AS bal_missing
FROM cells GROUP BY 1""",
)
def rsh_rowwise(spark: SparkSession, root: str) -> DataFrame:
    wide = wide_balances(spark, root)
    out = shape.row_stats(wide, sel.names(wide, sel.starts_with("bal_")), "bal")
    return out.select(
        "c_nationkey",
        *[F.round(f"bal_{s}", 5).alias(f"bal_{s}") for s in ("mean", "median", "stdev")],
        "bal_missing",
    )


@query(
    "rsh_transpose",
    f"""WITH {DAILY}, yearly AS (
  SELECT id, year(date) AS y, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v FROM daily GROUP BY 1, 2)
SELECT 'y_' || y AS year, """
    + ", ".join(f"max(CASE WHEN id = '{s}' THEN v END) AS v_{s}" for s in SEGMENTS)
    + " FROM yearly GROUP BY 1",
)
def rsh_transpose(spark: SparkSession, root: str) -> DataFrame:
    """Segments by year, turned into years by segment."""
    yearly = daily_panel(spark, root).groupBy("id", F.year("date").alias("y")).agg(exact_sum("value").alias("v"))
    wide = shape.wider(yearly, ["id"], "y", "v", YEARS, prefix="y_")
    return shape.transpose(wide, "id", [f"y_{y}" for y in YEARS], SEGMENTS, "year")


@query(
    "rsh_enframe",
    """SELECT s_suppkey, 'balance' AS name, s_acctbal AS value FROM supplier
       UNION ALL SELECT s_suppkey, 'nation', CAST(s_nationkey AS DOUBLE) FROM supplier""",
)
def rsh_enframe(spark: SparkSession, root: str) -> DataFrame:
    named = F.create_map(
        F.lit("balance"), F.col("s_acctbal"), F.lit("nation"), F.col("s_nationkey").cast("double")
    )
    return shape.enframe(table(spark, root, "supplier"), ["s_suppkey"], named)


@query(
    "prj_scalar",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_extendedprice > (SELECT 0.9 * max(l_extendedprice) FROM lineitem)""",
)
def prj_scalar(spark: SparkSession, root: str) -> DataFrame:
    """One value pulled from a table and used in a predicate, without leaving the plan."""
    lines = table(spark, root, "lineitem")
    top = lines.agg(F.max("l_extendedprice") * 0.9).scalar()
    return lines.where(F.col("l_extendedprice") > top).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "prj_ifelse",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END AS size,
       CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished FROM orders""",
)
def prj_ifelse(spark: SparkSession, root: str) -> DataFrame:
    """Two-way choice; a null test gives null."""
    test = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")) == "F"
    return table(spark, root, "orders").select(
        "o_orderkey",
        F.when(F.col("o_totalprice") >= 250000, "large").otherwise("small").alias("size"),
        F.when(test.isNotNull(), F.when(test, 1).otherwise(0)).alias("finished"),
    )
