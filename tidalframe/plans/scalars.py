"""Text, date, number and category functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions import dates, text
from tidalframe.operators import features
from tidalframe.plans.inputs import UNKNOWN, unknown_prices
from tidalframe.plans.registry import query
from tidalframe.sources.tables import table


@query(
    "str_concat",
    f"""WITH {UNKNOWN} SELECT o_orderkey, o_orderpriority || '_' || status AS id,
        'order ' || o_orderkey || ' of ' || o_custkey AS label FROM unknown""",
)
def str_concat(spark: SparkSession, root: str) -> DataFrame:
    """A null piece makes the joined text null."""
    return unknown_prices(spark, root).select(
        "o_orderkey",
        F.concat("o_orderpriority", F.lit("_"), "status").alias("id"),
        F.format_string("order %d of %d", "o_orderkey", "o_custkey").alias("label"),
    )


@query(
    "str_replace",
    """SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '') AS first_gone, replace(p_name, ' ', '_') AS joined,
       replace(p_brand, 'Brand#', '') AS brand FROM part""",
)
def str_replace(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        "p_partkey",
        text.remove_first("p_name", "[aeiou]").alias("first_gone"),
        text.replace_all("p_name", " ", "_").alias("joined"),
        text.remove_first("p_brand", "Brand#").alias("brand"),
    )


@query(
    "str_title",
    """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
       lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part""",
)
def str_title(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select("p_partkey", text.title("p_name").alias("title"))


@query(
    "str_parse_number",
    """SELECT event_id, TRY_CAST(replace(regexp_extract(props, '-?[0-9,]*\\.?[0-9]+', 0), ',', '') AS DOUBLE) AS k,
       TRY_CAST(replace(regexp_extract('$' || CAST(event_id AS VARCHAR) || ',500.25 paid', '-?[0-9,]*\\.?[0-9]+', 0), ',', '') AS DOUBLE) AS paid
       FROM events""",
)
def str_parse_number(spark: SparkSession, root: str) -> DataFrame:
    paid = F.concat(F.lit("$"), F.col("event_id").cast("string"), F.lit(",500.25 paid"))
    return table(spark, root, "events").select(
        "event_id", text.parse_number("props").alias("k"), text.parse_number(paid).alias("paid")
    )


@query(
    "str_try_cast",
    """SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS DOUBLE) AS rank, TRY_CAST(o_orderpriority AS DOUBLE) AS bad,
       CAST(o_custkey AS VARCHAR) AS customer FROM orders""",
)
def str_try_cast(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select(
        "o_orderkey",
        text.to_number(F.substring("o_orderpriority", 1, 1)).alias("rank"),
        text.to_number("o_orderpriority").alias("bad"),
        F.col("o_custkey").cast("string").alias("customer"),
    )


@query(
    "dat_parse",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_number, CAST(date_trunc('month', o_orderdate) AS DATE) AS from_month,
       CASE WHEN month(o_orderdate) < 12 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS from_parts FROM orders""",
)
def dat_parse(spark: SparkSession, root: str) -> DataFrame:
    """Dates from yyyymmdd, from ``Jan 2001`` and from parts; a total row has no month."""
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    month = F.when(F.month("o_orderdate") < 12, F.month("o_orderdate").cast("string")).otherwise("TOTAL")
    return table(spark, root, "orders").select(
        "o_orderkey",
        dates.parse_ymd(number).alias("from_number"),
        dates.parse_month_year(F.date_format("o_orderdate", "MMM yyyy")).alias("from_month"),
        dates.from_parts(F.year("o_orderdate"), month).alias("from_parts"),
    )


@query(
    "dat_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter,
       CAST(month(o_orderdate) AS INT) AS month, CAST(day(o_orderdate) AS INT) AS day FROM orders""",
)
def dat_parts(spark: SparkSession, root: str) -> DataFrame:
    d = "o_orderdate"
    return table(spark, root, "orders").select(
        "o_orderkey",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
    )


SIGNATURE = """
  CAST(epoch(d) AS BIGINT) AS index_num, CAST(year(d) AS INT) AS year, CAST(isoyear(d) AS INT) AS year_iso,
  CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS half, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
  CAST(month(d) - 1 AS INT) AS month_xts, monthname(d) AS month_lbl, CAST(day(d) AS INT) AS day, 0 AS hour, 0 AS minute,
  0 AS second, 0 AS hour12, 1 AS am_pm, CAST(dayofweek(d) + 1 AS INT) AS wday, CAST(dayofweek(d) AS INT) AS wday_xts,
  dayname(d) AS wday_lbl, CAST(day(d) AS INT) AS mday, CAST(d - CAST(date_trunc('quarter', d) AS DATE) + 1 AS INT) AS qday,
  CAST(dayofyear(d) AS INT) AS yday,
  CAST((day(d) + dayofweek(CAST(date_trunc('month', d) AS DATE)) - 1) // 7 + 1 AS INT) AS mweek,
  CAST((dayofyear(d) - 1) // 7 + 1 AS INT) AS week, CAST(weekofyear(d) AS INT) AS week_iso,
  CAST(((dayofyear(d) - 1) // 7 + 1) % 2 AS INT) AS week2, CAST(((dayofyear(d) - 1) // 7 + 1) % 3 AS INT) AS week3,
  CAST(((dayofyear(d) - 1) // 7 + 1) % 4 AS INT) AS week4, CAST((day(d) - 1) // 7 + 1 AS INT) AS mday7"""


@query(
    "dat_signature",
    f"WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) SELECT d, {SIGNATURE} FROM days",
)
def dat_signature(spark: SparkSession, root: str) -> DataFrame:
    """All calendar features of every order date."""
    days = table(spark, root, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return days.withColumns(dates.signature("d"))


@query(
    "mth_log",
    """SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS log_price,
       CASE WHEN l_discount > 0 THEN round(ln(l_discount), 6) END AS log_discount, round(l_quantity * 0.8) AS rounded FROM lineitem""",
)
def mth_log(spark: SparkSession, root: str) -> DataFrame:
    """The logarithm of zero is null here, not minus infinity."""
    return table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.log("l_extendedprice"), 6).alias("log_price"),
        F.round(F.log("l_discount"), 6).alias("log_discount"),
        F.round(F.col("l_quantity") * 0.8).alias("rounded"),
    )


@query(
    "fct_recode",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' ELSE o_orderstatus END AS finished FROM orders""",
)
def fct_recode(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select(
        "o_orderkey", features.recode("o_orderstatus", {"F": "yes", "O": "no"}).alias("finished")
    )


@query(
    "fct_code",
    """WITH l AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) AS INT) AS code FROM (SELECT DISTINCT p_brand FROM part))
       SELECT p_partkey, p_brand, code FROM part JOIN l USING (p_brand)""",
)
def fct_code(spark: SparkSession, root: str) -> DataFrame:
    """Level number of a category in alphabetical order."""
    return features.level_code(table(spark, root, "part").select("p_partkey", "p_brand"), "p_brand", "code")


@query(
    "fct_drop",
    """SELECT o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) AS INT) AS code, n FROM
       (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 250000 AND o_orderpriority <> '2-HIGH' GROUP BY 1)""",
)
def fct_drop(spark: SparkSession, root: str) -> DataFrame:
    """After a filter, levels without rows take no code."""
    kept = table(spark, root, "orders").where("o_totalprice > 250000 AND o_orderpriority <> '2-HIGH'")
    counts = kept.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return features.level_code(counts, "o_orderpriority", "code")
