"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions.exact import exact_mean, exact_sum
from tidalframe.operators import aggregates, ordered, shape, windows
from tidalframe.plans.inputs import (
    DAILY,
    EVENT_DAYS,
    MONTHLY,
    PRICES,
    SYMBOLS,
    UNKNOWN,
    daily_panel,
    event_days,
    monthly_panel,
    order_days,
    price_panel,
    unknown_prices,
)
from tidalframe.plans.registry import query
from tidalframe.sources.tables import table

MONEY = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


@query(
    "agg_group",
    f"""SELECT l_returnflag, l_linestatus, {MONEY.format('l_quantity')} AS sum_qty,
        {MONEY.format('l_extendedprice')} AS sum_price, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def agg_group(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        exact_sum("l_quantity").alias("sum_qty"),
        exact_sum("l_extendedprice").alias("sum_price"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "agg_count",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey",
)
def agg_count(spark: SparkSession, root: str) -> DataFrame:
    counts = table(spark, root, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "o_custkey")


@query(
    "agg_sum_mean",
    f"""WITH {UNKNOWN} SELECT o_custkey, coalesce({MONEY.format('price')}, 0) AS total,
        {MONEY.format('price')} / nullif(count(price), 0) AS average FROM unknown GROUP BY 1""",
)
def agg_sum_mean(spark: SparkSession, root: str) -> DataFrame:
    """Unknown prices are left out; a sum of nothing is 0, a mean of nothing null."""
    return unknown_prices(spark, root).groupBy("o_custkey").agg(
        F.coalesce(exact_sum("price"), F.lit(0.0)).alias("total"), exact_mean("price").alias("average")
    )


@query(
    "agg_minmax",
    """SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date,
       min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM orders GROUP BY 1""",
)
def agg_minmax(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("first_date"),
        F.max("o_orderdate").cast("date").alias("last_date"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
    )


@query(
    "agg_median",
    """SELECT l_returnflag, round(median(l_extendedprice), 4) AS price, round(median(l_quantity), 4) AS quantity
       FROM lineitem GROUP BY 1""",
)
def agg_median(spark: SparkSession, root: str) -> DataFrame:
    """Exact medians of three groups that share the whole table."""
    lines = table(spark, root, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity")
    )
    long = shape.longer(lines, ["l_returnflag"], ["price", "quantity"], "what", "v")
    middle = ordered.exact_quantiles(long, ["l_returnflag", "what"], "v", {"m": 0.5})
    wide = shape.wider(middle, ["l_returnflag"], "what", "m", ["price", "quantity"])
    return wide.select("l_returnflag", F.round("price", 4).alias("price"), F.round("quantity", 4).alias("quantity"))


@query(
    "agg_sd",
    "SELECT c_mktsegment, round(stddev_samp(c_acctbal), 6) AS sd, count(*) AS n FROM customer GROUP BY 1",
)
def agg_sd(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").groupBy("c_mktsegment").agg(
        F.round(F.stddev_samp("c_acctbal"), 6).alias("sd"), F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_first_last",
    f"""WITH {PRICES} SELECT symbol, year(date) AS year, arg_min(adjusted, date) AS first_price,
        arg_max(adjusted, date) AS last_price, count(*) AS n FROM prices GROUP BY 1, 2""",
)
def agg_first_last(spark: SparkSession, root: str) -> DataFrame:
    return price_panel(spark, root).groupBy("symbol", F.year("date").alias("year")).agg(
        F.min_by("adjusted", "date").alias("first_price"),
        F.max_by("adjusted", "date").alias("last_price"),
        F.count(F.lit(1)).alias("n"),
    )


@query("agg_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def agg_distinct(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").select("l_partkey", "l_returnflag").distinct()


@query(
    "agg_having",
    "SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1",
)
def agg_having(spark: SparkSession, root: str) -> DataFrame:
    """Customers with several orders on one day."""
    orders = table(spark, root, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("date"))
    return orders.groupBy("o_custkey", "date").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(
    "agg_prop",
    """SELECT event_type, count(*) AS n, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS prop
       FROM events GROUP BY 1""",
)
def agg_prop(spark: SparkSession, root: str) -> DataFrame:
    counts = table(spark, root, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("prop", F.col("n") / total.cast("double"))


@query(
    "agg_hierarchy",
    """WITH base AS (
  SELECT r_name, n_name, c_mktsegment, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_totalprice AS v
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)
SELECT category, identifier, date, CAST(SUM(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS value FROM (
  SELECT 'all' AS category, 'all' AS identifier, date, v FROM base
  UNION ALL SELECT 'region', r_name, date, v FROM base
  UNION ALL SELECT 'nation', n_name, date, v FROM base
  UNION ALL SELECT 'segment', c_mktsegment, date, v FROM base) GROUP BY 1, 2, 3""",
)
def agg_hierarchy(spark: SparkSession, root: str) -> DataFrame:
    """Month totals of the world, each region, each nation and each segment."""
    customers = table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nations = table(spark, root, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    regions = table(spark, root, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    rows = (
        order_days(spark, root)
        .withColumn("date", F.trunc("date", "month"))
        .join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .join(regions, "n_regionkey")
    )
    levels = {"region": "r_name", "nation": "n_name", "segment": "c_mktsegment"}
    return aggregates.hierarchy(rows, levels, "date", "spend", scale=2)


@query(
    "agg_by_time",
    f"""SELECT o_orderpriority, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date,
        {MONEY.format('o_totalprice')} AS total, count(*) AS n FROM orders GROUP BY 1, 2""",
)
def agg_by_time(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").withColumn("date", F.col("o_orderdate").cast("date"))
    return aggregates.by_period(
        orders,
        ["o_orderpriority"],
        "date",
        "quarter",
        exact_sum("o_totalprice").alias("total"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "agg_profile_missing",
    f"""WITH {UNKNOWN}, m AS (SELECT count(*) AS n, count(*) - count(o_orderkey) AS a, count(*) - count(o_custkey) AS b,
  count(*) - count(o_orderpriority) AS c, count(*) - count(status) AS d, count(*) - count(price) AS e FROM unknown)
SELECT 'o_orderkey' AS column_name, a AS n_missing, a / n AS pct_missing FROM m
UNION ALL SELECT 'o_custkey', b, b / n FROM m UNION ALL SELECT 'o_orderpriority', c, c / n FROM m
UNION ALL SELECT 'status', d, d / n FROM m UNION ALL SELECT 'price', e, e / n FROM m
ORDER BY pct_missing DESC, column_name""",
)
def agg_profile_missing(spark: SparkSession, root: str) -> DataFrame:
    found = aggregates.missing_profile(unknown_prices(spark, root))
    return found.orderBy(F.col("pct_missing").desc(), "column_name")


def _profile_sql(cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS n_missing,
  CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c}) AS mean, round(stddev_samp({c}), 4) AS sd,
  CAST(min({c}) AS DOUBLE) AS p0, CAST(max({c}) AS DOUBLE) AS p100, round(quantile_cont({c}, 0.25), 4) AS p25,
  round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, count(DISTINCT {c}) AS n_unique
  FROM lines"""
        for c in cols
    )


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query(
    "agg_profile",
    "WITH lines AS (SELECT CASE WHEN l_linestatus = 'F' THEN l_quantity END AS l_quantity, l_extendedprice, l_discount, "
    f"CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem) {_profile_sql(PROFILED)}",
)
def agg_profile(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        "l_discount",
        "l_linenumber",
    )
    out = aggregates.profile(lines, PROFILED, scale=2)
    return out.withColumns({p: F.round(p, 4) for p in ("p25", "p50", "p75")})


@query(
    "agg_ts_diag",
    f"""WITH {DAILY}, gaps AS (
  SELECT id, date, CAST(date - lag(date) OVER (PARTITION BY id ORDER BY date) AS DOUBLE) * 86400 AS step FROM daily),
out AS (SELECT id, count(*) AS n_obs, min(date) AS "start", max(date) AS "end", min(step) AS diff_min,
  quantile_cont(step, 0.25) AS diff_q1, quantile_cont(step, 0.5) AS diff_median, sum(step) / count(step) AS diff_mean,
  quantile_cont(step, 0.75) AS diff_q3, max(step) AS diff_max FROM gaps GROUP BY 1)
SELECT *, CASE WHEN diff_median < 7 * 86400 THEN 'day' WHEN diff_median < 28 * 86400 THEN 'week'
  WHEN diff_median < 89 * 86400 THEN 'month' WHEN diff_median < 360 * 86400 THEN 'quarter' ELSE 'year' END AS scale FROM out""",
)
def agg_ts_diag(spark: SparkSession, root: str) -> DataFrame:
    return aggregates.series_diagnostics(daily_panel(spark, root), ["id"], "date")


RETURNS_WIDE = f"""{PRICES}, returns AS (
  SELECT symbol, date, (adjusted - lag(adjusted) OVER w) / lag(adjusted) OVER w AS ret
  FROM prices WINDOW w AS (PARTITION BY symbol ORDER BY date)),
wide AS (SELECT date, """ + ", ".join(
    f"CASE WHEN max(CASE WHEN symbol = '{s}' THEN 1 END) IS NULL THEN 0.0 ELSE max(CASE WHEN symbol = '{s}' THEN ret END) END AS {s}"
    for s in SYMBOLS
) + " FROM returns GROUP BY date), full_days AS (SELECT * FROM wide WHERE " + " AND ".join(
    f"{s} IS NOT NULL" for s in SYMBOLS
) + ")"


def returns_wide(spark: SparkSession, root: str) -> DataFrame:
    returns = windows.add_return(price_panel(spark, root), ["symbol"], "date", "adjusted")
    wide = shape.wider(returns, ["date"], "symbol", "ret", SYMBOLS, fill=0.0)
    return wide.dropna(how="any", subset=SYMBOLS)


@query(
    "agg_corr",
    f"WITH {RETURNS_WIDE} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {'1.0::DOUBLE' if a == b else f'round(corr({a}, {b}), 6)'} AS r FROM full_days"
        + (" LIMIT 1" if a == b else "")
        if a != b
        else f"SELECT '{a}' AS x, '{b}' AS y, 1.0::DOUBLE AS r"
        for a in SYMBOLS
        for b in SYMBOLS
    ),
)
def agg_corr(spark: SparkSession, root: str) -> DataFrame:
    return aggregates.correlation(returns_wide(spark, root), SYMBOLS)


ACF_LAGS = 12


@query(
    "agg_acf",
    f"""WITH {MONTHLY}, centred AS (SELECT id, date, value - avg(value) OVER (PARTITION BY id) AS c FROM monthly),
lags AS (SELECT unnest(range(0, {ACF_LAGS + 1})) AS lag),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date) AS i FROM centred)
SELECT a.id, CAST(l.lag AS INT) AS lag, round(sum(a.c * b.c) / max(t.total), 6) AS acf
FROM lags l, numbered a JOIN numbered b ON a.id = b.id JOIN (SELECT id, sum(c * c) AS total FROM centred GROUP BY 1) t ON t.id = a.id
WHERE a.i = b.i + l.lag GROUP BY 1, 2""",
)
def agg_acf(spark: SparkSession, root: str) -> DataFrame:
    acf = aggregates.autocorrelation(monthly_panel(spark, root), ["id"], "date", "value", ACF_LAGS)
    return acf.withColumn("acf", F.round("acf", 6))


@query(
    "agg_pacf",
    f"""WITH RECURSIVE {MONTHLY}, centred AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY date) AS i,
  value - avg(value) OVER (PARTITION BY id) AS c FROM monthly),
lags AS (SELECT unnest(range(1, {ACF_LAGS + 1})) AS k),
acf AS (SELECT a.id, k, sum(a.c * b.c) / max(t.total) AS r FROM lags, centred a JOIN centred b ON a.id = b.id
  JOIN (SELECT id, sum(c * c) AS total FROM centred GROUP BY 1) t ON t.id = a.id WHERE a.i = b.i + k GROUP BY 1, 2),
rho AS (SELECT id, list(r ORDER BY k) AS rho FROM acf GROUP BY 1),
steps(id, rho, k, phi) AS (
  SELECT id, rho, 1, [rho[1]] FROM rho
  UNION ALL
  SELECT id, rho, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - last * phi[k + 1 - j]), last) FROM (
    SELECT *, (rho[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rho[k + 1 - j])))
            / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rho[j]))) AS last FROM steps) WHERE k < {ACF_LAGS})
SELECT id, CAST(k AS INT) AS lag, round(phi[k], 6) AS pacf FROM steps""",
)
def agg_pacf(spark: SparkSession, root: str) -> DataFrame:
    acf = aggregates.autocorrelation(monthly_panel(spark, root), ["id"], "date", "value", ACF_LAGS)
    return aggregates.partial_autocorrelation(acf, ["id"]).withColumn("pacf", F.round("pacf", 6))


@query(
    "agg_seasonal",
    """WITH keyed AS (SELECT o_totalprice AS v, CAST(o_orderdate AS DATE) AS d FROM orders), long AS (
  SELECT 'weekday' AS feature, CAST(dayofweek(d) + 1 AS INT) AS level, v FROM keyed
  UNION ALL SELECT 'month', CAST(month(d) AS INT), v FROM keyed
  UNION ALL SELECT 'quarter', CAST(quarter(d) AS INT), v FROM keyed
  UNION ALL SELECT 'year', CAST(year(d) AS INT), v FROM keyed)
SELECT feature, level, count(*) AS n, min(v) AS lowest, max(v) AS highest, round(quantile_cont(v, 0.25), 4) AS q1,
  round(quantile_cont(v, 0.5), 4) AS med, round(quantile_cont(v, 0.75), 4) AS q3 FROM long GROUP BY 1, 2""",
)
def agg_seasonal(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    out = aggregates.seasonal_profile(orders, "d", "o_totalprice")
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "med", "q3")})


@query(
    "agg_event_days",
    f"WITH {EVENT_DAYS} SELECT id, date, value FROM event_days",
)
def agg_event_days(spark: SparkSession, root: str) -> DataFrame:
    return event_days(spark, root)
