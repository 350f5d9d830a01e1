"""Lags, returns, rolling statistics, cleaning, user functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import nested, ordered, windows
from tidalframe.plans.inputs import (
    DAILY,
    LOG,
    MONTHLY,
    PRICES,
    daily_panel,
    kept,
    monthly_panel,
    price_panel,
    transactions,
)
from tidalframe.plans.registry import query
from tidalframe.sources.tables import table

W = "WINDOW w AS (PARTITION BY id ORDER BY date)"


@query(
    "win_lags",
    f"""WITH {DAILY} SELECT id, date, value, lag(value, 1) OVER w AS value_lag1, lag(value, 7) OVER w AS value_lag7,
        lag(value, 28) OVER w AS value_lag28 FROM daily {W}""",
)
def win_lags(spark: SparkSession, root: str) -> DataFrame:
    return windows.add_lags(daily_panel(spark, root), ["id"], "date", "value", [1, 7, 28])


@query(
    "win_diff",
    f"""WITH {DAILY} SELECT id, date, value, value - lag(value, 1) OVER w AS value_diff1,
        value - lag(value, 7) OVER w AS value_diff7 FROM daily {W}""",
)
def win_diff(spark: SparkSession, root: str) -> DataFrame:
    return windows.add_diffs(daily_panel(spark, root), ["id"], "date", "value", [1, 7])


@query(
    "win_return",
    f"""WITH {PRICES}
SELECT symbol, date, (adjusted - lag(adjusted) OVER w) / lag(adjusted) OVER w AS ret, 'day' AS kind
FROM prices WINDOW w AS (PARTITION BY symbol ORDER BY date)
UNION ALL
SELECT symbol, CAST(date_trunc('year', date) AS DATE),
  (arg_max(adjusted, date) - arg_min(adjusted, date)) / arg_min(adjusted, date), 'year'
FROM prices GROUP BY 1, 2""",
)
def win_return(spark: SparkSession, root: str) -> DataFrame:
    """Daily returns and the return of each year from its first to its last price."""
    prices = kept(price_panel(spark, root))
    daily = windows.add_return(prices, ["symbol"], "date", "adjusted")
    first, last = F.min_by("adjusted", "date"), F.max_by("adjusted", "date")
    yearly = prices.groupBy("symbol", F.trunc("date", "year").alias("date")).agg(
        F.try_divide(last - first, first).alias("ret")
    )
    cols = ["symbol", "date", "ret"]
    return daily.select(*cols, F.lit("day").alias("kind")).unionByName(
        yearly.select(*cols, F.lit("year").alias("kind"))
    )


def _roll_sql(col: str, k: int) -> str:
    frame = f"(PARTITION BY id ORDER BY date ROWS BETWEEN {k // 2} PRECEDING AND {(k + 1) // 2 - 1} FOLLOWING)"
    return (
        f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) OVER {frame} AS DOUBLE) / "
        f"nullif(count({col}) OVER {frame}, 0) AS {col}_roll_{k}"
    )


@query(
    "win_slidify",
    f"""WITH {DAILY}, lagged AS (SELECT id, date, value, lag(value, 28) OVER w AS value_lag28 FROM daily {W})
SELECT id, date, value, value_lag28, {', '.join(_roll_sql('value_lag28', k) for k in (7, 14, 28, 56))} FROM lagged""",
)
def win_slidify(spark: SparkSession, root: str) -> DataFrame:
    """A long lag and its centred rolling means."""
    lagged = windows.add_lags(daily_panel(spark, root), ["id"], "date", "value", [28])
    return windows.add_rolling_mean(lagged, ["id"], "date", "value_lag28", [7, 14, 28, 56], scale=2)


@query(
    "win_smooth",
    f"WITH {DAILY} SELECT id, date, value, {_roll_sql('value', 29)} FROM daily",
)
def win_smooth(spark: SparkSession, root: str) -> DataFrame:
    """The smooth line behind a plot: a centred mean over 29 days."""
    return windows.add_rolling_mean(daily_panel(spark, root), ["id"], "date", "value", [29], scale=2)


@query(
    "win_slice_min",
    f"WITH {LOG} SELECT customer_id, date, price FROM log QUALIFY rank() OVER (PARTITION BY customer_id ORDER BY date) = 1",
)
def win_slice_min(spark: SparkSession, root: str) -> DataFrame:
    """Each customer's first purchases, all of that day."""
    return ordered.slice_extreme(transactions(spark, root), ["customer_id"], "date").select(
        "customer_id", "date", "price"
    )


@query(
    "win_panel_tail",
    f"""WITH {DAILY} SELECT id, date, value FROM daily
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY date DESC) <= 24""",
)
def win_panel_tail(spark: SparkSession, root: str) -> DataFrame:
    return windows.panel_tail(daily_panel(spark, root), ["id"], "date", 24)


CLEAN_SQL = f"""{MONTHLY}, spiked AS (
  SELECT id, date, CASE WHEN month(date) = 7 AND year(date) = 1998 THEN value * 9 ELSE value END AS value FROM monthly),
t1 AS (SELECT id, date, value, row_number() OVER (PARTITION BY id ORDER BY date) AS n,
    value - quantile_cont(value, 0.5) OVER f AS d
  FROM spiked WINDOW f AS (PARTITION BY id ORDER BY date ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
t2 AS (SELECT *, d - quantile_cont(d, 0.5) OVER (PARTITION BY id, (n - 1) % 12) AS r FROM t1),
t3 AS (SELECT *, quantile_cont(r, 0.25) OVER (PARTITION BY id) AS q1, quantile_cont(r, 0.75) OVER (PARTITION BY id) AS q3 FROM t2),
t4 AS (SELECT id, date, value, n, CASE WHEN r BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1) THEN value END AS kept FROM t3),
t5 AS (SELECT *, max(CASE WHEN kept IS NOT NULL THEN n END) OVER (PARTITION BY id ORDER BY n ROWS UNBOUNDED PRECEDING) AS bn,
    min(CASE WHEN kept IS NOT NULL THEN n END) OVER (PARTITION BY id ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS an FROM t4)
SELECT t.id, t.date, t.value, round(CASE WHEN t.kept IS NOT NULL THEN t.kept
    WHEN b.kept IS NOT NULL AND a.kept IS NOT NULL THEN b.kept + (a.kept - b.kept) * (t.n - t.bn) / (t.an - t.bn)
    ELSE coalesce(b.kept, a.kept) END, 4) AS value_clean
FROM t5 t LEFT JOIN t4 b ON b.id = t.id AND b.n = t.bn LEFT JOIN t4 a ON a.id = t.id AND a.n = t.an"""


@query("win_ts_clean", f"WITH {CLEAN_SQL}")
def win_ts_clean(spark: SparkSession, root: str) -> DataFrame:
    """A spike put into one month of each series is found and bridged."""
    spike = (F.month("date") == 7) & (F.year("date") == 1998)
    panel = monthly_panel(spark, root).withColumn("value", F.when(spike, F.col("value") * 9).otherwise(F.col("value")))
    cleaned = windows.clean_series(panel, ["id"], "date", "value", 12)
    return cleaned.withColumn("value_clean", F.round("value_clean", 4))


@query(
    "win_scale",
    """SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_samp(p_size) OVER (), 6) AS p_size,
       round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER (), 6) AS p_retailprice FROM part""",
)
def win_scale(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    scaled = windows.standardise(rows, ["p_size", "p_retailprice"])
    return scaled.withColumns({c: F.round(c, 6) for c in ("p_size", "p_retailprice")})


@query(
    "udf_transform",
    f"""WITH {MONTHLY} SELECT id, date, value, """
    + ", ".join(f"lag(value, {k}) OVER w AS value_lag{k}" for k in range(1, 13))
    + f" FROM monthly {W}",
)
def udf_transform(spark: SparkSession, root: str) -> DataFrame:
    """A user's own table function, passed as an argument."""

    def lag_transformer(panel: DataFrame) -> DataFrame:
        return windows.add_lags(panel, ["id"], "date", "value", range(1, 13))

    return monthly_panel(spark, root).transform(lag_transformer)


@query(
    "udf_window_agg",
    f"""WITH {DAILY} SELECT id, date, value, round(quantile_cont(value, 0.5) OVER
        (PARTITION BY id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 4) AS mid FROM daily""",
)
def udf_window_agg(spark: SparkSession, root: str) -> DataFrame:
    """A rolling median, written as a function of the frame's values."""
    panel = daily_panel(spark, root)
    out = windows.rolling_apply(panel, ["id"], "date", "value", 7, windows.array_median, "mid")
    return out.withColumn("mid", F.round("mid", 4))


@query("udf_grouped_map", f"WITH {MONTHLY} SELECT id, date, value FROM monthly QUALIFY row_number() OVER (PARTITION BY id ORDER BY date DESC) <= 24")
def udf_grouped_map(spark: SparkSession, root: str) -> DataFrame:
    """A Python table function per series; a monthly series is a few hundred rows."""

    def last_two_years(pdf):
        return pdf.sort_values("date").tail(24)

    panel = monthly_panel(spark, root)
    return nested.per_series(panel, ["id"], last_two_years, panel.schema)
