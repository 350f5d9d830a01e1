"""Lags, differences and rolling statistics over panels.

A panel holds one row per (series, date) and dates are days, so the rows of one
series are bounded by the calendar (a century is 36,525 rows). Build panels with
``panel_of``, which adds up raw rows before anything is windowed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidalframe.operators.joins import by_group
from tidalframe.functions.exact import mean, total


def panel_of(
    df: DataFrame, ids: Sequence[str], date: str, value: str, out: str = "value", scale: int | None = None
) -> DataFrame:
    return df.groupBy(*ids, date).agg(total(value, scale).alias(out))


def in_order(ids: Sequence[str], date: str) -> WindowSpec:
    return Window.partitionBy(*ids).orderBy(date)


def add_lags(
    panel: DataFrame, ids: Sequence[str], date: str, value: str, lags: Sequence[int], names: Sequence[str] | None = None
) -> DataFrame:
    w = in_order(ids, date)
    names = names or [f"{value}_lag{k}" for k in lags]
    return panel.select("*", *[F.lag(value, k).over(w).alias(n) for k, n in zip(lags, names)])


def add_diffs(panel: DataFrame, ids: Sequence[str], date: str, value: str, lags: Sequence[int]) -> DataFrame:
    w = in_order(ids, date)
    return panel.select(
        "*", *[(F.col(value) - F.lag(value, k).over(w)).alias(f"{value}_diff{k}") for k in lags]
    )


def add_return(panel: DataFrame, ids: Sequence[str], date: str, value: str, out: str = "ret") -> DataFrame:
    before = F.lag(value, 1).over(in_order(ids, date))
    return panel.withColumn(out, F.try_divide(F.col(value) - before, before))


def centred_frame(ids: Sequence[str], date: str, period: int) -> WindowSpec:
    """Rows ``floor(k/2)`` before to ``ceil(k/2) - 1`` after."""
    return in_order(ids, date).rowsBetween(-(period // 2), (period + 1) // 2 - 1)


def add_rolling_mean(
    panel: DataFrame,
    ids: Sequence[str],
    date: str,
    value: str,
    periods: Sequence[int],
    scale: int | None = None,
) -> DataFrame:
    """Centred rolling means; edges use the rows there are, nulls are left out."""
    return panel.select(
        "*",
        *[mean(value, scale, centred_frame(ids, date, k)).alias(f"{value}_roll_{k}") for k in periods],
    )


def rolling_apply(
    panel: DataFrame,
    ids: Sequence[str],
    date: str,
    value: str,
    period: int,
    fn: Callable[[Column], Column],
    out: str,
) -> DataFrame:
    """Any array function over a centred frame of at most ``period`` values."""
    frame = F.collect_list(value).over(centred_frame(ids, date, period))
    return panel.withColumn(out, fn(frame))


def array_median(values: Column) -> Column:
    """Median of an array column, null when it is empty."""
    ordered = F.array_sort(values)
    n = F.size(ordered)
    low = F.try_element_at(ordered, F.floor((n + 1) / 2).cast("int"))
    high = F.try_element_at(ordered, (F.floor(n / 2) + 1).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def panel_tail(panel: DataFrame, ids: Sequence[str], date: str, n: int) -> DataFrame:
    """Last ``n`` rows of every series."""
    w = Window.partitionBy(*ids).orderBy(F.col(date).desc())
    return panel.withColumn("_row", F.row_number().over(w)).where(F.col("_row") <= n).drop("_row")


def standardise(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Each column minus its mean over its sample sd, per group if any.

    Means and deviations are aggregates joined back, not a window over the rows.
    """
    stats = df.groupBy(*by).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols]
    )
    if by:
        joined = by_group(df, stats, list(by))
        middle, sd = (lambda c: F.col(f"_m_{c}")), (lambda c: F.col(f"_s_{c}"))
    else:
        joined = df
        one = stats.select(F.struct("*").alias("s")).scalar()
        middle, sd = (lambda c: one[f"_m_{c}"]), (lambda c: one[f"_s_{c}"])
    keep = [
        F.try_divide(F.col(c) - middle(c), sd(c)).alias(c) if c in cols else F.col(c) for c in df.columns
    ]
    return joined.select(*keep)


def clean_series(panel: DataFrame, ids: Sequence[str], date: str, value: str, period: int) -> DataFrame:
    """Replace outliers of a seasonal series by interpolation.

    Trend is a centred median over one season, the season is the median
    remainder per position in it, and what is left may stray three interquartile
    ranges from the quartiles. Adds ``<value>_clean``.
    """
    ids = list(ids)
    half = period // 2
    whole, w = Window.partitionBy(*ids), in_order(ids, date)
    slot = Window.partitionBy(*ids, "_slot")
    frame = w.rowsBetween(-half, half)
    steps = panel.select(
        "*",
        (F.col(value) - array_median(F.collect_list(value).over(frame))).alias("_detrended"),
        F.pmod(F.row_number().over(w) - 1, F.lit(period)).alias("_slot"),
    )
    seasonal = steps.withColumn("_season", F.percentile("_detrended", F.lit(0.5)).over(slot))
    rest = seasonal.withColumn("_rest", F.col("_detrended") - F.col("_season"))
    bounds = rest.withColumn("_q1", F.percentile("_rest", F.lit(0.25)).over(whole)).withColumn(
        "_q3", F.percentile("_rest", F.lit(0.75)).over(whole)
    )
    reach = 3 * (F.col("_q3") - F.col("_q1"))
    fine = (F.col("_rest") >= F.col("_q1") - reach) & (F.col("_rest") <= F.col("_q3") + reach)
    marked = bounds.withColumn("_kept", F.when(fine, F.col(value))).withColumn("_n", F.row_number().over(w))
    point = F.when(F.col("_kept").isNotNull(), F.struct(F.col("_n").alias("at"), F.col("_kept").alias("v")))
    before = F.last(point, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(point, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    both = marked.withColumn("_before", before).withColumn("_after", after)
    b, a = F.col("_before"), F.col("_after")
    between = b["v"] + (a["v"] - b["v"]) * (F.col("_n") - b["at"]) / (a["at"] - b["at"])
    cleaned = F.when(F.col("_kept").isNotNull(), F.col("_kept")).otherwise(
        F.coalesce(F.when(b.isNotNull() & a.isNotNull(), between), b["v"], a["v"])
    )
    return both.select(*panel.columns, cleaned.alias(f"{value}_clean"))

