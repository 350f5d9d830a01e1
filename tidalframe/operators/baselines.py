"""Baseline forecasts per series: window aggregates and the last season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidalframe.operators.joins import by_group
from tidalframe.functions.exact import mean
from tidalframe.operators.windows import panel_tail


def window_level(
    train: DataFrame,
    ids: Sequence[str],
    date: str,
    value: str,
    size: int,
    stat: str = "median",
    scale: int | None = None,
) -> DataFrame:
    """Median or mean of the last ``size`` values of each series."""
    tail = panel_tail(train, ids, date, size)
    level = F.percentile(value, F.lit(0.5)) if stat == "median" else mean(value, scale)
    return tail.groupBy(*ids).agg(level.alias("prediction"))


def window_forecast(
    train: DataFrame,
    future: DataFrame,
    ids: Sequence[str],
    date: str,
    value: str,
    size: int,
    stat: str = "median",
    scale: int | None = None,
) -> DataFrame:
    """The window level repeated over the rows of ``future``; null for a series without training rows."""
    return by_group(future, window_level(train, ids, date, value, size, stat, scale), list(ids), "left")


def window_levels(
    train: DataFrame, ids: Sequence[str], date: str, value: str, sizes: Sequence[int]
) -> DataFrame:
    """Medians of several window sizes from one tail: (ids, size, prediction)."""
    ids = list(ids)
    w = Window.partitionBy(*ids).orderBy(F.col(date).desc())
    tail = train.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= max(sizes))
    levels = tail.groupBy(*ids).agg(
        *[F.percentile(F.when(F.col("_back") <= s, F.col(value)), F.lit(0.5)).alias(f"{s}") for s in sizes]
    )
    long = levels.unpivot(ids, [f"{s}" for s in sizes], "size", "prediction")
    return long.withColumn("size", F.col("size").cast("int"))


def steps_ahead(df: DataFrame, ids: Sequence[str], date: str) -> DataFrame:
    """Number the rows of each series 1.. as ``h``."""
    w = Window.partitionBy(*ids).orderBy(date)
    return df.withColumn("h", F.row_number().over(w))


def seasonal_naive(
    train: DataFrame, future: DataFrame, ids: Sequence[str], date: str, value: str, season: int
) -> DataFrame:
    """Step h repeats the value at its place in the last season.

    ``future`` carries the step number ``h`` (see ``steps_ahead``).
    """
    ids = list(ids)
    w = Window.partitionBy(*ids).orderBy(F.col(date).desc())
    last = (
        train.withColumn("_back", F.row_number().over(w))
        .where(F.col("_back") <= season)
        .select(*ids, (season - F.col("_back")).alias("_slot"), F.col(value).alias("prediction"))
    )
    slotted = future.withColumn("_slot", F.pmod(F.col("h") - 1, F.lit(season)))
    return by_group(slotted, last, [*ids, "_slot"], "left").drop("_slot")
