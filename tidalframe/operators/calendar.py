"""Filling gaps, appending future rows, time filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidalframe.operators.joins import by_group
from tidalframe.functions import dates

# Spark interval text per period.
STEPS = {
    "day": "1 day",
    "week": "7 day",
    "month": "1 month",
    "quarter": "3 month",
    "year": "1 year",
}


def filter_by_time(df: DataFrame, date: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Keep dates between two partial dates, both ends included.

    The bounds are literals, so on a file source they reach the scan.
    """
    if start:
        df = df.where(F.col(date) >= F.lit(dates.first_day(start)))
    if end and end != "end":
        df = df.where(F.col(date) <= F.lit(dates.last_day(end)))
    return df


def last_period(df: DataFrame, ids: Sequence[str], date: str, period: str) -> DataFrame:
    """Rows on or after each series' last date minus a period."""
    ends = df.groupBy(*ids).agg(F.max(date).alias("_end"))
    joined = by_group(df, ends, list(ids))
    return joined.where(F.col(date) >= dates.minus("_end", period)).drop("_end")


def every_date(df: DataFrame, ids: Sequence[str], date: str, unit: str = "day") -> DataFrame:
    """All dates from the first to the last of each series."""
    span = df.groupBy(*ids).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    grid = F.sequence("_a", "_b", F.expr(f"interval {STEPS[unit]}"))
    return span.select(*ids, F.explode(grid).alias(date))


def pad(df: DataFrame, ids: Sequence[str], date: str, unit: str = "day", fill: float | None = None) -> DataFrame:
    """Add the missing dates of each series; value columns get ``fill``.

    A null id is a series like any other. Rows whose date is none of the series' steps,
    or null, stay as they are.
    """
    keys, new = [*ids, date], [c for c in df.columns if c not in (*ids, date)]
    own = df.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *new)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    padded = every_date(df, ids, date, unit).join(own, same, "full")
    filled = [F.col(c) if fill is None else F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in new]
    return padded.select(*[F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in keys], *filled)


def likely_step(panel: DataFrame, ids: Sequence[str], date: str) -> DataFrame:
    """Last date and most frequent step (in days) of each series.

    A series of one date takes the step most frequent in the panel, a day if there is none.
    """
    w = Window.partitionBy(*ids).orderBy(date)
    gaps = panel.select(*ids, date, F.datediff(date, F.lag(date).over(w)).alias("_gap"))
    usual = gaps.agg(F.mode("_gap", True)).scalar()
    return gaps.groupBy(*ids).agg(
        F.max(date).alias("_end"), F.coalesce(F.mode("_gap", True), usual, F.lit(1)).alias("_gap")
    )


def future_rows(
    panel: DataFrame, ids: Sequence[str], date: str, length: int, unit: str | None = None
) -> DataFrame:
    """The next ``length`` dates of each series, with the step number ``h``.

    Without a unit the step is the series' most frequent one: 28 to 31 days is
    a month, 89 to 92 a quarter, 365 or 366 a year.
    """
    ids = list(ids)
    k = F.col("h")
    if unit is not None:
        ends = panel.groupBy(*ids).agg(F.max(date).alias("_end"))
        n, base = dates.split_period("1 " + unit)
        moved = {
            "day": F.date_add("_end", k),
            "week": F.date_add("_end", k * 7),
            "month": F.add_months("_end", k),
            "quarter": F.add_months("_end", k * 3),
            "year": F.add_months("_end", k * 12),
        }[base]
    else:
        ends = likely_step(panel, ids, date)
        gap = F.col("_gap")
        months = (
            F.when(gap.between(28, 31), 1).when(gap.between(89, 92), 3).when(gap.between(365, 366), 12)
        )
        moved = F.when(months.isNotNull(), F.add_months("_end", k * months)).otherwise(
            F.date_add("_end", k * gap)
        )
    steps = ends.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(length))))
    return steps.select(*ids, moved.alias(date), "h")


def with_future(
    panel: DataFrame, ids: Sequence[str], date: str, length: int, unit: str | None = None
) -> DataFrame:
    """A panel followed by its future rows, whose other columns are null."""
    return panel.unionByName(
        future_rows(panel, ids, date, length, unit).drop("h"), allowMissingColumns=True
    )
