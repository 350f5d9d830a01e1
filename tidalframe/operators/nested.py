"""One row per series: actual and future observations as arrays.

An array holds one struct per date of a panel, so its length is bounded by the
calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidalframe.operators.joins import by_group
from tidalframe.operators.calendar import future_rows


def nest(panel: DataFrame, id: str, date: str, value: str, length: int, unit: str = "day") -> DataFrame:
    """(id, actual, future): arrays of (date, value), future values null."""
    point = F.struct(F.col(date).alias("date"), F.col(value).alias("value"))
    actual = panel.groupBy(id).agg(F.sort_array(F.collect_list(point)).alias("actual"))
    ahead = future_rows(panel, [id], date, length, unit).select(
        id, F.struct(F.col(date).alias("date"), F.lit(None).cast("double").alias("value")).alias("_p")
    )
    future = ahead.groupBy(id).agg(F.sort_array(F.collect_list("_p")).alias("future"))
    return by_group(actual, future, [id], "left")


def split_last(nested: DataFrame, n: int) -> DataFrame:
    """Cut ``actual`` into ``train`` and ``test``, the test being its last n points.

    A series of at most n points has no training part and an error text.
    """
    size = F.size("actual")
    cut = F.greatest(size - n, F.lit(0))
    return nested.select(
        "*",
        F.slice("actual", F.lit(1), cut).alias("train"),
        F.slice("actual", cut + 1, F.greatest(size - cut, F.lit(0))).alias("test"),
        F.when(size <= n, F.lit("no training rows")).alias("error"),
    )


def unnest(nested: DataFrame, id: str, part: str) -> DataFrame:
    """One part as long rows (id, date, value)."""
    return nested.select(id, F.inline(part))


def error_report(nested: DataFrame, id: str) -> DataFrame:
    return nested.where(F.col("error").isNotNull()).select(id, F.size("actual").alias("n"), "error")


def length_tier(panel: DataFrame, id: str, long_test: int, short_test: int) -> DataFrame:
    """Add the test length each series can bear: the long one, else the short one."""
    sizes = panel.groupBy(id).agg(F.count(F.lit(1)).alias("_n"))
    tier = F.when(F.col("_n") > long_test, long_test).otherwise(short_test)
    return by_group(panel, sizes.select(id, tier.alias("test_length")), [id])


def split_by_tier(tiered: DataFrame, id: str, date: str) -> DataFrame:
    w = Window.partitionBy(id).orderBy(F.col(date).desc())
    held = F.row_number().over(w) <= F.col("test_length")
    return tiered.withColumn("role", F.when(held, "testing").otherwise("training"))


def per_series(df: DataFrame, ids: Sequence[str], fn, schema) -> DataFrame:
    """A table function per series of a panel (bounded by the calendar)."""
    return df.groupBy(*ids).applyInPandas(fn, schema)
