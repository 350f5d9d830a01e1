"""Model tables, hold-out residuals, forecast tables and ensembles.

Predictions of every model are one long table keyed by ``model_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions.quantiles import normal_quantile
from tidalframe.operators.joins import bind_rows, by_group

def model_table(spark: SparkSession, *descriptions: str) -> DataFrame:
    rows = [(i, d) for i, d in enumerate(descriptions, 1)]
    return spark.createDataFrame(rows, "model_id int, model_desc string")


def stack_predictions(*parts: tuple[str, DataFrame]) -> DataFrame:
    """Number several prediction tables 1.. and append them."""
    return bind_rows(
        *[
            df.select(F.lit(i).alias("model_id"), F.lit(desc).alias("model_desc"), "*")
            for i, (desc, df) in enumerate(parts, 1)
        ]
    )


def combine(first: DataFrame, second: DataFrame, offset: int) -> DataFrame:
    """Append a prediction table, its model ids moved up by ``offset``."""
    return first.unionByName(second.withColumn("model_id", F.col("model_id") + offset))


def calibrate(predictions: DataFrame, actual: str = "actual") -> DataFrame:
    return predictions.withColumn("residual", F.col(actual) - F.col("prediction"))


def interval_width(calibrated: DataFrame, by: Sequence[str], level: float) -> DataFrame:
    """z times the sd of residuals joined with their negatives."""
    n = F.count("residual")
    squares = F.sum(F.col("residual") * F.col("residual"))
    sd = F.sqrt(F.try_divide(2 * squares, 2 * n - 1))
    return calibrated.groupBy(*by).agg((F.lit(round(normal_quantile((1 + level) / 2), 6)) * sd).alias("_reach"))


def forecast_table(
    actual: DataFrame,
    predictions: DataFrame,
    calibrated: DataFrame,
    id: str,
    date: str,
    value: str,
    by_id: bool = True,
    level: float = 0.95,
    digits: int = 4,
) -> DataFrame:
    """Actual rows (no model) followed by prediction rows with an interval."""
    by = ["model_id", id] if by_id else ["model_id"]
    widths = interval_width(calibrated, by, level)
    ahead = by_group(predictions, widths, by, "left").select(
        "model_id",
        "model_desc",
        F.lit("prediction").alias("key"),
        id,
        F.col(date).alias("index"),
        F.round("prediction", digits).alias("value"),
        F.round(F.col("prediction") - F.col("_reach"), digits).alias("conf_lo"),
        F.round(F.col("prediction") + F.col("_reach"), digits).alias("conf_hi"),
    )
    seen = actual.select(
        F.lit("ACTUAL").alias("model_desc"),
        F.lit("actual").alias("key"),
        id,
        F.col(date).alias("index"),
        F.round(value, digits).alias("value"),
    )
    return ahead.unionByName(seen, allowMissingColumns=True)


def best_by_series(accuracy: DataFrame, id: str, metric: str = "rmse") -> DataFrame:
    """Models holding a series' smallest metric, ties kept; all of a series without any metric."""
    best = accuracy.groupBy(id).agg(F.min(metric).alias(metric))
    return by_group(accuracy, best, [id, metric], "left_semi")


def keep_best(forecast: DataFrame, best: DataFrame, id: str) -> DataFrame:
    """Forecast rows of each series' chosen model."""
    return by_group(best.select("model_id", id), forecast, ["model_id", id], "left")


def average(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    return predictions.groupBy(*keys).agg(F.avg("prediction").alias("prediction"))


def weighted(predictions: DataFrame, keys: Sequence[str], loadings: dict[int, float]) -> DataFrame:
    """Blend by loadings scaled to sum 1."""
    total = sum(loadings.values())
    weight = F.lit(0.0)
    for model, load in loadings.items():
        weight = F.when(F.col("model_id") == model, F.lit(load / total)).otherwise(weight)
    chosen = predictions.where(F.col("model_id").isin(*loadings))
    return chosen.groupBy(*keys).agg(F.sum(weight * F.col("prediction")).alias("prediction"))
