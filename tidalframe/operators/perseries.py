"""One small regression per series, fitted from sums of products.

The rows of a series are never brought together: each task adds up its share of
the products of the features, and the equations of a series are solved from
those few sums. A series may be of any length.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalframe.operators.joins import by_group


def trend_season(date: str, origin: str, season_days: float = 365.25, waves: int = 2) -> dict[str, Column]:
    """Intercept, trend and a few sine waves of the year and the week."""
    t = F.datediff(F.col(date), F.to_date(F.lit(origin)))
    cols: dict[str, Column] = {"one": F.lit(1.0), "trend": t / 1000.0}
    for i in range(1, waves + 1):
        angle = t * (2 * math.pi * i / season_days)
        cols[f"sin{i}"], cols[f"cos{i}"] = F.sin(angle), F.cos(angle)
    return cols


def gram_sums(df: DataFrame, id: str, features: Sequence[str], target: str) -> DataFrame:
    """Per series: sums of products of all features and of features with target, over complete rows.

    A series without any has n = 0.
    """
    cols = [*features, target]
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    return df.groupBy(id).agg(
        F.count(F.when(known, 1)).alias("n"),
        F.array(*[F.coalesce(F.sum(F.when(known, F.col(a) * F.col(b))), F.lit(0.0)) for a, b in pairs]).alias("sums"),
    )


def solve(
    grams: DataFrame, id: str, features: Sequence[str], penalties: dict[str, float]
) -> DataFrame:
    """(id, model_desc, coefficients, error) for each penalty; a failure is a row."""
    k = len(features)
    schema = T.StructType(
        [
            grams.schema[id],
            T.StructField("model_desc", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("coefficients", T.ArrayType(T.DoubleType())),
            T.StructField("error", T.StringType()),
        ]
    )

    upper = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]

    def batches(frames):
        import numpy as np
        import pandas as pd

        for pdf in frames:
            sums = np.array(pdf["sums"].tolist(), dtype=float).reshape(len(pdf), len(upper))
            full = np.zeros((len(pdf), k + 1, k + 1))
            for at, (i, j) in enumerate(upper):
                full[:, i, j] = full[:, j, i] = sums[:, at]
            x, y, n = full[:, :k, :k], full[:, :k, k], pdf["n"].to_numpy()
            for name, penalty in penalties.items():
                ridge = np.eye(k)
                ridge[0, 0] = 0.0
                left = x + penalty * n[:, None, None] * ridge
                solvable = (n > k) & (np.linalg.matrix_rank(left, hermitian=True) == k)
                beta = np.zeros((len(pdf), k))
                beta[solvable] = np.linalg.solve(left[solvable], y[solvable][:, :, None])[:, :, 0]
                errors = np.where(
                    solvable, None, [f"{v} training rows cannot fit {k} features" for v in n]
                )
                yield pd.DataFrame(
                    {
                        id: pdf[id],
                        "model_desc": name,
                        "n": n,
                        "coefficients": [list(b) if ok else None for b, ok in zip(beta, solvable)],
                        "error": errors,
                    }
                )

    return grams.mapInPandas(batches, schema)


def predict(df: DataFrame, models: DataFrame, id: str, features: Sequence[str]) -> DataFrame:
    """Each row once for every spec, with model_desc, prediction and the error of its model.

    A series without a model, and one with a null id, keeps its rows; where the fit failed
    the prediction is null and the error says why.
    """
    value = F.lit(0.0)
    for i, name in enumerate(features):
        value = value + F.col(name) * F.get("coefficients", F.lit(i))
    fitted = by_group(df, models.select(id, "model_desc", "coefficients", "error"), [id], "left")
    error = F.coalesce("error", F.when(F.col("model_desc").isNull(), F.lit("no training rows")))
    return fitted.withColumn("prediction", value).withColumn("error", error).drop("coefficients")
