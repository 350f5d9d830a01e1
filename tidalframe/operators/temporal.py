"""Temporal hierarchies: forecasts of a series at every period length, reconciled.

A season of ``m`` periods is added up to blocks of every divisor of ``m``. Each
level is forecast on its own; structural weights make the levels agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidalframe.operators.joins import by_group


def divisors(m: int) -> list[int]:
    return [d for d in range(1, m + 1) if m % d == 0]


def summing_matrix(m: int) -> np.ndarray:
    """One row per node: which of the m base periods it adds up, finest level first."""
    rows = []
    for d in divisors(m):
        for block in range(m // d):
            row = np.zeros(m)
            row[block * d : (block + 1) * d] = 1.0
            rows.append(row)
    return np.array(rows)


def reconcile_matrix(m: int) -> np.ndarray:
    """From all node forecasts to coherent base periods, weights = block lengths."""
    s = summing_matrix(m)
    w = np.diag(1.0 / s.sum(axis=1))
    return np.linalg.solve(s.T @ w @ s, s.T @ w)


def node_forecasts(panel: DataFrame, ids: Sequence[str], date: str, value: str, m: int, seasons: int) -> DataFrame:
    """Per node of the next season: median of that node over the last full seasons.

    A series without ``seasons`` full seasons uses those it has.
    """
    ids = list(ids)
    back = Window.partitionBy(*ids).orderBy(F.col(date).desc())
    placed = panel.select(*ids, F.col(value).alias("_v"), (F.row_number().over(back) - 1).alias("_back"))
    sizes = placed.groupBy(*ids).agg(F.floor(F.count(F.lit(1)) / m).alias("_full"))
    recent = by_group(placed, sizes, ids).where(
        F.col("_back") < F.least(F.col("_full"), F.lit(seasons)) * m
    )
    slot = (m - 1) - F.pmod(F.col("_back"), F.lit(m))
    season = F.floor(F.col("_back") / m)
    nodes = F.array(
        *[F.struct(F.lit(d).alias("level"), F.floor(slot / d).cast("int").alias("block")) for d in divisors(m)]
    )
    per_node = (
        recent.select(*ids, season.alias("_season"), "_v", F.inline(nodes))
        .groupBy(*ids, "level", "block", "_season")
        .agg(F.sum("_v").alias("_v"))
    )
    return per_node.groupBy(*ids, "level", "block").agg(F.percentile("_v", F.lit(0.5)).alias("forecast"))


def reconcile(nodes: DataFrame, ids: Sequence[str], m: int) -> DataFrame:
    """Coherent base forecasts (ids, h, prediction) from node forecasts."""
    ids = list(ids)
    order = [(d, b) for d in divisors(m) for b in range(m // d)]
    wide = nodes.groupBy(*ids).agg(
        F.array(
            *[F.max(F.when((F.col("level") == d) & (F.col("block") == b), F.col("forecast"))) for d, b in order]
        ).alias("_nodes")
    )
    matrix = reconcile_matrix(m)
    fields = [wide.schema[c] for c in ids]
    schema = T.StructType([*fields, T.StructField("path", T.ArrayType(T.DoubleType()))])

    def apply(frames):
        for pdf in frames:
            stacked = np.array(pdf["_nodes"].tolist(), dtype=float).reshape(len(pdf), len(order))
            out = pdf[ids].copy()
            out["path"] = list(stacked @ matrix.T)
            yield out

    long = wide.mapInPandas(apply, schema).select(*ids, F.posexplode("path").alias("h", "prediction"))
    return long.withColumn("h", F.col("h") + 1)
