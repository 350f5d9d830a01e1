"""Joins and row binding.

These joins carry no broadcast hint. Spark broadcasts a side when its file size or
its measured shuffle size is below ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles both sides, splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_group(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null being equal to null; the keys come from the left."""
    named = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return left.join(named, same, how).drop(*[f"_k_{k}" for k in keys])


def left_join_by(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on keys of different names; the left key is kept."""
    return left.join(right.withColumnRenamed(right_key, left_key), left_key, "left")


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    keys = [c for c in left.columns if c in right.columns]
    if not keys:
        raise ValueError("the tables share no column")
    return keys


def natural_left(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, shared_columns(left, right), "left")


def natural_right(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, shared_columns(left, right), "right")


def members(df: DataFrame, ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in a derived list."""
    return df.join(ids, key, "left_semi")


def non_members(df: DataFrame, ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in a derived list; a null key is not in it."""
    return df.join(ids, key, "left_anti")


def bind_rows(*tables: DataFrame) -> DataFrame:
    """Append by name; a column absent from one table is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def bind_columns(left: DataFrame, right: DataFrame, row: str) -> DataFrame:
    """Side by side by an explicit row id: Spark rows have no position."""
    return left.join(right, row, "inner")


def pairings(df: DataFrame, **options: Sequence[str]) -> DataFrame:
    """Every row with every combination of short literal option lists."""
    for name, values in options.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def null_safe_in(col: Column, values: Sequence) -> Column:
    """Membership that is never null, also for a null operand."""
    return F.coalesce(col.isin(*[v for v in values if v is not None]), F.lit(False)) | (
        col.isNull() if None in values else F.lit(False)
    )
