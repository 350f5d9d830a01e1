"""Reshaping: longer, wider, split, transpose, row-wise statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def longer(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], names_to: str = "name", values_to: str = "value"
) -> DataFrame:
    """Wide to long; null cells stay as rows."""
    return df.unpivot(list(ids), list(cols), names_to, values_to)


def wider(
    df: DataFrame,
    ids: Sequence[str],
    names_from: str,
    values_from: str,
    names: Sequence,
    fill=None,
    prefix: str = "",
) -> DataFrame:
    """Long to wide over known names: one aggregate per name in a single pass.

    ``fill`` goes only into cells that have no source row. A cell whose source
    row holds null stays null. A name that is not in the list is an error, as its
    values would have no column; rows with a null name only keep their ids.
    """
    stray = F.concat(F.lit(f"{names_from} holds a name without a column: "), F.col(names_from).cast("string"))
    listed = F.col(names_from).isNull() | F.col(names_from).isin(*names)
    df = df.where(F.when(listed, F.lit(True)).otherwise(F.raise_error(stray).cast("boolean")))
    cells = []
    for name in names:
        here = F.col(names_from) == F.lit(name)
        value = F.max(F.when(here, F.col(values_from)))
        if fill is not None:
            present = F.max(F.when(here, F.lit(1)))
            value = F.when(present.isNull(), F.lit(fill)).otherwise(value)
        cells.append(value.alias(f"{prefix}{name}"))
    return df.groupBy(*ids).agg(*cells)


def separate(df: DataFrame, col: str, into: Sequence[str], sep: str) -> DataFrame:
    """Split a text column into named columns; missing pieces are null."""
    parts = F.split(F.col(col), sep)
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(into)])


def row_stats(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    """Mean, median, sample sd and null count across columns of each row."""
    cells = F.array(*[F.col(c).cast("double") for c in cols])
    kept = F.array_sort(F.filter(cells, lambda x: x.isNotNull()))
    n = F.size(kept)
    total = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x)
    mean = F.try_divide(total, n)
    squares = F.aggregate(
        kept, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)
    )
    low = F.try_element_at(kept, F.floor((n + 1) / 2).cast("int"))
    high = F.try_element_at(kept, (F.floor(n / 2) + 1).cast("int"))
    return df.select(
        "*",
        mean.alias(f"{prefix}_mean"),
        F.when(n > 0, (low + high) / 2).alias(f"{prefix}_median"),
        F.when(n > 1, F.sqrt(F.try_divide(squares, n - 1))).alias(f"{prefix}_stdev"),
        F.size(F.filter(cells, lambda x: x.isNull())).alias(f"{prefix}_missing"),
    )


def transpose(df: DataFrame, row: str, cols: Sequence[str], names: Sequence, into: str) -> DataFrame:
    """Columns become rows: ``cols`` are listed down, one column per row label."""
    long = longer(df, [row], cols, into, "_cell")
    return wider(long, [into], row, "_cell", names, prefix="v_")


def enframe(
    df: DataFrame, ids: Sequence[str], mapping: Column, name: str = "name", value: str = "value"
) -> DataFrame:
    """A map column becomes (name, value) rows."""
    return df.select(*ids, F.explode(mapping).alias(name, value))


def across(df: DataFrame, cols: Sequence[str], fn) -> DataFrame:
    """Apply one column function to many columns."""
    chosen = set(cols)
    return df.select(*[fn(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])
