"""Sums and means, if wanted independent of the order of addition.

Adding doubles gives a result whose last digits depend on which task finishes
first. A ``scale`` says how many decimals the values have, as money does; they
are then added as decimals and turned into a double once, at the end. Without a
scale the values are added as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decimal(x, scale: int | None = 2) -> Column:
    return _col(x) if scale is None else _col(x).cast(f"decimal(18,{scale})")


def total(x, scale: int | None = None, over: WindowSpec | None = None) -> Column:
    out = F.sum(decimal(x, scale))
    if over is not None:
        out = out.over(over)
    return out.cast("double")


def mean(x, scale: int | None = None, over: WindowSpec | None = None) -> Column:
    n = F.count(_col(x))
    if over is not None:
        n = n.over(over)
    return F.try_divide(total(x, scale, over), n.cast("double"))


def exact_sum(x, scale: int = 2, over: WindowSpec | None = None) -> Column:
    """Sum of values of two decimals."""
    return total(x, scale, over)


def exact_mean(x, scale: int = 2, over: WindowSpec | None = None) -> Column:
    """Mean of values of two decimals."""
    return mean(x, scale, over)
