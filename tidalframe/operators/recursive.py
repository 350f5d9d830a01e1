"""Recursive forecasts: each step's prediction becomes a lag of the next step.

The state is one row per series holding the array of its last values, newest
last. The array is as long as the largest lag, whatever the length of history.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalframe.operators.windows import panel_tail
from tidalframe.session import cut_lineage


def tail_state(panel: DataFrame, id: str, date: str, value: str, n: int) -> DataFrame:
    """(id, tail, last date): the last ``n`` values of each series, in date order."""
    tail = panel_tail(panel, [id], date, n)
    points = F.sort_array(F.collect_list(F.struct(F.col(date).alias("d"), F.col(value).alias("v"))))
    return tail.groupBy(id).agg(
        F.transform(points, lambda p: p["v"]).alias("tail"), F.max(date).alias("last_date")
    )


def linear_recursion(
    state: DataFrame, id: str, intercept: float, weights: dict[int, float], horizon: int
) -> DataFrame:
    """A linear model of lags, all steps in one expression; rows (id, h, value, error).

    A series shorter than the longest lag is one row with the error.
    """
    longest = max(weights)

    def step(acc: Column, _: Column) -> Column:
        value = F.lit(float(intercept))
        for lag, w in sorted(weights.items()):
            value = value + F.lit(float(w)) * F.element_at(acc, -lag)
        return F.concat(acc, F.array(value))

    start = F.slice("tail", -longest, longest)
    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)
    ahead = F.slice(grown, longest + 1, horizon)
    long = state.where(F.size("tail") >= longest).select(id, F.posexplode(ahead).alias("h", "value"))
    return long.select(id, (F.col("h") + 1).alias("h"), "value", F.lit(None).cast("string").alias("error")).unionByName(
        too_short(state, longest).select(id, F.lit(None).cast("int").alias("h"), F.lit(None).cast("double").alias("value"), "error")
    )


def too_short(state: DataFrame, longest: int) -> DataFrame:
    """Series whose history does not reach back to the longest lag, and why they have no forecast."""
    short = state.where(F.size("tail") < longest)
    return short.withColumn("error", F.concat(F.size("tail").cast("string"), F.lit(f" values, the longest lag is {longest}")))


def model_recursion(
    state: DataFrame,
    id: str,
    predict: Callable[[DataFrame], DataFrame],
    lags: Sequence[int],
    horizon: int,
    step_features: Callable[[Column], dict[str, Column]] | None = None,
    checkpoint_every: int = 6,
) -> DataFrame:
    """Any fitted model, one transform per step; rows (id, last_date, h, value, error).

    A series shorter than the longest lag is one row with the error.

    ``predict`` adds a ``prediction`` column from columns ``lag<k>`` and those
    of ``step_features(h)``. The growing plan is cut by reliable checkpoints.
    """
    longest = max(lags)
    now = state.where(F.size("tail") >= longest).withColumn(
        "_path", F.expr("cast(array() as array<double>)")
    )
    for h in range(1, horizon + 1):
        cols = {f"lag{k}": F.element_at("tail", -k) for k in lags}
        if step_features is not None:
            cols.update(step_features(F.lit(h)))
        scored = predict(now.withColumns(cols))
        now = scored.select(
            *[c for c in state.columns if c != "tail"],
            F.concat(F.slice("tail", -(longest - 1), longest - 1) if longest > 1 else F.expr("cast(array() as array<double>)"), F.array("prediction")).alias("tail"),
            F.concat("_path", F.array("prediction")).alias("_path"),
        )
        if h % checkpoint_every == 0 and h < horizon:
            now = cut_lineage(now)
    long = now.select(id, "last_date", F.posexplode("_path").alias("h", "value"))
    long = long.withColumn("h", F.col("h") + 1).withColumn("error", F.lit(None).cast("string"))
    return long.unionByName(too_short(state, longest).select(id, "last_date", "error"), allowMissingColumns=True)
