"""Boosted trees, one small model per series and spec, many series at a time.

Rows are dealt by series and sorted; a task reads them in runs of whole series, at most
``RUN_ROWS`` rows or one longer series, and grows the trees of as many series of a run side
by side as ``HELD`` cells of a histogram over (series, node, feature, bin) allow, one at
least. What a series gets depends
on its own rows alone, not on the run. A series that cannot be fitted is a row with an
error; it neither stops nor changes the others.

A fitted model is a row: a base value and an array of trees, nodes in heap order. Rows are
scored by Spark expressions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalframe.operators.joins import by_group

RUN_ROWS, HELD = 100_000, 500_000

TREE = T.StructType(
    [
        T.StructField("features", T.ArrayType(T.IntegerType())),
        T.StructField("cuts", T.ArrayType(T.DoubleType())),
        T.StructField("leaves", T.ArrayType(T.DoubleType())),
    ]
)


@dataclass(frozen=True)
class Spec:
    """Squared-error boosting: ``trees`` trees of ``depth`` levels, leaves shrunk by ``learn_rate``.

    ``min_n`` rows a leaf at least; ``ridge`` is added to the rows of a leaf; features of more
    than ``bins`` values in a series are cut at their quantiles.
    """

    trees: int = 15
    learn_rate: float = 0.35
    depth: int = 3
    min_n: int = 1
    ridge: float = 0.0
    bins: int = 64


def binned(series: np.ndarray, values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each row within its series, largest value of each bin as a table series x bin)."""
    order = np.lexsort((values, series))
    s, v = series[order], values[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    step = np.concatenate([[True], (s[1:] != s[:-1]) | (v[1:] != v[:-1])])
    place = np.cumsum(step) - 1
    place -= np.maximum.accumulate(np.where(first, place, 0))
    different = np.zeros(s[-1] + 1, np.int64)
    np.maximum.at(different, s, place + 1)
    held = different[s]
    bin_ = np.where(held > limit, place * limit // np.maximum(held, 1), place)
    tops = np.full((len(different), int(bin_.max()) + 1), -np.inf)
    np.maximum.at(tops, (s, bin_), v)
    out = np.empty(len(values), np.int64)
    out[order] = bin_
    return out, tops


def grow(series: np.ndarray, x: np.ndarray, y: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trees of all series at once.

    ``series`` numbers the series 0, 1, ... without gaps, sorted; ``x`` is rows x features.
    Gives base (series), features and cuts (series x trees x inner nodes), leaves (series x
    trees x leaves). A node that is not split sends all rows left (cut infinite).
    """
    n_series, n_features = int(series[-1]) + 1, x.shape[1]
    rows = np.bincount(series, minlength=n_series)
    base = np.bincount(series, y, n_series) / rows
    found = [binned(series, x[:, f], spec.bins) for f in range(n_features)]
    width = max(t.shape[1] for _, t in found)
    bins = np.stack([b for b, _ in found], 1)
    tops = np.full((n_series, n_features, width), np.inf)
    for f, (_, t) in enumerate(found):
        tops[:, f, : t.shape[1]] = t
    inner, leaves = 2**spec.depth - 1, 2**spec.depth
    features = np.zeros((n_series, spec.trees, inner), np.int32)
    cuts = np.full((n_series, spec.trees, inner), np.inf)
    values = np.zeros((n_series, spec.trees, leaves))
    left_over = y - base[series]
    column = np.arange(n_features) * width
    with np.errstate(invalid="ignore", divide="ignore"):
        for t in range(spec.trees):
            node = np.zeros(len(y), np.int64)
            for level in range(spec.depth):
                nodes = 2**level
                cell = ((series * nodes + node)[:, None] * (n_features * width) + column + bins).ravel()
                shape = (n_series, nodes, n_features, width)
                n = np.bincount(cell, minlength=n_series * nodes * n_features * width).reshape(shape).cumsum(-1)
                g = np.bincount(cell, np.repeat(left_over, n_features), n_series * nodes * n_features * width).reshape(shape).cumsum(-1)
                n_all, g_all = n[..., -1:], g[..., -1:]
                gain = g**2 / (n + spec.ridge) + (g_all - g) ** 2 / (n_all - n + spec.ridge) - g_all**2 / (n_all + spec.ridge)
                gain[~((n >= max(spec.min_n, 1)) & (n_all - n >= max(spec.min_n, 1)))] = -1.0
                flat = gain.reshape(n_series, nodes, -1)
                best = flat.argmax(-1)
                good = np.take_along_axis(flat, best[..., None], -1)[..., 0] > 1e-12 * np.maximum(1.0, g_all[..., 0, 0] ** 2)
                feature, bin_ = best // width, best % width
                bin_ = np.where(good, bin_, width)
                at = nodes - 1
                features[:, t, at : at + nodes] = feature
                reach = tops[np.arange(n_series)[:, None], feature, np.minimum(bin_, width - 1)]
                cuts[:, t, at : at + nodes] = np.where(good, reach, np.inf)
                own = feature[series, node]
                node = 2 * node + (bins[np.arange(len(y)), own] > bin_[series, node])
            leaf = series * leaves + node
            n = np.bincount(leaf, minlength=n_series * leaves)
            g = np.bincount(leaf, left_over, n_series * leaves)
            value = np.where(n > 0, spec.learn_rate * g / np.maximum(n + spec.ridge, 1e-300), 0.0)
            values[:, t] = value.reshape(n_series, leaves)
            left_over = left_over - value[leaf]
    return base, features, cuts, values


def runs(batches: Iterator[pa.RecordBatch], id: str) -> Iterator[pa.Table]:
    """The sorted rows again, in runs of whole series."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= RUN_ROWS:
            whole = pa.Table.from_batches(held)
            starts = series_starts(whole.column(id))
            if starts[-1] > 0:
                yield whole.slice(0, starts[-1])
            held = whole.slice(starts[-1]).combine_chunks().to_batches()
            size = whole.num_rows - int(starts[-1])
    if size:
        yield pa.Table.from_batches(held)


def series_starts(column: pa.ChunkedArray) -> np.ndarray:
    """Where a new id begins, null being an id."""
    codes = column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))


def pieces(rows: np.ndarray, n_features: int, spec: Spec) -> Iterator[tuple[int, int]]:
    """(first series, the one after the last) of parts of a run whose series have so many rows each."""
    cells = 2 ** max(spec.depth - 1, 0) * n_features
    first, width = 0, 0
    for k, n in enumerate(rows.tolist()):
        own = max(width, min(n, spec.bins))
        if k > first and (k + 1 - first) * cells * own > HELD:
            yield first, k
            first, own = k, min(n, spec.bins)
        width = own
    if len(rows):
        yield first, len(rows)


def fit(df: DataFrame, id: str, order: str, features: Sequence[str], target: str, specs: dict[str, Spec], least: int = 2) -> DataFrame:
    """(id, model_desc, n, base, trees, error): a model for each series and spec, or why there is none.

    Rows with a null or not finite feature or target are left out; a series with fewer
    than ``least`` rows left has an error. A null id is a series too.
    """
    features = list(features)
    schema = T.StructType(
        [
            df.schema[id],
            T.StructField("model_desc", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("base", T.DoubleType()),
            T.StructField("trees", T.ArrayType(TREE)),
            T.StructField("error", T.StringType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def models(ids: pa.ChunkedArray, series: np.ndarray, x: np.ndarray, y: np.ndarray, n_series: int, name: str, spec: Spec) -> pa.Table:
        """One row a series of this run; the series must be fit to fit, or the whole run fails."""
        usable = np.isfinite(x).all(1) & np.isfinite(y)
        n = np.bincount(series[usable], minlength=n_series)
        good = n >= least
        chosen = usable & good[series]
        base, trees = np.full(n_series, np.nan), [None] * n_series
        if chosen.any():
            number = np.cumsum(good) - 1
            fitted, feature, cut, leaves = grow(number[series[chosen]], x[chosen], y[chosen], spec)
            base[good] = fitted
            for k, s in enumerate(np.flatnonzero(good)):
                trees[s] = [{"features": feature[k, t], "cuts": cut[k, t], "leaves": leaves[k, t]} for t in range(spec.trees)]
        errors = [None if ok else f"{k} of {least} training rows" for ok, k in zip(good, n, strict=True)]
        return pa.table([ids, [name] * n_series, pa.array(n), pa.array(base, mask=~good), pa.array(trees, arrow.field("trees").type), pa.array(errors, pa.string())], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in runs(batches, id):
            starts = series_starts(whole.column(id))
            ids = whole.column(id).take(pa.array(starts)).cast(arrow.field(id).type)
            n_series = len(starts)
            series = np.repeat(np.arange(n_series), np.diff(np.append(starts, whole.num_rows)))
            x = np.stack([whole.column(f).to_numpy().astype(float) for f in features], 1)
            y = whole.column(target).to_numpy().astype(float)
            ends = np.append(starts, whole.num_rows)
            turns = [(name, spec, a, b) for name, spec in specs.items() for a, b in pieces(np.diff(ends), len(features), spec)]
            for name, spec, a, b in turns:
                part = slice(ends[a], ends[b])
                try:
                    yield from models(ids.slice(a, b - a), series[part] - a, x[part], y[part], b - a, name, spec).to_batches()
                except Exception:  # find the series that fails; the others keep their models
                    for k in range(a, b):
                        mine = slice(ends[k], ends[k + 1])
                        try:
                            yield from models(ids.slice(k, 1), np.zeros(ends[k + 1] - ends[k], int), x[mine], y[mine], 1, name, spec).to_batches()
                        except Exception as err:
                            yield from pa.table([ids.slice(k, 1), [name], [int(ends[k + 1] - ends[k])], pa.nulls(1, pa.float64()), pa.nulls(1, arrow.field("trees").type), [f"{type(err).__name__}: {err}"]], schema=arrow).to_batches()

    numbers = [F.col(c).cast("double").alias(c) for c in (*features, target)]
    dealt = df.select(id, F.col(order).alias("_order"), *numbers).repartition(id).sortWithinPartitions(id, "_order").drop("_order")
    return dealt.mapInArrow(run, schema)


def leaf(tree: Column, x: Column, depth: int) -> Column:
    """Value of the leaf that a row reaches."""
    down = lambda at, _: (2 * at + 1 + (x[tree["features"][at]] > tree["cuts"][at]).cast("int")).cast("int")
    end = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), down)
    return tree["leaves"][end - (2**depth - 1)]


def total(trees: str, x: Column, depth: int) -> Column:
    """Sum of the leaves that a row reaches in all trees."""
    return F.aggregate(trees, F.lit(0.0), lambda sum, tree: sum + leaf(tree, x, depth))


def predict(df: DataFrame, models: DataFrame, id: str, features: Sequence[str], specs: dict[str, Spec]) -> DataFrame:
    """Each row once for every spec, with model_desc, prediction and the error of its model.

    A series without a model keeps its rows: the prediction is null and the error says why.
    """
    names = F.explode(F.array(*[F.lit(n) for n in specs])).alias("model_desc")
    asked = df.select("*", names)
    fitted = by_group(asked, models.select(id, "model_desc", "base", "trees", "error"), [id, "model_desc"], "left")
    x = F.array(*[F.col(f).cast("double") for f in features])
    value = F.lit(None).cast("double")
    for name, spec in specs.items():
        value = F.when(F.col("model_desc") == name, F.col("base") + total("trees", F.col("_x"), spec.depth)).otherwise(value)
    complete = F.forall("_x", lambda v: v.isNotNull())
    scored = fitted.withColumn("_x", x).withColumn("prediction", F.when(F.col("base").isNotNull() & complete, value))
    error = F.coalesce("error", F.when(F.col("base").isNull(), F.lit("no training rows")), F.when(~complete, F.lit("a predictor is missing")))
    return scored.withColumn("error", error).drop("base", "trees", "_x")


def error_report(models: DataFrame, id: str) -> DataFrame:
    """(id, model_desc, n, error) of the models that could not be fitted."""
    return models.where(F.col("error").isNotNull()).select(id, "model_desc", "n", "error")
