"""Feature steps that are learnt on one table and applied to any other.

A step looks at a table once, by aggregates, and returns the function that
applies it. What it keeps is bounded by the number of columns and levels, never
by the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalframe.functions.names import free_name
from tidalframe.functions import selectors
from tidalframe.functions.selectors import Selector
from tidalframe.operators.ordered import exact_quantiles, row_index

Apply = Callable[[DataFrame], DataFrame]
Step = Callable[[DataFrame], Apply]


@dataclass
class Roles:
    """Which column is predicted and which columns only identify a row."""

    target: str
    ids: tuple[str, ...] = ()

    def predictors(self) -> Selector:
        return lambda df: [c for c in df.columns if c != self.target and c not in self.ids]

    def numeric_predictors(self) -> Selector:
        return lambda df: [c for c in selectors.numeric()(df) if c in self.predictors()(df)]

    def nominal_predictors(self) -> Selector:
        return lambda df: [c for c in selectors.nominal()(df) if c in self.predictors()(df)]


@dataclass
class Steps:
    """An ordered list of feature steps."""

    steps: list[Step] = field(default_factory=list)

    def fit(self, train: DataFrame) -> Apply:
        learnt: list[Apply] = []
        for step in self.steps:
            apply = step(train)
            train = apply(train)
            learnt.append(apply)

        def run(df: DataFrame) -> DataFrame:
            for apply in learnt:
                df = apply(df)
            return df

        return run


def remove(*unwanted: str | Selector) -> Step:
    def learn(train: DataFrame) -> Apply:
        gone = selectors.names(train, *unwanted)
        return lambda df: df.drop(*gone)

    return learn


def zero_variance(cols: Selector) -> Step:
    """Drop columns holding one value: smallest equals largest, in one pass."""

    def learn(train: DataFrame) -> Apply:
        checked = cols(train)
        row = train.agg(
            *[F.min(c).eqNullSafe(F.max(c)).alias(c) for c in checked]
        ).first()
        gone = [c for c in checked if row[c]]
        return lambda df: df.drop(*gone)

    return learn


def _scaled(cols: Selector, centre: bool, scale: bool) -> Step:
    def learn(train: DataFrame) -> Apply:
        chosen = cols(train)
        row = train.agg(
            *[F.avg(c).alias(f"m_{c}") for c in chosen], *[F.stddev_samp(c).alias(f"s_{c}") for c in chosen]
        ).first()

        def one(c: str) -> Column:
            out = F.col(c)
            if centre and row[f"m_{c}"] is not None:
                out = out - F.lit(row[f"m_{c}"])
            if scale and row[f"s_{c}"]:
                out = out / F.lit(row[f"s_{c}"])
            return out.alias(c)

        return lambda df: df.select(*[one(c) if c in chosen else F.col(c) for c in df.columns])

    return learn


def normalize(cols: Selector) -> Step:
    return _scaled(cols, True, True)


def center(cols: Selector) -> Step:
    return _scaled(cols, True, False)


def scale(cols: Selector) -> Step:
    return _scaled(cols, False, True)


def mutate(**columns: Column | Callable[[], Column]) -> Step:
    return lambda train: lambda df: df.withColumns(columns)


def log(col: str) -> Step:
    return mutate(**{col: F.log(F.col(col))})


def as_text(*cols: str) -> Step:
    """Treat numbers as categories."""
    return mutate(**{c: F.col(c).cast("string") for c in cols})


def quantile_breaks(df: DataFrame, col: str, bins: int) -> list[float]:
    """The exact inner break points of equal-count bins, bounded by ``bins``."""
    probs = {f"b{i}": i / bins for i in range(1, bins)}
    row = exact_quantiles(df, [], col, probs).first()
    return [row[name] for name in probs]


def bin_number(col: str | Column, breaks: Sequence[float]) -> Column:
    """1 + how many breaks lie strictly below the value."""
    c = F.col(col) if isinstance(col, str) else col
    n = F.lit(1)
    for b in breaks:
        n = n + F.when(c > F.lit(b), 1).otherwise(0)
    return F.when(c.isNotNull(), n)


def discretize(col: str, bins: int) -> Step:
    """Replace a number by its quantile bin, as a category."""

    def learn(train: DataFrame) -> Apply:
        breaks = quantile_breaks(train, col, bins)
        name = F.concat(F.lit("bin"), bin_number(col, breaks).cast("string"))
        return lambda df: df.withColumn(col, name)

    return learn


def levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted distinct values of category columns that are to become columns, one column each."""
    return {c: sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().collect()) for c in cols}


def dummies(cols: Selector, one_hot: bool = False) -> Step:
    """0/1 columns per level in alphabetical order, the first left out unless one-hot.

    Meant for columns of few levels, each of which the plan names; categories of any
    number of levels go through the hashed slots of ``models.Design``.
    """

    def learn(train: DataFrame) -> Apply:
        chosen = cols(train)
        known = levels(train, chosen)
        flags, names = [], []
        for c in chosen:
            for level in known[c] if one_hot else known[c][1:]:
                name = "".join(ch if ch.isalnum() else "_" for ch in str(level))
                flag = F.when(F.col(c).isNotNull(), (F.col(c) == F.lit(level)).cast("int"))
                taken = free_name(f"{c}_{name}", [*(x for x in train.columns if x not in chosen), *names])
                names.append(taken)
                flags.append(flag.alias(taken))

        return lambda df: df.select(*[c for c in df.columns if c not in chosen], *flags)

    return learn


def complete_columns() -> Step:
    """Keep only columns without a null."""

    def learn(train: DataFrame) -> Apply:
        row = train.agg(
            *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in train.columns]
        ).first()
        kept = [c for c in train.columns if row[c] == 0]
        return lambda df: df.select(*kept)

    return learn


def impute_mean(cols: Selector) -> Step:
    def learn(train: DataFrame) -> Apply:
        chosen = cols(train)
        row = train.agg(*[F.avg(c).alias(c) for c in chosen]).first()
        means = {c: row[c] for c in chosen if row[c] is not None}
        return lambda df: df.fillna(means)

    return learn


def recode(col: str | Column, mapping: dict) -> Column:
    """New labels for old ones; a value without a new label stays."""
    c = F.col(col) if isinstance(col, str) else col
    out = c
    for old, new in mapping.items():
        out = F.when(c == F.lit(old), F.lit(new)).otherwise(out)
    return out


def level_code(df: DataFrame, col: str, out: str) -> DataFrame:
    """1-based position of a value among its column's sorted distinct values."""
    known = row_index(df.select(col).where(F.col(col).isNotNull()).distinct(), col, out)
    return df.join(known.withColumn(out, F.col(out).cast("int")), col, "left")
