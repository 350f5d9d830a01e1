"""Customer value: recency, frequency, money, cohorts and expected spend.

Money has two decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalframe.functions.dates import days_between
from tidalframe.functions.exact import decimal, exact_mean, exact_sum
from tidalframe.operators.joins import by_group


def spend_features(log: DataFrame, id: str, date: str, money: str, cutoff: Column) -> DataFrame:
    """Recency (≤ 0), frequency, total and mean spend per customer."""
    return log.groupBy(id).agg(
        F.max(date).alias("_last"),
        F.count(F.lit(1)).alias("frequency"),
        exact_sum(money).alias("price_sum"),
        exact_mean(money).alias("price_mean"),
    ).select(
        id,
        days_between(F.col("_last"), cutoff).alias("recency"),
        "frequency",
        "price_sum",
        "price_mean",
    )


def spend_targets(log: DataFrame, id: str, money: str) -> DataFrame:
    return log.groupBy(id).agg(exact_sum(money).alias("spend_90_total"), F.lit(1).alias("spend_90_flag"))


def features_with_targets(
    before: DataFrame, after: DataFrame, id: str, date: str, money: str, cutoff: Column | None = None
) -> DataFrame:
    """Features up to the cutoff and what the customer spent afterwards."""
    if cutoff is None:
        cutoff = before.agg(F.max(date)).scalar()
    features = spend_features(before, id, date, money, cutoff)
    return by_group(features, spend_targets(after, id, money), [id], "left").fillna(
        {"spend_90_total": 0.0, "spend_90_flag": 0}
    )


def first_purchases(log: DataFrame, id: str, date: str) -> DataFrame:
    return log.groupBy(id).agg(F.min(date).alias(date))


def cohort(log: DataFrame, id: str, date: str, start, end) -> DataFrame:
    """All rows of customers whose first purchase lies between two dates."""
    ids = first_purchases(log, id, date).where(F.col(date).between(F.lit(start), F.lit(end)))
    return by_group(log, ids.select(id), [id], "left_semi")


def transaction_summary(log: DataFrame, id: str, date: str, money: str, split) -> DataFrame:
    """Repeat count x, last purchase time t_x, age and mean spend up to a split date.

    Purchases of one customer on one day count once.
    """
    daily = (
        log.where(F.col(date) <= F.lit(split))
        .groupBy(id, date)
        .agg(F.sum(decimal(money)).alias("_spend"))
    )
    total = F.sum("_spend").cast("double")
    return daily.groupBy(id).agg(
        (F.count(F.lit(1)) - 1).alias("x"),
        F.datediff(F.max(date), F.min(date)).alias("t_x"),
        F.datediff(F.lit(split), F.min(date)).alias("age"),
        F.count(F.lit(1)).alias("n_days"),
        (total / F.count(F.lit(1))).alias("mean_spend"),
    )


def expected_spend(n: Column, mean: Column, p: float, q: float, gamma: float) -> Column:
    """Gamma-gamma expectation of a customer's mean spend."""
    return F.lit(p) * (F.lit(gamma) + n * mean) / (F.lit(p) * n + F.lit(q) - F.lit(1.0))
