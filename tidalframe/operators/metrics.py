"""Error and classification metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidalframe.operators.ordered import edges, running_totals, with_bucket
from tidalframe.session import cut_lineage


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mae(t, e) -> Column:
    return F.avg(F.abs(_col(t) - _col(e)))


def mape(t, e) -> Column:
    return 100 * F.avg(F.abs(F.try_divide(_col(t) - _col(e), _col(t))))


def smape(t, e) -> Column:
    half = (F.abs(_col(t)) + F.abs(_col(e))) / 2
    return 100 * F.avg(F.try_divide(F.abs(_col(e) - _col(t)), half))


def rmse(t, e) -> Column:
    gap = _col(t) - _col(e)
    return F.sqrt(F.avg(gap * gap))


def rsq(t, e) -> Column:
    """Squared correlation; null when one side does not vary."""
    both = F.covar_pop(_col(t), _col(e))
    return F.try_divide(both * both, F.var_pop(_col(t)) * F.var_pop(_col(e)))


def accuracy_table(
    df: DataFrame,
    by: Sequence[str],
    date: str,
    truth: str = "actual",
    estimate: str = "prediction",
    series: Sequence[str] = (),
    digits: int = 4,
) -> DataFrame:
    """mae, mape, mase, smape, rmse and rsq per group.

    The mase denominator is the mean step between neighbours of the evaluated
    truth in date order, within a group (and a series, when series are named).
    """
    w = Window.partitionBy(*by, *[s for s in series if s not in by]).orderBy(date)
    stepped = df.withColumn("_step", F.abs(F.col(truth) - F.lag(truth).over(w)))
    out = stepped.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        mae(truth, estimate).alias("mae"),
        mape(truth, estimate).alias("mape"),
        F.try_divide(mae(truth, estimate), F.avg("_step")).alias("mase"),
        smape(truth, estimate).alias("smape"),
        rmse(truth, estimate).alias("rmse"),
        rsq(truth, estimate).alias("rsq"),
    )
    return out.select(
        *by, "n", *[F.round(c, digits).alias(c) for c in ("mae", "mape", "mase", "smape", "rmse", "rsq")]
    )


def scored_counts(
    df: DataFrame, truth: str, score: str, event, by: Sequence[str] = ()
) -> DataFrame:
    """Events and non-events per distinct score, written down once and bucketed."""
    hit = F.when(F.col(truth) == F.lit(event), 1).otherwise(0)
    counts = cut_lineage(
        df.groupBy(*by, F.col(score).alias("score")).agg(
            F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")
        )
    )
    return with_bucket(counts, "score", edges(counts, "score"))


def roc_auc(df: DataFrame, truth: str, score: str, event=1, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counted half.

    For every distinct score: events there times non-events strictly below it
    plus half of those at it. ``event`` is the truth value that counts as hit.
    """
    placed = running_totals(scored_counts(df, truth, score, event, by), by, ["score"], ["neg", "pos"])
    wins = F.sum(F.col("pos") * (2 * F.col("before_neg") + F.col("neg")))
    pairs = 2.0 * F.max("total_pos") * F.max("total_neg")
    return placed.groupBy(*by).agg(F.try_divide(wins.cast("double"), pairs).alias("auc"))


def roc_curve(df: DataFrame, truth: str, score: str, event=1) -> DataFrame:
    """Sensitivity and specificity when scores at or above the threshold are hits."""
    placed = running_totals(
        scored_counts(df, truth, score, event), [], ["score"], ["pos", "neg"], descending=True
    )
    return placed.select(
        F.col("score").alias("threshold"),
        F.try_divide((F.col("before_pos") + F.col("pos")).cast("double"), F.col("total_pos")).alias("sensitivity"),
        (1 - F.try_divide((F.col("before_neg") + F.col("neg")).cast("double"), F.col("total_neg"))).alias("specificity"),
    )


def confusion(df: DataFrame, truth: str, estimate: str, levels: Sequence) -> DataFrame:
    """One row per truth level, one count column per estimated level."""
    return df.groupBy(truth).agg(
        *[F.count(F.when(F.col(estimate) == F.lit(v), 1)).alias(f"est_{v}") for v in levels]
    )


def accuracy(truth: str, estimate: str) -> Column:
    return F.avg(F.when(F.col(truth) == F.col(estimate), 1.0).otherwise(0.0))
