"""Gradient boosting with Tweedie loss, for targets with many zeros.

Each round fits one of Spark's regression trees to the negative gradient of the deviance
on the log scale and then sets every leaf anew: one aggregate gives, for all leaves, the
two sums whose quotient is the exact minimum of the deviance within the leaf. As the
deviance is convex along it, any share of that step lowers it, so the deviance falls in
every round. Rows stay in the executors; the driver sees two sums a leaf.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalframe.operators import models
from tidalframe.operators.models import Design
from tidalframe.session import cut_lineage, spread

# Largest step of a leaf (a leaf of zeros would have none), and rounds between written tables.
STEP, WRITTEN = 4.0, 10


def deviance(y: Column, margin: Column, power: float) -> Column:
    """Tweedie deviance of a row, 1 < power < 2, the prediction being exp(margin)."""
    zero = F.pow(y, F.lit(2 - power)) / ((1 - power) * (2 - power))
    return 2 * (zero - y * F.exp((1 - power) * margin) / (1 - power) + F.exp((2 - power) * margin) / (2 - power))


@dataclass
class Boosted:
    """Feature stages, the margin all rows start from, and per round a tree and what its leaves add."""

    features: PipelineModel
    power: float
    base: float
    rounds: list[tuple[DecisionTreeRegressionModel, dict[float, float]]] = field(default_factory=list)
    log: list[tuple[int, float, int]] = field(default_factory=list)

    def margins(self, df: DataFrame, out: str) -> DataFrame:
        ready = self.features.transform(df).withColumn(out, F.lit(self.base))
        for tree, leaves in self.rounds:
            ready = tree.transform(ready).withColumn(out, F.col(out) + added(leaves)).drop("_leaf", "_tree")
        return ready

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return self.margins(df, "_margin").select(*keep, F.exp("_margin").alias("prediction"))


def added(leaves: dict[float, float]) -> Column:
    pairs = [F.lit(x) for leaf in sorted(leaves) for x in (leaf, leaves[leaf])]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("_leaf")), F.lit(0.0))


def fit(
    design: Design,
    train: DataFrame,
    power: float = 1.5,
    trees: int = 50,
    learn_rate: float = 0.1,
    depth: int = 3,
    min_n: int = 1,
    fall: float = 1e-5,
    seed: int = 1,
) -> Boosted:
    """At most ``trees`` rounds; they end when one lowers the mean deviance by less than the share ``fall``.

    Rows without a target are left out; a negative target is an error. ``log`` has a row
    for the start and for each round: number, mean deviance, leaves.
    """
    if not 1 < power < 2 or not 0 < learn_rate <= 1:
        raise ValueError(f"power {power} must lie between 1 and 2, the learn rate {learn_rate} above 0 and up to 1")
    known = train.where(F.col(design.target).isNotNull())
    facts = known.agg(F.avg(design.target).alias("mean"), F.min(design.target).alias("least")).first()
    if facts["mean"] is None or facts["least"] < 0 or facts["mean"] <= 0:
        raise ValueError("Tweedie loss needs rows, targets of 0 or more, and one above 0")
    features = Pipeline(stages=models.stages(design)).fit(known)
    model = Boosted(features, power, math.log(facts["mean"]))
    y, margin = F.col("_y"), F.col("_margin")
    state = features.transform(known).select("features", F.col(design.target).cast("double").alias("_y"), F.lit(model.base).alias("_margin"))
    state = spread(cut_lineage(state))
    last = state.agg(F.avg(deviance(y, margin, power))).first()[0]
    model.log.append((0, last, 1))
    learner = DecisionTreeRegressor(
        labelCol="_pull", predictionCol="_tree", leafCol="_leaf", maxDepth=depth, minInstancesPerNode=min_n, seed=seed
    )
    for k in range(1, trees + 1):
        up, down = y * F.exp((1 - power) * margin), F.exp((2 - power) * margin)
        tree = learner.fit(state.withColumn("_pull", up - down))
        placed = tree.transform(state)
        sums = placed.groupBy("_leaf").agg(F.sum(up).alias("up"), F.sum(down).alias("down")).collect()  # at most 2^depth rows
        leaves = {r["_leaf"]: learn_rate * max(-STEP, min(STEP, math.log(r["up"] / r["down"]) if r["up"] > 0 else -STEP)) for r in sums}
        moved = placed.select("features", "_y", (margin + added(leaves)).alias("_margin"))
        moved = spread(cut_lineage(moved) if k % WRITTEN == 0 else moved)
        now = moved.agg(F.avg(deviance(y, margin, power))).first()[0]
        state.unpersist()
        state = moved
        model.rounds.append((tree, leaves))
        model.log.append((k, now, len(leaves)))
        if last - now < fall * last:
            break
        last = now
    state.unpersist()
    return model
