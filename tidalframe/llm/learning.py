"""Labels and small numpy helpers that the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A document is held out from learning if the checksum of its id leaves 0 by this.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def known_labels(labels: DataFrame, column: str) -> DataFrame:
    """One label a document: label_id, label. Null labels and ids are left out, of several the smallest counts."""
    rows = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(column).cast("int").alias("label"))
    return rows.filter("label_id IS NOT NULL AND label IS NOT NULL").groupBy("label_id").agg(F.min("label").alias("label"))


def chosen(labels: DataFrame, column: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled ids that may be learnt from, in the order of a hash: label_id, label."""
    known = known_labels(labels, column).filter(~held_out(F.col("label_id")))
    return known.orderBy(F.xxhash64("label_id"), "label_id").limit(bound)


def sample(rows: DataFrame, labels: DataFrame, value: str) -> DataFrame:
    """doc_id, label and ``value`` (an array) of the ``chosen`` documents, one row each.

    The labels are as bounded as their choice, so they go to the rows; of several rows of
    one id the smallest value counts.
    """
    learnt = rows.join(F.broadcast(labels), F.col("doc_id") == F.col("label_id"))
    return learnt.groupBy("doc_id").agg(F.min(value).alias(value), F.min("label").alias("label"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def log_loss(y: np.ndarray, logit: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit)) if len(y) else 0.0


def temperature(y: np.ndarray, logit: np.ndarray) -> float:
    """The divisor of the logits that gives held-back labels the largest likelihood."""
    grid = np.geomspace(0.2, 20, 121)
    return float(min(grid, key=lambda t: log_loss(y, logit / t))) if len(y) else 1.0


class Adam:
    """Steps of a set of parameters by their gradients."""

    def __init__(self, parameters: list[np.ndarray], rate: float):
        self.p, self.rate, self.t = parameters, rate, 0
        self.m, self.v = ([np.zeros_like(p) for p in parameters] for _ in range(2))

    def step(self, gradients: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.p, gradients, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
