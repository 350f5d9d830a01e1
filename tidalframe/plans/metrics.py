"""Forecast errors and classification metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import metrics
from tidalframe.plans.flagship import BY_SERIES, HOLDOUT, METRICS_SQL, holdout_predictions
from tidalframe.plans.inputs import labelled
from tidalframe.plans.registry import query
from tidalframe.sources.tables import table


@query("met_forecast", f"WITH {HOLDOUT} SELECT model_id, {METRICS_SQL} FROM stepped GROUP BY 1")
def met_forecast(spark: SparkSession, root: str) -> DataFrame:
    """Errors of each model over all series."""
    _, predictions = holdout_predictions(spark, root)
    return metrics.accuracy_table(predictions, ["model_id"], "date", series=["id"])


@query("met_by_id", f"WITH {BY_SERIES} SELECT * FROM acc")
def met_by_id(spark: SparkSession, root: str) -> DataFrame:
    _, predictions = holdout_predictions(spark, root)
    return metrics.accuracy_table(predictions, ["model_id", "id"], "date")


@query("met_by_level", f"WITH {BY_SERIES} SELECT model_id, median(rmse) AS median_rmse, count(*) AS n FROM acc GROUP BY 1")
def met_by_level(spark: SparkSession, root: str) -> DataFrame:
    """Median of the series' errors, one row per model and series being few."""
    _, predictions = holdout_predictions(spark, root)
    accuracy = metrics.accuracy_table(predictions, ["model_id", "id"], "date")
    return accuracy.groupBy("model_id").agg(
        F.percentile("rmse", F.lit(0.5)).alias("median_rmse"), F.count(F.lit(1)).alias("n")
    )


PRICED = """priced AS (SELECT l_orderkey, l_extendedprice AS actual, l_quantity * 1500.0 * (1 - l_discount) + 300 AS prediction FROM lineitem)"""


def priced(spark: SparkSession, root: str) -> DataFrame:
    """A fixed pricing rule beside the true price of every line."""
    rule = F.col("l_quantity") * 1500.0 * (1 - F.col("l_discount")) + 300
    return table(spark, root, "lineitem").select(F.col("l_extendedprice").alias("actual"), rule.alias("prediction"))


@query("met_mae", f"WITH {PRICED} SELECT round(avg(abs(actual - prediction)), 4) AS mae FROM priced")
def met_mae(spark: SparkSession, root: str) -> DataFrame:
    return priced(spark, root).agg(F.round(metrics.mae("actual", "prediction"), 4).alias("mae"))


@query(
    "met_rmse_rsq",
    f"""WITH {PRICED} SELECT round(sqrt(avg((actual - prediction) * (actual - prediction))), 4) AS rmse,
        round(corr(actual, prediction) * corr(actual, prediction), 6) AS rsq FROM priced""",
)
def met_rmse_rsq(spark: SparkSession, root: str) -> DataFrame:
    return priced(spark, root).agg(
        F.round(metrics.rmse("actual", "prediction"), 4).alias("rmse"),
        F.round(metrics.rsq("actual", "prediction"), 6).alias("rsq"),
    )


SCORES = """scores AS (SELECT o_orderstatus AS truth, round(o_totalprice / 500000, 3) AS score FROM orders)"""


def scores(spark: SparkSession, root: str) -> DataFrame:
    """A score with many ties for three classes."""
    return table(spark, root, "orders").select(
        F.col("o_orderstatus").alias("truth"), F.round(F.col("o_totalprice") / 500000, 3).alias("score")
    )


def _auc_sql(event: str) -> str:
    return f"""SELECT '{event}' AS event, (sum(CASE WHEN truth = '{event}' THEN r END) - n1 * (n1 + 1) / 2.0) / (n1 * n0) AS auc
  FROM (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r,
        count(*) FILTER (truth = '{event}') OVER () AS n1, count(*) FILTER (truth <> '{event}') OVER () AS n0 FROM scores) GROUP BY n1, n0"""


@query(
    "met_auc",
    f"WITH {SCORES}, a AS ({_auc_sql('F')} UNION ALL {_auc_sql('P')}) SELECT event, round(auc, 9) AS auc FROM a",
)
def met_auc(spark: SparkSession, root: str) -> DataFrame:
    """Area under the curve with either class as the event."""
    rows = scores(spark, root)
    parts = [
        metrics.roc_auc(rows, "truth", "score", event).select(F.lit(event).alias("event"), F.round("auc", 9).alias("auc"))
        for event in ("F", "P")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "met_roc_curve",
    f"""WITH {SCORES}, c AS (SELECT score, count(*) FILTER (truth = 'F') AS pos, count(*) FILTER (truth <> 'F') AS neg FROM scores GROUP BY 1)
SELECT score AS threshold, CAST(sum(pos) OVER w AS DOUBLE) / sum(pos) OVER () AS sensitivity,
  1 - CAST(sum(neg) OVER w AS DOUBLE) / sum(neg) OVER () AS specificity FROM c WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""",
)
def met_roc_curve(spark: SparkSession, root: str) -> DataFrame:
    return metrics.roc_curve(scores(spark, root), "truth", "score", "F")


JUDGED = """judged AS (SELECT quality AS truth, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS estimate
  FROM documents JOIN labels USING (doc_id))"""


def judged(spark: SparkSession, root: str) -> DataFrame:
    """A one-rule classifier of document quality."""
    return labelled(spark, root).select(
        F.col("quality").alias("truth"), F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("estimate")
    )


@query(
    "met_conf_mat",
    f"WITH {JUDGED} SELECT truth, count(*) FILTER (estimate = 0) AS est_0, count(*) FILTER (estimate = 1) AS est_1 FROM judged GROUP BY 1",
)
def met_conf_mat(spark: SparkSession, root: str) -> DataFrame:
    return metrics.confusion(judged(spark, root), "truth", "estimate", [0, 1])


@query("met_accuracy", f"WITH {JUDGED} SELECT avg(CASE WHEN truth = estimate THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM judged")
def met_accuracy(spark: SparkSession, root: str) -> DataFrame:
    return judged(spark, root).agg(metrics.accuracy("truth", "estimate").alias("accuracy"), F.count(F.lit(1)).alias("n"))
