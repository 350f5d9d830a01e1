"""The smallest complete forecast study, from raw orders to a forecast table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import baselines, forecasts, metrics, splits
from tidalframe.plans.inputs import MONTHLY, kept, monthly_panel
from tidalframe.plans.registry import query

HORIZON, WINDOW, SEASON = 6, 6, 12


def holdout_predictions(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The monthly panel and both baselines' predictions of its last months."""
    panel = kept(monthly_panel(spark, root))
    split = splits.time_split(panel, "date", HORIZON)
    train = splits.training(split)
    test = baselines.steps_ahead(splits.testing(split), ["id"], "date").withColumnRenamed("value", "actual")
    level = baselines.window_forecast(train, test, ["id"], "date", "value", WINDOW)
    season = baselines.seasonal_naive(train, test, ["id"], "date", "value", SEASON)
    cols = ["id", "date", "h", "actual", "prediction"]
    both = forecasts.stack_predictions(
        ("WINDOW MEDIAN", level.select(*cols)), ("SNAIVE", season.select(*cols))
    )
    return panel, kept(both)


HOLDOUT = f"""{MONTHLY},
cut AS (SELECT MIN(date) AS cut FROM (SELECT DISTINCT date FROM monthly ORDER BY date DESC LIMIT {HORIZON})),
train AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS back
          FROM monthly WHERE date < (SELECT cut FROM cut)),
test AS (SELECT id, date, CAST(row_number() OVER (PARTITION BY id ORDER BY date) AS INT) AS h, value AS actual
         FROM monthly WHERE date >= (SELECT cut FROM cut)),
level AS (SELECT id, quantile_cont(value, 0.5) AS prediction FROM train WHERE back <= {WINDOW} GROUP BY id),
season AS (SELECT id, {SEASON} - back AS slot, value AS prediction FROM train WHERE back <= {SEASON}),
pred AS (
  SELECT 1 AS model_id, 'WINDOW MEDIAN' AS model_desc, t.id, t.date, t.h, t.actual, l.prediction
  FROM test t JOIN level l ON t.id = l.id
  UNION ALL
  SELECT 2, 'SNAIVE', t.id, t.date, t.h, t.actual, s.prediction
  FROM test t LEFT JOIN season s ON t.id = s.id AND (t.h - 1) % {SEASON} = s.slot),
stepped AS (SELECT *, abs(actual - lag(actual) OVER (PARTITION BY model_id, id ORDER BY date)) AS step FROM pred)"""

METRICS_SQL = """count(*) AS n,
  round(avg(abs(actual - prediction)), 4) AS mae,
  round(100 * avg(abs((actual - prediction) / nullif(actual, 0))), 4) AS mape,
  round(avg(abs(actual - prediction)) / nullif(avg(step), 0), 4) AS mase,
  round(100 * avg(abs(prediction - actual) / nullif((abs(actual) + abs(prediction)) / 2, 0)), 4) AS smape,
  round(sqrt(avg((actual - prediction) * (actual - prediction))), 4) AS rmse,
  round(covar_pop(actual, prediction) * covar_pop(actual, prediction)
        / nullif(var_pop(actual) * var_pop(prediction), 0), 4) AS rsq"""

BY_SERIES = f"""{HOLDOUT},
acc AS (SELECT model_id, id, {METRICS_SQL} FROM stepped GROUP BY 1, 2),
best AS (SELECT model_id, id FROM acc QUALIFY rmse = min(rmse) OVER (PARTITION BY id))"""

REACH = """reach AS (
  SELECT model_id, id,
         1.959964 * sqrt(2 * sum((actual - prediction) * (actual - prediction)) / (2 * count(*) - 1)) AS reach
  FROM pred GROUP BY 1, 2)"""


@query(
    "flagship",
    f"""
WITH {BY_SERIES}, {REACH}
SELECT p.model_id, p.model_desc, 'prediction' AS key, p.id, p.date AS "index", round(p.prediction, 4) AS value,
       round(p.prediction - r.reach, 4) AS conf_lo, round(p.prediction + r.reach, 4) AS conf_hi
FROM pred p JOIN reach r ON p.model_id = r.model_id AND p.id = r.id
JOIN best b ON p.model_id = b.model_id AND p.id = b.id
UNION ALL
SELECT NULL, 'ACTUAL', 'actual', id, date, round(value, 4), NULL, NULL FROM monthly""",
)
def flagship(spark: SparkSession, root: str) -> DataFrame:
    panel, predictions = holdout_predictions(spark, root)
    calibrated = forecasts.calibrate(predictions)
    accuracy = metrics.accuracy_table(predictions, ["model_id", "id"], "date")
    best = forecasts.best_by_series(accuracy, "id", "rmse")
    table = forecasts.forecast_table(panel, predictions, calibrated, "id", "date", "value")
    actual = table.where(F.col("model_id").isNull())
    chosen = forecasts.keep_best(table.where(F.col("model_id").isNotNull()), best, "id")
    return chosen.unionByName(actual)
