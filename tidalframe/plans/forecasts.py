"""Baselines, model tables, forecast tables, ensembles, recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import baselines, calendar, forecasts, metrics, recursive, temporal
from tidalframe.plans.flagship import BY_SERIES, HOLDOUT, REACH, holdout_predictions
from tidalframe.plans.inputs import MONTHLY, kept, monthly_panel, nation_monthly
from tidalframe.plans.registry import query

BACK = f"""{MONTHLY}, back AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS r FROM monthly),
ends AS (SELECT id, max(date) AS last_date FROM monthly GROUP BY 1),
ahead AS (SELECT id, CAST(h AS INT) AS h, CAST(last_date + to_months(CAST(h AS INT)) AS DATE) AS date
  FROM ends, (SELECT unnest(range(1, 25)) AS h))"""


@query(
    "bas_window",
    f"""WITH {BACK}, level AS (SELECT id, round(quantile_cont(value, 0.5), 4) AS middle,
  round(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value), 5) AS mean FROM back WHERE r <= 10 GROUP BY 1)
SELECT a.id, a.date, a.h, 'median' AS stat, middle AS prediction FROM ahead a JOIN level USING (id)
UNION ALL SELECT a.id, a.date, a.h, 'mean', mean FROM ahead a JOIN level USING (id)""",
)
def bas_window(spark: SparkSession, root: str) -> DataFrame:
    """The last ten months' median and mean, held for two years."""
    panel = kept(monthly_panel(spark, root))
    future = calendar.future_rows(panel, ["id"], "date", 24, "month")
    out = []
    for stat, digits in (("median", 4), ("mean", 5)):
        part = baselines.window_forecast(panel, future, ["id"], "date", "value", 10, stat, scale=2)
        out.append(part.select("id", "date", "h", F.lit(stat).alias("stat"), F.round("prediction", digits).alias("prediction")))
    return out[0].unionByName(out[1])


@query(
    "bas_snaive",
    f"""WITH {BACK} SELECT a.id, a.date, a.h, b.value AS prediction FROM ahead a
        LEFT JOIN back b ON b.id = a.id AND b.r = 12 - (a.h - 1) % 12""",
)
def bas_snaive(spark: SparkSession, root: str) -> DataFrame:
    panel = kept(monthly_panel(spark, root))
    future = calendar.future_rows(panel, ["id"], "date", 24, "month")
    return baselines.seasonal_naive(panel, future, ["id"], "date", "value", 12).select("id", "date", "h", "prediction")


@query(
    "mtb_table",
    f"""WITH {HOLDOUT}, doubled AS (SELECT model_id, model_desc FROM pred UNION ALL SELECT model_id + 2, model_desc FROM pred)
        SELECT model_id, model_desc, count(*) AS n FROM doubled GROUP BY 1, 2""",
)
def mtb_table(spark: SparkSession, root: str) -> DataFrame:
    """Two model tables combined; the second one's models are renumbered."""
    _, predictions = holdout_predictions(spark, root)
    both = forecasts.combine(predictions, predictions, 2)
    counts = both.groupBy("model_id").agg(F.count(F.lit(1)).alias("n"))
    names = forecasts.model_table(spark, "WINDOW MEDIAN", "SNAIVE", "WINDOW MEDIAN", "SNAIVE")
    return names.join(counts, "model_id")


@query(
    "mtb_calibrate",
    f"WITH {HOLDOUT} SELECT model_id, id, date, actual, round(prediction, 4) AS prediction, round(actual - prediction, 4) AS residual FROM pred",
)
def mtb_calibrate(spark: SparkSession, root: str) -> DataFrame:
    _, predictions = holdout_predictions(spark, root)
    return forecasts.calibrate(predictions).select(
        "model_id", "id", "date", "actual", F.round("prediction", 4).alias("prediction"), F.round("residual", 4).alias("residual")
    )


@query(
    "mtb_forecast",
    f"""WITH {HOLDOUT}, reach AS (SELECT model_id, 2.575829 * sqrt(2 * sum((actual - prediction) * (actual - prediction)) / (2 * count(*) - 1)) AS reach
  FROM pred GROUP BY 1)
SELECT p.model_id, p.model_desc, 'prediction' AS key, p.id, p.date AS "index", round(p.prediction, 4) AS value,
  round(p.prediction - r.reach, 4) AS conf_lo, round(p.prediction + r.reach, 4) AS conf_hi FROM pred p JOIN reach r USING (model_id)
UNION ALL SELECT NULL, 'ACTUAL', 'actual', id, date, round(value, 4), NULL, NULL FROM monthly""",
)
def mtb_forecast(spark: SparkSession, root: str) -> DataFrame:
    """Forecast table with 99 % intervals over all series of a model."""
    panel, predictions = holdout_predictions(spark, root)
    return forecasts.forecast_table(
        panel, predictions, forecasts.calibrate(predictions), "id", "date", "value", by_id=False, level=0.99
    )


@query(
    "mtb_best",
    f"""WITH {BY_SERIES}, {REACH} SELECT b.model_id, b.id, p.date, round(p.prediction, 4) AS prediction
        FROM best b JOIN pred p ON p.model_id = b.model_id AND p.id = b.id""",
)
def mtb_best(spark: SparkSession, root: str) -> DataFrame:
    """Each series' forecast by the model that suits it best."""
    _, predictions = holdout_predictions(spark, root)
    accuracy = metrics.accuracy_table(predictions, ["model_id", "id"], "date")
    chosen = forecasts.keep_best(predictions, forecasts.best_by_series(accuracy, "id"), "id")
    return chosen.select("model_id", "id", "date", F.round("prediction", 4).alias("prediction"))


@query(
    "ens_average",
    f"WITH {HOLDOUT} SELECT id, date, round(sum(prediction) / count(prediction), 4) AS prediction FROM pred GROUP BY 1, 2",
)
def ens_average(spark: SparkSession, root: str) -> DataFrame:
    _, predictions = holdout_predictions(spark, root)
    return forecasts.average(predictions, ["id", "date"]).withColumn("prediction", F.round("prediction", 4))


@query(
    "ens_weighted",
    f"""WITH {HOLDOUT} SELECT id, date, round(sum(CASE model_id WHEN 1 THEN 2 ELSE 3 END * prediction) / 5, 3) AS prediction
        FROM pred GROUP BY 1, 2""",
)
def ens_weighted(spark: SparkSession, root: str) -> DataFrame:
    """Loadings 2 : 3."""
    _, predictions = holdout_predictions(spark, root)
    blended = forecasts.weighted(predictions, ["id", "date"], {1: 2, 2: 3})
    return blended.withColumn("prediction", F.round("prediction", 3))


WEIGHTS = {1: 0.4, 2: 0.2, 12: 0.3}


@query(
    "mod_recursive",
    f"""WITH RECURSIVE {MONTHLY}, last_year AS (SELECT id, list(value ORDER BY date) AS hist FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS r FROM monthly) WHERE r <= 12 GROUP BY 1),
steps(id, h, tail) AS (SELECT id, 0, hist FROM last_year UNION ALL
  SELECT id, h + 1, list_append(tail, 1000.0::DOUBLE + 0.4::DOUBLE * tail[len(tail)] + 0.2::DOUBLE * tail[len(tail) - 1] + 0.3::DOUBLE * tail[len(tail) - 11])
  FROM steps WHERE h < 24)
SELECT id, CAST(h AS INT) AS h, round(tail[len(tail)], 4) AS value, CAST(NULL AS VARCHAR) AS error FROM steps WHERE h > 0 AND (SELECT len(hist) FROM last_year WHERE last_year.id = steps.id) = 12
UNION ALL SELECT id, NULL, NULL, len(hist) || ' values, the longest lag is 12' FROM last_year WHERE len(hist) < 12""",
)
def mod_recursive(spark: SparkSession, root: str) -> DataFrame:
    """Two years ahead by a fixed linear model of three lags."""
    state = recursive.tail_state(monthly_panel(spark, root), "id", "date", "value", 12)
    out = recursive.linear_recursion(state, "id", 1000.0, WEIGHTS, 24)
    return out.withColumn("value", F.round("value", 4))


def _matrix_rows() -> str:
    """The reconciliation matrix as SQL rows (h, level, block, g)."""
    order = [(d, b) for d in temporal.divisors(12) for b in range(12 // d)]
    matrix = temporal.reconcile_matrix(12)
    return ", ".join(
        f"({h + 1}, {d}, {b}, {float(matrix[h, at])!r}::DOUBLE)"
        for h in range(12)
        for at, (d, b) in enumerate(order)
    )


@query(
    "mod_temporal_hier",
    f"""WITH panel AS (SELECT n_name AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC) - 1 AS back, count(*) OVER (PARTITION BY id) // 12 AS full_years FROM panel),
slots AS (SELECT id, back // 12 AS season, 11 - back % 12 AS slot, value FROM b WHERE back < least(full_years, 3) * 12),
levels(level) AS (VALUES (1), (2), (3), (4), (6), (12)),
per_node AS (SELECT id, level, slot // level AS block, season, sum(value) AS v FROM slots, levels GROUP BY 1, 2, 3, 4),
nodes AS (SELECT id, level, block, quantile_cont(v, 0.5) AS f FROM per_node GROUP BY 1, 2, 3),
g(h, level, block, g) AS (VALUES {_matrix_rows()})
SELECT id, CAST(h AS INT) AS h, round(sum(g * f), 3) AS prediction FROM nodes JOIN g USING (level, block) GROUP BY 1, 2""",
)
def mod_temporal_hier(spark: SparkSession, root: str) -> DataFrame:
    """Next year of every nation, reconciled over six period lengths."""
    nodes = temporal.node_forecasts(kept(nation_monthly(spark, root)), ["id"], "date", "value", 12, 3)
    return temporal.reconcile(nodes, ["id"], 12).withColumn("prediction", F.round("prediction", 3))
