"""One boosted model per series and spec: fits, errors, choice, forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions import dates
from tidalframe.operators import calendar, forecasts, metrics, seriestrees, splits, temporal
from tidalframe.operators.baselines import steps_ahead
from tidalframe.operators.joins import by_group
from tidalframe.operators.seriestrees import Spec
from tidalframe.plans.calendar import CUSTOMER_DAYS, customer_days
from tidalframe.plans.inputs import kept, nation_monthly
from tidalframe.plans.registry import query
from tidalframe.session import cut_lineage

NATION_MONTHS = """panel AS (SELECT n_name AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


@query(
    "nst_boost_split",
    f"""WITH {NATION_MONTHS}, r AS (SELECT id, month(date) AS m, value - avg(value) OVER (PARTITION BY id) AS e, avg(value) OVER (PARTITION BY id) AS mean FROM panel),
cuts AS (SELECT DISTINCT id, m AS cut FROM r),
sides AS (SELECT id, cut, any_value(mean) AS mean, sum(e) FILTER (m <= cut) AS gl, count(*) FILTER (m <= cut) AS nl, sum(e) FILTER (m > cut) AS gr, count(*) FILTER (m > cut) AS nr
  FROM r JOIN cuts USING (id) GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY gl * gl / nl + gr * gr / nr DESC, cut) AS place FROM sides WHERE nr > 0)
SELECT id, nl + nr AS n, cut::DOUBLE AS cut, round(mean + gl / nl, 2) AS low, round(mean + gr / nr, 2) AS high FROM best WHERE place = 1""",
)
def nst_boost_split(spark: SparkSession, root: str) -> DataFrame:
    """One tree with one split for every nation: the month that parts its year best, and both means."""
    rows = nation_monthly(spark, root).withColumn("month", F.month("date"))
    fitted = seriestrees.fit(rows, "id", "date", ["month"], "value", {"split": Spec(trees=1, learn_rate=1.0, depth=1)})
    tree = F.col("trees")[0]
    side = lambda k: F.round(F.col("base") + tree["leaves"][k], 2)
    return fitted.select("id", "n", tree["cuts"][0].alias("cut"), side(0).alias("low"), side(1).alias("high"))


SIGNATURE = ("index_num", "year", "half", "quarter", "month", "mday", "wday", "yday", "week", "mday7")
BOOSTED = {"boosted 0.35": Spec(learn_rate=0.35), "boosted 0.50": Spec(learn_rate=0.5)}
LEAST, HELD = 4, 5


def signed(df: DataFrame) -> DataFrame:
    return df.withColumns({k: v.cast("double") for k, v in dates.signature("date").items() if k in SIGNATURE})


def customer_split(spark: SparkSession, root: str) -> DataFrame:
    return cut_lineage(splits.series_tail_split(kept(customer_days(spark, root)), ["id"], "date", HELD))


@query("nst_boost")
def nst_boost(spark: SparkSession, root: str) -> DataFrame:
    """Two boosted models for every customer: error on the held-out days, or why there is no model."""
    rows = signed(customer_split(spark, root))
    fitted = cut_lineage(seriestrees.fit(splits.training(rows), "id", "date", SIGNATURE, "value", BOOSTED, LEAST))
    tested = seriestrees.predict(splits.testing(rows), fitted, "id", SIGNATURE, BOOSTED)
    return tested.groupBy("id", "model_desc").agg(
        F.count(F.lit(1)).alias("n"), metrics.rmse("value", "prediction").alias("rmse"), F.max("error").alias("error")
    )


@query(
    "nst_boost_errors",
    f"""WITH {CUSTOMER_DAYS}, cut AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS back FROM log),
short AS (SELECT id, count(*) AS n FROM cut WHERE back > {HELD} GROUP BY 1 HAVING count(*) < {LEAST})
SELECT id, model_desc, n, n || ' of {LEAST} training rows' AS error FROM short, (VALUES ('boosted 0.35'), ('boosted 0.50')) m(model_desc)""",
)
def nst_boost_errors(spark: SparkSession, root: str) -> DataFrame:
    """Customers whose days before the held-out ones are too few to fit, once for each spec."""
    train = signed(splits.training(customer_split(spark, root)))
    return seriestrees.error_report(seriestrees.fit(train, "id", "date", SIGNATURE, "value", BOOSTED, LEAST), "id")


def nested_models(train: DataFrame, future: DataFrame) -> DataFrame:
    """Two boosted models and a temporal hierarchy for every series, predictions stacked, errors kept."""
    fitted = cut_lineage(seriestrees.fit(signed(train), "id", "date", SIGNATURE, "value", BOOSTED, LEAST))
    ahead = seriestrees.predict(signed(future), fitted, "id", SIGNATURE, BOOSTED)
    number = F.when(F.col("model_desc") == "boosted 0.35", 1).otherwise(2)
    boosted = ahead.select(number.alias("model_id"), "model_desc", "id", "date", "prediction", "error")
    nodes = temporal.node_forecasts(train, ["id"], "date", "value", 12, 3)
    tier = by_group(future, temporal.reconcile(nodes, ["id"], 12), ["id", "h"], "left")
    missing = F.when(F.col("prediction").isNull(), F.lit("no full season"))
    return boosted.unionByName(
        tier.select(F.lit(3).alias("model_id"), F.lit("hierarchy").alias("model_desc"), "id", "date", "prediction", missing.alias("error"))
    )


@query("nst_boost_best")
def nst_boost_best(spark: SparkSession, root: str) -> DataFrame:
    """Nested study: fit on all but the last six months, best model per nation, refit, six months ahead."""
    panel = kept(nation_monthly(spark, root))
    split = splits.series_tail_split(panel, ["id"], "date", 6)
    test = steps_ahead(splits.testing(split), ["id"], "date")
    truth = test.select("id", "date", F.col("value").alias("actual"))
    tested = cut_lineage(by_group(nested_models(splits.training(split), test.select("id", "date", "h")), truth, ["id", "date"]))
    best = forecasts.best_by_series(metrics.accuracy_table(tested, ["model_id", "id"], "date"), "id", "rmse")
    future = calendar.future_rows(panel, ["id"], "date", 6, "month")
    table_ = forecasts.forecast_table(panel, nested_models(panel, future), forecasts.calibrate(tested), "id", "date", "value", level=0.99)
    chosen = forecasts.keep_best(table_.where(F.col("model_id").isNotNull()), best, "id")
    return chosen.unionByName(table_.where(F.col("model_id").isNull()))
