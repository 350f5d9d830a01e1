"""Model fits. Values depend on the solver, so tests check properties of them."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions import dates
from tidalframe.operators import (
    calendar,
    forecasts,
    metrics,
    models,
    perseries,
    recursive,
    shape,
    splits,
    temporal,
    windows,
)
from tidalframe.operators.joins import by_group
from tidalframe.operators.models import Design
from tidalframe.plans.aggregates import returns_wide
from tidalframe.plans.calendar import customer_days
from tidalframe.plans.customers import rfm_table
from tidalframe.plans.inputs import SYMBOLS, kept, labelled, nation_monthly, order_days
from tidalframe.plans.registry import query
from tidalframe.session import cut_lineage, scratch, spread
from tidalframe.sources.tables import table

RFM = ("recency", "frequency", "price_sum", "price_mean")
FLAG = Design("spend_90_flag", RFM, scaled=True)
SPEND = Design("spend_90_total", RFM)
LINES = Design("l_extendedprice", ("l_quantity", "l_discount", "l_tax"), ("l_returnflag", "l_linestatus"))
QUALITY = Design("quality", ("n_chars",), ("lang", "source"))


def line_items(spark: SparkSession, root: str) -> DataFrame:
    """All lines, a fifth of the orders held out."""
    lines = table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", *LINES.numeric, *LINES.nominal, "l_extendedprice"
    )
    held = F.pmod(F.xxhash64(F.lit(7), "l_orderkey"), F.lit(5)) == 0
    rows = lines.withColumn("role", F.when(held, splits.TEST).otherwise(splits.TRAIN))
    return spread(rows)


def judged_fit(model, rows: DataFrame, target: str) -> DataFrame:
    """Errors of a regression on both roles, beside those of the training mean."""
    mean = rows.where(F.col("role") == splits.TRAIN).agg(F.avg(target)).scalar()
    scored = models.predict(model, rows.withColumn("_mean", mean), ["role", target, "_mean"])
    return scored.groupBy("role").agg(
        F.count(F.lit(1)).alias("n"),
        metrics.rmse(target, "prediction").alias("rmse"),
        metrics.rsq(target, "prediction").alias("rsq"),
        metrics.rmse(target, "_mean").alias("rmse_of_mean"),
    )


@query("mod_workflow")
def mod_workflow(spark: SparkSession, root: str) -> DataFrame:
    """Features and model fitted together; class and probability for held-out customers."""
    rows = cut_lineage(splits.split_by_id(kept(rfm_table(spark, root)), "customer_id", 0.8))
    model = models.fit(FLAG, models.logistic(), splits.training(rows))
    return models.predict(model, splits.testing(rows), ["customer_id", "spend_90_flag"])


@query("mod_gbt")
def mod_gbt(spark: SparkSession, root: str) -> DataFrame:
    rows = line_items(spark, root)
    model = models.fit(LINES, models.boosted(trees=10, learn_rate=0.3), splits.training(rows), by_profile=True)
    return judged_fit(model, rows, "l_extendedprice")


@query("mod_gbt_class")
def mod_gbt_class(spark: SparkSession, root: str) -> DataFrame:
    """Boosted classification."""
    rows = cut_lineage(splits.split_by_id(kept(rfm_table(spark, root)), "customer_id", 0.8))
    learner = models.boosted("classification", trees=10, learn_rate=0.5, depth=3)
    model = models.fit(FLAG, learner, splits.training(rows))
    scored = models.predict(model, rows, ["role", "spend_90_flag"])
    return metrics.roc_auc(scored, "spend_90_flag", "pred_prob", 1, ["role"])


def nation_days(spark: SparkSession, root: str) -> DataFrame:
    """Spend per nation and day, days without orders as zeros, with calendar columns."""
    customers = table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, root, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("id"))
    days = (
        order_days(spark, root)
        .join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .groupBy("id", "date")
        .agg(F.sum("spend").cast("double").alias("value"))
    )
    padded = calendar.pad(kept(days), ["id"], "date", "day", 0.0)
    wanted = ("index_num", "year", "half", "quarter", "month", "mday", "wday", "yday", "week", "mday7")
    sig = {k: v.cast("double") for k, v in dates.signature("date").items() if k in wanted}
    return padded.withColumns(sig)


CALENDAR = ("year", "quarter", "month", "mday", "wday", "yday", "week")
PANEL = Design("value", CALENDAR, ("id",))


@query("mod_tweedie")
def mod_tweedie(spark: SparkSession, root: str) -> DataFrame:
    """A daily target with many zeros."""
    rows = splits.time_split(kept(nation_days(spark, root)), "date", 28)
    train = cut_lineage(splits.training(rows))
    scaled = Design("value", ("year", "month", "wday"), ("id",), scaled=True)
    model, unit = models.fit_in_means(scaled, models.tweedie(1.5, 0.01), train)
    scored = models.predict(model, train, ["id", "value"])
    return scored.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("value") == 0, 1)).alias("n_zero"),
        F.avg("value").alias("mean_actual"),
        (F.avg("prediction") * unit).alias("mean_prediction"),
        (F.min("prediction") * unit).alias("lowest_prediction"),
    )


@query(
    "mod_lm",
    """SELECT count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem""",
)
def mod_lm(spark: SparkSession, root: str) -> DataFrame:
    """Least squares with one feature, its coefficients as a table."""
    lines = table(spark, root, "lineitem").select("l_quantity", "l_extendedprice")
    fitted = models.fit(Design("l_extendedprice", ("l_quantity",)), models.linear(), lines).stages[-1]
    return lines.agg(F.count(F.lit(1)).alias("n")).select(
        "n",
        F.round(F.lit(float(fitted.coefficients[0])), 3).alias("slope"),
        F.round(F.lit(float(fitted.intercept)), 3).alias("intercept"),
    )


@query("mod_enet")
def mod_enet(spark: SparkSession, root: str) -> DataFrame:
    rows = line_items(spark, root)
    model = models.fit(LINES, models.elastic_net(200.0, 0.99), splits.training(rows))
    return judged_fit(model, rows, "l_extendedprice")


@query("mod_logit")
def mod_logit(spark: SparkSession, root: str) -> DataFrame:
    rows = cut_lineage(splits.random_split(kept(labelled(spark, root)), "doc_id", 0.8, ["quality"]))
    model = models.fit(QUALITY, models.logistic(0.01, 0.5), splits.training(rows))
    scored = models.predict(model, rows, ["role", "quality"])
    return metrics.roc_auc(scored, "quality", "pred_prob", 1, ["role"])


@query("mod_rf")
def mod_rf(spark: SparkSession, root: str) -> DataFrame:
    rows = cut_lineage(splits.random_split(kept(labelled(spark, root)), "doc_id", 0.8, ["quality"]))
    model = models.fit(QUALITY, models.forest(trees=20), splits.training(rows))
    scored = models.predict(model, rows, ["role", "quality"])
    return metrics.roc_auc(scored, "quality", "pred_prob", 1, ["role"])


@query("mod_mlp")
def mod_mlp(spark: SparkSession, root: str) -> DataFrame:
    """Two hidden layers of 16 units on four scaled features."""
    rows = cut_lineage(splits.split_by_id(kept(rfm_table(spark, root)), "customer_id", 0.8))
    model = models.fit(FLAG, models.network(len(RFM), 16, 16), splits.training(rows))
    scored = models.predict(model, splits.testing(rows), ["spend_90_flag"])
    return metrics.confusion(scored, "spend_90_flag", "pred_class", [0, 1])


@query("mod_global")
def mod_global(spark: SparkSession, root: str) -> DataFrame:
    """One model over all nations, the nation being a feature; errors per nation."""
    rows = splits.time_split(kept(nation_days(spark, root)), "date", 28)
    train = cut_lineage(splits.training(rows))
    model = models.fit(PANEL, models.boosted(trees=5, depth=4), train)
    scored = models.predict(model, splits.testing(rows), ["id", "date", "value"])
    return metrics.accuracy_table(scored.withColumn("model_id", F.lit(1)), ["model_id", "id"], "date", truth="value")


@query("mod_refit")
def mod_refit(spark: SparkSession, root: str) -> DataFrame:
    """The held-out model and the same model refitted on everything, one month ahead."""
    panel = kept(nation_monthly(spark, root))
    sig = lambda df: df.withColumns(
        {k: v.cast("double") for k, v in dates.signature("date").items() if k in ("year", "quarter", "month")}
    )
    design = Design("value", ("year", "quarter", "month"), ("id",))
    full = cut_lineage(sig(panel))
    split = splits.time_split(full, "date", 6)
    learner = models.elastic_net(1.0, 0.5)
    future = sig(calendar.future_rows(full.select("id", "date", "value"), ["id"], "date", 6, "month"))
    held = models.predict(models.fit(design, learner, splits.training(split)), future, ["id", "date", "h"])
    refit = models.predict(models.fit(design, learner, full), future, ["id", "date", "h"])
    return held.select(F.lit("held out").alias("fit"), "*").unionByName(refit.select(F.lit("refit").alias("fit"), "*"))


@query("mod_kmeans")
def mod_kmeans(spark: SparkSession, root: str) -> DataFrame:
    """Symbols grouped by their yearly return profile, three groups."""
    monthly = returns_wide(spark, root).groupBy(F.trunc("date", "year").alias("year")).agg(
        *[F.avg(s).alias(s) for s in SYMBOLS]
    )
    long = shape.longer(monthly, ["year"], SYMBOLS, "symbol", "ret")
    years = [f"{y}-01-01" for y in range(1995, 2002)]
    wide = shape.wider(long.withColumn("year", F.col("year").cast("string")), ["symbol"], "year", "ret", years, prefix="y_")
    wide = cut_lineage(wide.toDF("symbol", *[f"y{i}" for i in range(len(years))]).fillna(0.0))
    flow = Pipeline(
        stages=[
            VectorAssembler(inputCols=wide.columns[1:], outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            models.clusters(3, 20),
        ]
    )
    return flow.fit(wide).transform(wide).select("symbol", F.col("prediction").alias("kmeans_group"))


@query("mod_importance")
def mod_importance(spark: SparkSession, root: str) -> DataFrame:
    """The ten features that matter most to a forest."""
    rows = line_items(spark, root)
    model = models.fit(LINES, models.forest("regression", trees=10), splits.training(rows))
    found = models.importance(model, model.transform(rows), spark)
    return found.orderBy(F.col("importance").desc(), "feature").limit(10)


@query(
    "mod_score_line",
    """WITH d AS (SELECT doc_id, quality, n_chars FROM documents JOIN labels USING (doc_id)),
fit AS (SELECT regr_slope(quality, n_chars) AS b, regr_intercept(quality, n_chars) AS a FROM d)
SELECT doc_id, round(a + b * n_chars, 6) AS prediction FROM d, fit""",
)
def mod_score_line(spark: SparkSession, root: str) -> DataFrame:
    """A stored line applied to a table: the score of every row."""
    rows = kept(labelled(spark, root))
    model = models.fit(Design("quality", ("n_chars",)), models.linear(), rows)
    scored = models.predict(models.load(models.save(model, scratch(spark, "mod_score_line"))), rows, ["doc_id"])
    return scored.withColumn("prediction", F.round("prediction", 6))


@query("mod_score")
def mod_score(spark: SparkSession, root: str) -> DataFrame:
    """Stored features, two of them nominal, and model applied to a table: class and probability of every row."""
    rows = kept(labelled(spark, root))
    path = models.save(models.fit(QUALITY, models.logistic(0.01, 0.5), rows), scratch(spark, "mod_score"))
    return models.predict(models.load(path), rows, ["doc_id"])


LAGS = list(range(1, 13))


def lag_design() -> Design:
    return Design("value", tuple(f"lag{k}" for k in LAGS), ("id",))


@query("mod_recursive_trees")
def mod_recursive_trees(spark: SparkSession, root: str) -> DataFrame:
    """Boosted trees on lags 1 to 12, each step feeding the next, for every nation."""
    panel = kept(nation_monthly(spark, root))
    lagged = windows.add_lags(panel, ["id"], "date", "value", LAGS, [f"lag{k}" for k in LAGS])
    train = cut_lineage(lagged.dropna("any"))
    model = models.fit(lag_design(), models.boosted(trees=5, depth=3), train)
    state = cut_lineage(recursive.tail_state(panel, "id", "date", "value", 12))
    return recursive.model_recursion(state, "id", model.transform, LAGS, 12)


@query(
    "nst_trend",
    """WITH panel AS (SELECT n_name AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT id, count(*) AS n, round(regr_intercept(value, (date - DATE '1995-01-01') / 1000.0), 2) AS intercept,
  round(regr_slope(value, (date - DATE '1995-01-01') / 1000.0), 2) AS slope FROM panel GROUP BY 1""",
)
def nst_trend(spark: SparkSession, root: str) -> DataFrame:
    """A straight line per nation, all solved from sums of products."""
    rows = nation_monthly(spark, root).withColumns(
        {k: v for k, v in perseries.trend_season("date", "1995-01-01").items() if k in ("one", "trend")}
    )
    fitted = perseries.solve(perseries.gram_sums(rows, "id", ["one", "trend"], "value"), "id", ["one", "trend"], {"line": 0.0})
    return fitted.select(
        "id",
        "n",
        F.round(F.get("coefficients", F.lit(0)), 2).alias("intercept"),
        F.round(F.get("coefficients", F.lit(1)), 2).alias("slope"),
    )


WAVES = ["one", "trend", "sin1", "cos1"]


@query("nst_fit")
def nst_fit(spark: SparkSession, root: str) -> DataFrame:
    """Two regressions for every customer; customers with too few days give an error row."""
    rows = customer_days(spark, root).withColumns(perseries.trend_season("date", "1995-01-01", waves=1))
    grams = perseries.gram_sums(rows, "id", WAVES, "value")
    return perseries.solve(grams, "id", WAVES, {"plain": 0.0, "ridge": 0.1})


def nested_predictions(train: DataFrame, future: DataFrame, months: int) -> DataFrame:
    """Two regressions and a temporal hierarchy per series, predictions stacked."""
    waves = lambda df: df.withColumns(perseries.trend_season("date", "1995-01-01", waves=1))
    grams = perseries.gram_sums(waves(train), "id", WAVES, "value")
    fitted = perseries.solve(grams, "id", WAVES, {"plain": 0.0, "ridge": 0.1})
    lines = perseries.predict(waves(future), fitted, "id", WAVES).select(
        F.when(F.col("model_desc") == "plain", 1).otherwise(2).alias("model_id"),
        "model_desc",
        "id",
        "date",
        "h",
        "prediction",
    )
    nodes = temporal.node_forecasts(train, ["id"], "date", "value", 12, 3)
    tier = by_group(future, temporal.reconcile(nodes, ["id"], 12), ["id", "h"], "left")
    return lines.unionByName(
        tier.select(F.lit(3).alias("model_id"), F.lit("hierarchy").alias("model_desc"), "id", "date", "h", "prediction")
    )


@query("nst_best")
def nst_best(spark: SparkSession, root: str) -> DataFrame:
    """Three models per nation, the best by hold-out error, its forecast for six months."""
    from tidalframe.operators.baselines import steps_ahead

    panel = kept(nation_monthly(spark, root))
    split = nested_split = splits.series_tail_split(panel, ["id"], "date", 6)
    test = steps_ahead(splits.testing(split), ["id"], "date")
    truth = test.select("id", "date", F.col("value").alias("actual"))
    tested = by_group(nested_predictions(splits.training(nested_split), test, 6), truth, ["id", "date"])
    accuracy = metrics.accuracy_table(tested, ["model_id", "id"], "date")
    best = forecasts.best_by_series(accuracy, "id", "rmse")
    future = calendar.future_rows(panel, ["id"], "date", 6, "month")
    ahead = nested_predictions(panel, future, 6)
    widths = forecasts.calibrate(tested)
    table_ = forecasts.forecast_table(panel, ahead, widths, "id", "date", "value", level=0.99)
    chosen = forecasts.keep_best(table_.where(F.col("model_id").isNotNull()), best, "id")
    return chosen.unionByName(table_.where(F.col("model_id").isNull()))
