"""Whole studies: from raw tables to the result an analyst reads."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions import dates
from tidalframe.operators import (
    baselines,
    calendar,
    customers,
    features,
    forecasts,
    metrics,
    models,
    neighbours,
    splits,
    tuning,
)
from tidalframe.operators.features import Roles, Steps
from tidalframe.operators.joins import by_group
from tidalframe.operators.models import Design
from tidalframe.plans.features import HORIZON, hier_features
from tidalframe.plans.inputs import MONTHLY, kept, monthly_panel, transactions
from tidalframe.plans.learners import FLAG, RFM, SPEND
from tidalframe.plans.registry import query
from tidalframe.session import cut_lineage
from tidalframe.sources.tables import table

SIZES = list(range(1, 13))
REFERENCE_MODEL = 13


def window_and_season(train: DataFrame, future: DataFrame) -> DataFrame:
    """Thirteen models: window medians of 1 to 12 months, and the last season."""
    levels = baselines.window_levels(train, ["id"], "date", "value", SIZES)
    flat = by_group(future, levels.withColumnRenamed("size", "model_id"), ["id"])
    season = baselines.seasonal_naive(train, future, ["id"], "date", "value", 12)
    return flat.unionByName(season.withColumn("model_id", F.lit(REFERENCE_MODEL)))


@query(
    "study_baselines",
    f"""WITH {MONTHLY}, cut AS (SELECT min(date) AS cut FROM (SELECT DISTINCT date FROM monthly ORDER BY date DESC LIMIT 6)),
sizes AS (SELECT CAST(unnest(range(1, 13)) AS INT) AS model_id),
tr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS r FROM monthly WHERE date < (SELECT cut FROM cut)),
te AS (SELECT id, date, value AS actual, row_number() OVER (PARTITION BY id ORDER BY date) AS h FROM monthly WHERE date >= (SELECT cut FROM cut)),
pred AS (
  SELECT model_id, te.id, date, actual, prediction FROM te JOIN (
    SELECT model_id, id, quantile_cont(value, 0.5) AS prediction FROM tr JOIN sizes ON r <= model_id GROUP BY 1, 2) l ON l.id = te.id
  UNION ALL SELECT 13, te.id, te.date, actual, tr.value FROM te JOIN tr ON tr.id = te.id AND tr.r = 12 - (te.h - 1) % 12),
acc AS (SELECT model_id, id, round(sqrt(avg((actual - prediction) * (actual - prediction))), 4) AS rmse,
  1.959964 * sqrt(2 * sum((actual - prediction) * (actual - prediction)) / (2 * count(*) - 1)) AS reach FROM pred GROUP BY 1, 2),
chosen AS (SELECT model_id, id, reach FROM acc QUALIFY model_id = 13 OR rmse = min(rmse) OVER (PARTITION BY id)),
al AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS r FROM monthly),
fu AS (SELECT id, CAST(h AS INT) AS h, CAST(max(date) + to_months(CAST(h AS INT)) AS DATE) AS date FROM monthly, (SELECT unnest(range(1, 7)) AS h) GROUP BY id, h),
ahead AS (
  SELECT model_id, fu.id, date, prediction FROM fu JOIN (
    SELECT model_id, id, quantile_cont(value, 0.5) AS prediction FROM al JOIN sizes ON r <= model_id GROUP BY 1, 2) l ON l.id = fu.id
  UNION ALL SELECT 13, fu.id, fu.date, al.value FROM fu JOIN al ON al.id = fu.id AND al.r = 12 - (fu.h - 1) % 12)
SELECT c.model_id, c.id, a.date, round(a.prediction, 4) AS value, round(a.prediction - c.reach, 4) AS conf_lo,
  round(a.prediction + c.reach, 4) AS conf_hi FROM chosen c JOIN ahead a ON a.model_id = c.model_id AND a.id = c.id
UNION ALL SELECT NULL, id, date, round(value, 4), NULL, NULL FROM monthly""",
)
def study_baselines(spark: SparkSession, root: str) -> DataFrame:
    """Thirteen baselines: each series' best one and the seasonal one, refitted, six months ahead."""
    panel = kept(monthly_panel(spark, root))
    split = splits.time_split(panel, "date", 6)
    test = baselines.steps_ahead(splits.testing(split), ["id"], "date").withColumnRenamed("value", "actual")
    tested = cut_lineage(window_and_season(splits.training(split), test))
    accuracy = metrics.accuracy_table(tested, ["model_id", "id"], "date")
    lowest = accuracy.groupBy("id").agg(F.min("rmse").alias("_lowest"))
    chosen = by_group(accuracy, lowest, ["id"]).where(
        (F.col("model_id") == REFERENCE_MODEL) | (F.col("rmse") == F.col("_lowest"))
    )
    future = calendar.future_rows(panel, ["id"], "date", 6, "month")
    ahead = window_and_season(panel, future).withColumn("model_desc", F.lit("baseline"))
    out = forecasts.forecast_table(panel, ahead, forecasts.calibrate(tested), "id", "date", "value")
    best = forecasts.keep_best(out.where(F.col("model_id").isNotNull()), chosen, "id")
    return (
        best.unionByName(out.where(F.col("model_id").isNull()))
        .withColumnRenamed("index", "date")
        .select("model_id", "id", "date", "value", "conf_lo", "conf_hi")
    )


def hierarchy_table(spark: SparkSession, root: str) -> DataFrame:
    """The model table of the hierarchy with a few calendar columns."""
    wanted = ("month", "mday", "wday", "week")
    calendar_columns = {k: v.cast("double") for k, v in dates.signature("date").items() if k in wanted}
    return hier_features(spark, root).withColumns(calendar_columns)


@query("study_hierarchical")
def study_hierarchical(spark: SparkSession, root: str) -> DataFrame:
    """Two global models and their 2 : 3 blend on a hierarchy; median error per level and model."""
    table_ = kept(hierarchy_table(spark, root).withColumn("id", F.concat_ws("/", "category", "identifier")))
    known = table_.where(F.col("value").isNotNull()).dropna("any")
    split = splits.time_split(known, "date", HORIZON)
    lag = f"value_lag{HORIZON}"
    design = Design("value", (lag, *[f"{lag}_roll_{k}" for k in (7, 14, 28, 56)], "month", "mday", "wday", "week"), ("id",))
    train, test = splits.training(split), splits.testing(split)
    keys = ["category", "id", "date", "value"]
    tree = models.predict(models.fit(design, models.boosted(trees=5, depth=4), train), test, keys)
    scaled = Design(design.target, design.numeric, design.nominal, scaled=True)
    glm, unit = models.fit_in_means(scaled, models.tweedie(1.5, 0.05), train)
    tweedie = models.predict(glm, test, keys).withColumn("prediction", F.col("prediction") * unit)
    both = forecasts.stack_predictions(("boosted", tree), ("tweedie", tweedie))
    blend = forecasts.weighted(both, keys, {1: 2, 2: 3})
    all_three = both.unionByName(
        blend.select(F.lit(3).alias("model_id"), F.lit("blend").alias("model_desc"), *keys, "prediction")
    )
    accuracy = metrics.accuracy_table(all_three, ["model_id", "model_desc", "category", "id"], "date", truth="value")
    return accuracy.groupBy("category", "model_id", "model_desc").agg(
        F.percentile("rmse", F.lit(0.5)).alias("median_rmse"), F.count(F.lit(1)).alias("n_series")
    )


@query("study_customer_value")
def study_customer_value(spark: SparkSession, root: str) -> DataFrame:
    """Customers split in two, each half split in time; spend and purchase of the next 90 days."""
    log = splits.split_by_id(transactions(spark, root), "customer_id", 0.8)
    halves = {}
    cutoff = None
    for role, rows in (("training", splits.training(log)), ("testing", splits.testing(log))):
        in_time = splits.time_split(rows, "date", "90 days")
        before, after = splits.training(in_time), splits.testing(in_time)
        if cutoff is None:
            cutoff = before.agg(F.max("date")).first()[0]
        halves[role] = cut_lineage(
            customers.features_with_targets(before, after, "customer_id", "date", "price", F.lit(cutoff))
        )
    train, test = halves["training"], halves["testing"]
    spend = models.fit(SPEND, models.boosted(trees=5, depth=3), train)
    buys = models.fit(FLAG, models.logistic(), train)
    cols = ["customer_id", "spend_90_total", "spend_90_flag", *RFM]
    scored = models.predict(spend, test, cols).withColumnRenamed("prediction", "pred_total")
    scored = models.predict(buys, scored, [*cols, "pred_total"])
    auc = metrics.roc_auc(scored, "spend_90_flag", "pred_prob")
    return scored.agg(
        F.count(F.lit(1)).alias("n_customers"), metrics.mae("spend_90_total", "pred_total").alias("mae")
    ).withColumn("auc", auc.scalar())


@query("study_churn")
def study_churn(spark: SparkSession, root: str) -> DataFrame:
    """Binned, logged, dummied and scaled features, a network, its confusion table with accuracy."""
    split = splits.time_split(transactions(spark, root), "date", "90 days")
    rfm = customers.features_with_targets(
        splits.training(split), splits.testing(split), "customer_id", "date", "price"
    )
    people = table(spark, root, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    rows = rfm.join(people, "customer_id").drop("spend_90_total")
    rows = kept(rows.withColumns({"frequency": F.col("frequency").cast("double"), "recency": F.col("recency").cast("double")}))
    split = cut_lineage(splits.random_split(rows, "customer_id", 0.8))
    roles = Roles("spend_90_flag", ("customer_id", "role"))
    apply = Steps(
        [
            features.discretize("frequency", 6),
            features.log("price_sum"),
            features.dummies(roles.nominal_predictors()),
            features.normalize(roles.numeric_predictors()),
        ]
    ).fit(split.where(F.col("role") == splits.TRAIN))
    ready = cut_lineage(apply(split))
    inputs = tuple(roles.predictors()(ready))
    model = models.fit(
        Design("spend_90_flag", inputs), models.network(len(inputs), 16, 16, steps=30), splits.training(ready)
    )
    scored = models.predict(model, splits.testing(ready), ["spend_90_flag"])
    overall = scored.agg(metrics.accuracy("spend_90_flag", "pred_class")).scalar()
    return metrics.confusion(scored, "spend_90_flag", "pred_class", [0, 1]).withColumn("accuracy", overall)


@query("study_recipes")
def study_recipes(spark: SparkSession, root: str) -> DataFrame:
    """Unknown sizes left out, set to the mean or taken from 3 or 5 neighbours, with two learners, ranked.

    Means, ranges and neighbours of a fold come from the other folds.
    """
    size = F.when(~F.col("p_name").startswith("red"), F.col("p_size").cast("double"))
    colour = F.split("p_name", " ")[0].alias("colour")
    rows = table(spark, root, "part").select("p_partkey", "p_brand", "p_type", colour, "p_retailprice", size.alias("size"))
    folded = cut_lineage(splits.folds(kept(rows), "p_partkey", 3))
    cats = ("p_brand", "p_type")

    def filled(i: int) -> DataFrame:
        train = folded.where(F.col("fold") != i)
        model = neighbours.fit(train, "p_partkey", "size", [], [*cats, "colour"], 5)
        full = folded.withColumn("size_mean", F.coalesce("size", train.agg(F.avg("size")).scalar()))
        full = neighbours.with_several(model, full, {"size_knn3": 3, "size_knn5": 5})
        return cut_lineage(full.drop("size"))

    with ThreadPool(3) as pool:
        tables = dict(enumerate(pool.map(filled, range(3), chunksize=1)))
    designs = {
        "without": Design("p_retailprice", (), cats),
        "mean": Design("p_retailprice", ("size_mean",), cats),
        "knn3": Design("p_retailprice", ("size_knn3",), cats),
        "knn5": Design("p_retailprice", ("size_knn5",), cats),
    }
    learners = {"net": models.elastic_net(0.1, 0.5), "forest": models.forest("regression", trees=20, depth=5)}
    oof = cut_lineage(tuning.out_of_fold(tables, tuning.cross(designs, learners), ["p_partkey", "p_retailprice"], 3))
    per_fold = oof.groupBy("candidate", "fold").agg(
        metrics.rmse("p_retailprice", "prediction").alias("rmse"), metrics.rsq("p_retailprice", "prediction").alias("rsq")
    )
    rsq = per_fold.groupBy("candidate").agg(F.avg("rsq").alias("mean_rsq"))
    return tuning.rank_results(tuning.summarise_folds(per_fold, "rmse")).join(rsq, "candidate")
