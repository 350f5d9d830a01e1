"""Resampling, grids, racing, ranking, stacking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import baselines, metrics, models, shape, splits, tuning
from tidalframe.operators.joins import by_group
from tidalframe.operators.models import Design
from tidalframe.plans.customers import rfm_table
from tidalframe.plans.flagship import METRICS_SQL
from tidalframe.plans.inputs import MONTHLY, kept, labelled, monthly_panel
from tidalframe.plans.learners import FLAG, QUALITY, RFM
from tidalframe.plans.registry import query
from tidalframe.session import cut_lineage

FOLDS = 5


def folded_documents(spark: SparkSession, root: str) -> DataFrame:
    return cut_lineage(splits.folds(kept(labelled(spark, root)), "doc_id", FOLDS, ["quality"]))


def fold_auc(oof: DataFrame, target: str) -> DataFrame:
    return metrics.roc_auc(oof, target, "pred_prob", 1, ["candidate", "fold"])


@query("tun_resamples")
def tun_resamples(spark: SparkSession, root: str) -> DataFrame:
    """One model over five stratified folds: mean, count and standard error."""
    candidates = [("logistic", QUALITY, models.logistic(0.01, 0.5))]
    oof = tuning.out_of_fold(folded_documents(spark, root), candidates, ["doc_id", "quality"], FOLDS)
    return tuning.summarise_folds(fold_auc(oof, "quality"), "auc")


@query("tun_grid")
def tun_grid(spark: SparkSession, root: str) -> DataFrame:
    """A grid of penalties and mixtures, out-of-fold predictions kept and ranked."""
    options = tuning.grid(penalty=[0.001, 0.05], mixture=[0.0, 1.0])
    candidates = [(f"penalty {o['penalty']} mixture {o['mixture']}", QUALITY, models.logistic(**o)) for o in options]
    oof = tuning.out_of_fold(folded_documents(spark, root), candidates, ["doc_id", "quality"], FOLDS)
    return tuning.rank_results(tuning.summarise_folds(fold_auc(oof, "quality"), "auc"), largest=True)


@query("tun_set")
def tun_set(spark: SparkSession, root: str) -> DataFrame:
    """Three feature designs with three learners, each over three folds."""
    rows = splits.folds(kept(rfm_table(spark, root)), "customer_id", 3, ["spend_90_flag"])
    designs = {
        "recency": Design("spend_90_total", ("recency", "frequency")),
        "money": Design("spend_90_total", ("price_sum", "price_mean")),
        "all": Design("spend_90_total", RFM),
    }
    learners = {
        "net": models.elastic_net(1.0, 0.5),
        "boosted": models.boosted(trees=3, depth=3),
        "forest": models.forest("regression", trees=5, depth=4),
    }
    oof = tuning.out_of_fold(
        cut_lineage(rows), tuning.cross(designs, learners), ["customer_id", "spend_90_total"], 3
    )
    per_fold = oof.groupBy("candidate", "fold").agg(metrics.rmse("spend_90_total", "prediction").alias("rmse"))
    return tuning.rank_results(tuning.summarise_folds(per_fold, "rmse"))


SIZES = list(range(1, 13))
SLICES = 5


def window_errors(sizes: list[int], folded: DataFrame, slice_id: int) -> DataFrame:
    """rmse of each window size on one backtest slice."""
    rows = folded.where(F.col("slice_id") == slice_id)
    train, test = splits.training(rows), splits.testing(rows)
    levels = baselines.window_levels(train, ["id"], "date", "value", sizes)
    scored = by_group(test.withColumnRenamed("value", "actual"), levels, ["id"])
    return scored.groupBy(F.col("size").alias("candidate")).agg(metrics.rmse("actual", "prediction").alias("metric"))


SLICED = f"""{MONTHLY}, days AS (SELECT date, row_number() OVER (ORDER BY date DESC) AS b FROM (SELECT DISTINCT date FROM monthly)),
bounds AS (SELECT s AS slice_id, min(date) AS a, max(date) AS z FROM (SELECT unnest(range(1, {SLICES + 1})) AS s)
  JOIN days ON b BETWEEN 6 * (s - 1) + 1 AND 6 * s GROUP BY 1),
tr AS (SELECT slice_id, id, value, row_number() OVER (PARTITION BY slice_id, id ORDER BY date DESC) AS r FROM monthly JOIN bounds ON date < a),
sizes AS (SELECT CAST(unnest(range(1, 13)) AS INT) AS candidate),
levels AS (SELECT slice_id, candidate, id, quantile_cont(value, 0.5) AS prediction FROM tr JOIN sizes ON r <= candidate GROUP BY 1, 2, 3),
te AS (SELECT slice_id, id, date, value AS actual FROM monthly JOIN bounds ON date BETWEEN a AND z),
errs AS (SELECT slice_id, candidate, sqrt(avg((actual - prediction) * (actual - prediction))) AS metric
  FROM te JOIN levels USING (slice_id, id) GROUP BY 1, 2)"""


def _race_step(n: int, t: float) -> str:
    prior = f"SELECT candidate FROM alive{n - 1}" if n > 3 else "SELECT candidate FROM sizes"
    return f"""lead{n} AS (SELECT candidate FROM errs WHERE slice_id <= {n} AND candidate IN ({prior}) GROUP BY 1 ORDER BY avg(metric), candidate LIMIT 1),
gap{n} AS (SELECT e.candidate, avg(e.metric - l.metric) AS m, stddev_samp(e.metric - l.metric) AS s FROM errs e
  JOIN errs l ON l.slice_id = e.slice_id AND l.candidate = (SELECT candidate FROM lead{n})
  WHERE e.slice_id <= {n} AND e.candidate IN ({prior}) GROUP BY 1),
alive{n} AS (SELECT candidate FROM gap{n} WHERE m - {t} * s / sqrt({n}) <= 0)"""


@query(
    "tun_race",
    f"""WITH {SLICED}, {_race_step(3, 4.302653)}, {_race_step(4, 3.182446)}, {_race_step(5, 2.776445)},
ran AS (SELECT candidate, CASE WHEN candidate NOT IN (SELECT candidate FROM alive3) THEN 3
  WHEN candidate NOT IN (SELECT candidate FROM alive4) THEN 4 ELSE 5 END AS n_folds,
  candidate NOT IN (SELECT candidate FROM alive5) AS dropped FROM sizes)
SELECT r.candidate, r.n_folds, round(avg(e.metric), 4) AS mean_metric, r.dropped FROM ran r JOIN errs e ON e.candidate = r.candidate
AND e.slice_id <= r.n_folds GROUP BY 1, 2, 4""",
)
def tun_race(spark: SparkSession, root: str) -> DataFrame:
    """Twelve window sizes raced over five backtest slices."""
    folded = cut_lineage(splits.time_folds(kept(monthly_panel(spark, root)), "date", 6, SLICES))
    out = tuning.race(spark, SIZES, lambda alive, i: window_errors(alive, folded, i + 1), SLICES)
    return out.withColumn("mean_metric", F.round("mean_metric", 4))


GRID_SQL = f"""{MONTHLY}, cut AS (SELECT min(date) AS cut FROM (SELECT DISTINCT date FROM monthly ORDER BY date DESC LIMIT 6)),
tr AS (SELECT id, value, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS r FROM monthly WHERE date < (SELECT cut FROM cut)),
sizes AS (SELECT CAST(unnest(range(1, 13)) AS INT) AS model_id),
levels AS (SELECT model_id, id, quantile_cont(value, 0.5) AS prediction FROM tr JOIN sizes ON r <= model_id GROUP BY 1, 2),
stepped AS (SELECT model_id, id, date, value AS actual, prediction,
  abs(value - lag(value) OVER (PARTITION BY model_id, id ORDER BY date)) AS step FROM monthly JOIN levels USING (id)
  WHERE date >= (SELECT cut FROM cut)), acc AS (SELECT model_id, {METRICS_SQL} FROM stepped GROUP BY 1)"""


def window_accuracy(spark: SparkSession, root: str) -> DataFrame:
    """Twelve models from a grid of window sizes, scored on the last six months.

    All sizes are taken from one tail of twelve rows, in one aggregation.
    """
    split = splits.time_split(kept(monthly_panel(spark, root)), "date", 6)
    levels = baselines.window_levels(splits.training(split), ["id"], "date", "value", SIZES)
    scored = by_group(splits.testing(split).withColumnRenamed("value", "actual"), levels, ["id"])
    return metrics.accuracy_table(
        scored.withColumnRenamed("size", "model_id"), ["model_id"], "date", series=["id"]
    )


@query("tun_model_grid", f"WITH {GRID_SQL} SELECT * FROM acc")
def tun_model_grid(spark: SparkSession, root: str) -> DataFrame:
    return window_accuracy(spark, root)


@query(
    "tun_rank",
    f"""WITH {GRID_SQL} SELECT model_id, rmse, CAST(rank() OVER (ORDER BY rmse) AS INT) AS rank,
        rank() OVER (ORDER BY rmse) = 1 AS chosen FROM acc""",
)
def tun_rank(spark: SparkSession, root: str) -> DataFrame:
    """All grid results ranked, the winner marked."""
    ranked = tuning.rank_results(window_accuracy(spark, root), "rmse")
    return ranked.select("model_id", "rmse", "rank", (F.col("rank") == 1).alias("chosen"))


@query("mod_leaderboard")
def mod_leaderboard(spark: SparkSession, root: str) -> DataFrame:
    """Several learners over the same folds, ranked by their error."""
    rows = cut_lineage(splits.folds(kept(rfm_table(spark, root)), "customer_id", FOLDS))
    design = Design("spend_90_total", RFM)
    candidates = [
        ("linear", design, models.linear()),
        ("elastic net", design, models.elastic_net(100.0, 0.5)),
        ("boosted slow", design, models.boosted(trees=3, depth=3, learn_rate=0.1)),
        ("forest", design, models.forest("regression", trees=5, depth=4)),
    ]
    oof = tuning.out_of_fold(rows, candidates, ["customer_id", "spend_90_total"], FOLDS)
    per_fold = oof.groupBy("candidate", "fold").agg(metrics.rmse("spend_90_total", "prediction").alias("rmse"))
    return tuning.rank_results(tuning.summarise_folds(per_fold, "rmse"))


@query("met_runs")
def met_runs(spark: SparkSession, root: str) -> DataFrame:
    """One row per network configuration: accuracy and area under the curve; the best is marked."""
    rows = cut_lineage(splits.split_by_id(kept(rfm_table(spark, root)), "customer_id", 0.8))
    out = None
    for u1, u2 in ((16, 16), (8, 4), (4, 4)):
        model = models.fit(FLAG, models.network(len(RFM), u1, u2, steps=20), splits.training(rows))
        scored = models.predict(model, splits.testing(rows), ["spend_90_flag"])
        auc = metrics.roc_auc(scored, "spend_90_flag", "pred_prob")
        hit = scored.agg(
            F.lit(u1).alias("units1"), F.lit(u2).alias("units2"), metrics.accuracy("spend_90_flag", "pred_class").alias("accuracy")
        )
        run = hit.withColumn("auc", auc.scalar())
        out = run if out is None else out.unionByName(run)
    runs = cut_lineage(out)
    best = runs.orderBy(F.col("accuracy").desc(), F.col("auc").desc(), "units1", "units2").limit(1)
    chosen = best.select("units1", "units2", F.lit(True).alias("chosen"))
    return runs.join(chosen, ["units1", "units2"], "left").fillna({"chosen": False})


@query("ens_stack")
def ens_stack(spark: SparkSession, root: str) -> DataFrame:
    """Three learners stacked by non-negative weights; area under the curve of each and of the blend."""
    rows = cut_lineage(
        splits.random_split(kept(rfm_table(spark, root)), "customer_id", 0.8, ["spend_90_flag"])
    )
    train = cut_lineage(splits.folds(splits.training(rows), "customer_id", FOLDS, ["spend_90_flag"]))
    learners = {
        "logistic": models.logistic(0.01, 0.5),
        "forest": models.forest(trees=10, depth=4),
        "boosted": models.boosted("classification", trees=5, depth=3),
    }
    candidates = [(name, FLAG, learner) for name, learner in learners.items()]
    oof = tuning.out_of_fold(train, candidates, ["customer_id", "spend_90_flag"], FOLDS)
    wide = shape.wider(oof, ["customer_id", "spend_90_flag"], "candidate", "pred_prob", list(learners))
    weights = tuning.stack_weights(wide, list(learners), "spend_90_flag")
    scored = splits.testing(rows).select("customer_id", "spend_90_flag", *RFM)
    for name, learner in learners.items():
        model = models.fit(FLAG, learner, train)
        keep = ["customer_id", "spend_90_flag", *RFM, *[n for n in learners if n in scored.columns]]
        scored = models.predict(model, scored, keep).drop("pred_class").withColumnRenamed("pred_prob", name)
    scored = tuning.blend(scored, weights)
    long = shape.longer(scored, ["customer_id", "spend_90_flag"], [*learners, "blend"], "model", "score")
    auc = metrics.roc_auc(long, "spend_90_flag", "score", 1, ["model"])
    weight_rows = spark.createDataFrame([*weights.items(), ("blend", 1.0)], "model string, weight double")
    return auc.join(weight_rows, "model")
