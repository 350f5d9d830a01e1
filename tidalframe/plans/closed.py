"""Model fits with a closed form, so that SQL can say what they must give.

A least-squares line, an elastic net of one feature, and models of one 0/1 feature, whose
fits are the means of the two groups. They go through the same workflow, storage, folds
and grids as the larger models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import calendar, forecasts, metrics, models, splits, tuning
from tidalframe.operators.models import Design
from tidalframe.plans.customers import RFM as RFM_SQL
from tidalframe.plans.customers import rfm_table
from tidalframe.plans.inputs import kept, labelled, nation_monthly
from tidalframe.plans.registry import query
from tidalframe.session import cut_by
from tidalframe.sources.tables import table

LINE = Design("l_extendedprice", ("l_quantity",))
FITTED = """fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem WHERE l_orderkey % 5 <> 0)"""


def lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines, those of each fifth order held out."""
    role = F.when(F.col("l_orderkey") % 5 == 0, splits.TEST).otherwise(splits.TRAIN)
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", role.alias("role"))


@query("mod_workflow_line", f"WITH {FITTED} SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 3) AS prediction FROM lineitem, fit WHERE l_orderkey % 5 = 0")
def mod_workflow_line(spark: SparkSession, root: str) -> DataFrame:
    """Scaling and a least-squares line as one workflow, applied to held-out lines."""
    rows = lines(spark, root)
    model = models.fit(Design("l_extendedprice", ("l_quantity",), scaled=True), models.linear(), splits.training(rows))
    return models.predict(model, splits.testing(rows), ["l_orderkey", "l_linenumber"]).withColumn("prediction", F.round("prediction", 3))


PENALTIES = (0.0, 2000.0, 60000.0)


def _net(penalty: float, mixture: float) -> str:
    """Slope of an elastic net of one feature: the correlation shrunk and scaled back."""
    pull = f"({penalty}::DOUBLE / stddev_pop(l_extendedprice))"
    r = "corr(l_extendedprice, l_quantity)"
    return f"sign({r}) * greatest(abs({r}) - {pull} * {mixture}, 0) / (1 + {pull} * {1 - mixture}) * stddev_pop(l_extendedprice) / stddev_pop(l_quantity)"


@query(
    "mod_enet_line",
    " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS penalty, round(b + 0.0, 2) AS slope, round(my - b * mx, 2) AS intercept FROM (SELECT {_net(p, 0.5)} AS b, avg(l_extendedprice) AS my, avg(l_quantity) AS mx FROM lineitem)"
        for p in PENALTIES
    ),
)
def mod_enet_line(spark: SparkSession, root: str) -> DataFrame:
    """Elastic nets of one feature, from no penalty to one that leaves the mean."""
    rows, out = kept(lines(spark, root)), []
    for p in PENALTIES:
        last = models.fit(LINE, models.elastic_net(p, 0.5), rows).stages[-1]
        out.append((p, round(float(last.coefficients[0]), 2) + 0.0, round(float(last.intercept), 2)))
    return spark.createDataFrame(out, "penalty double, slope double, intercept double")


@query(
    "mod_refit_line",
    """WITH panel AS (SELECT n_name AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
held AS (SELECT min(date) AS d FROM (SELECT DISTINCT date FROM panel ORDER BY date DESC LIMIT 6)),
fits AS (SELECT 'held out' AS fit, regr_slope(value, date - DATE '1995-01-01') AS b, regr_intercept(value, date - DATE '1995-01-01') AS a FROM panel WHERE date < (SELECT d FROM held)
  UNION ALL SELECT 'refit', regr_slope(value, date - DATE '1995-01-01'), regr_intercept(value, date - DATE '1995-01-01') FROM panel),
ahead AS (SELECT id, CAST(max(date) + to_months(CAST(h AS INT)) AS DATE) AS date, CAST(h AS INT) AS h FROM panel, range(1, 7) t(h) GROUP BY id, h)
SELECT fit, id, date, h, round(a + b * (date - DATE '1995-01-01'), 1) AS prediction FROM ahead, fits""",
)
def mod_refit_line(spark: SparkSession, root: str) -> DataFrame:
    """A line through all nations, held out by time and refitted on everything, half a year ahead."""
    aged = lambda df: df.withColumn("t", F.datediff("date", F.to_date(F.lit("1995-01-01"))).cast("double"))
    panel, design = kept(aged(nation_monthly(spark, root))), Design("value", ("t",))
    future = aged(calendar.future_rows(panel.select("id", "date"), ["id"], "date", 6, "month"))
    out = None
    for name, rows in (("held out", splits.training(splits.time_split(panel, "date", 6))), ("refit", panel)):
        ahead = models.predict(models.fit(design, models.linear(), rows), future, ["id", "date", "h"])
        ahead = ahead.select(F.lit(name).alias("fit"), "*")
        out = ahead if out is None else out.unionByName(ahead)
    return out.withColumn("prediction", F.round("prediction", 1))


FOLDS = 5
FOLD_FITS = f"""folds AS (SELECT * FROM range({FOLDS}) t(k)),
size_fit AS (SELECT k, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem, folds WHERE l_orderkey % {FOLDS} <> k GROUP BY k),
key_fit AS (SELECT k, regr_slope(l_extendedprice, l_orderkey) AS b, regr_intercept(l_extendedprice, l_orderkey) AS a FROM lineitem, folds WHERE l_orderkey % {FOLDS} <> k GROUP BY k),
errors AS (SELECT 'size_line' AS candidate, k, sqrt(avg((l_extendedprice - a - b * l_quantity) ** 2)) AS rmse FROM lineitem JOIN size_fit ON l_orderkey % {FOLDS} = k GROUP BY k
  UNION ALL SELECT 'key_line', k, sqrt(avg((l_extendedprice - a - b * l_orderkey) ** 2)) FROM lineitem JOIN key_fit ON l_orderkey % {FOLDS} = k GROUP BY k)"""
SUMMED = "round(avg(rmse), 4) AS mean, count(*) AS n, round(stddev_samp(rmse) / sqrt(count(*)), 4) AS std_err"


def fold_errors(spark: SparkSession, root: str, candidates) -> DataFrame:
    """Summary of the root mean square error of candidates over folds by key."""
    rows = cut_by(lines(spark, root).withColumn("fold", (F.col("l_orderkey") % FOLDS).cast("int")), "fold")
    oof = tuning.out_of_fold(rows, candidates, ["l_orderkey", "l_extendedprice"], FOLDS)
    per_fold = oof.groupBy("candidate", "fold").agg(metrics.rmse("l_extendedprice", "prediction").alias("rmse"))
    return tuning.summarise_folds(per_fold, "rmse").withColumns({c: F.round(c, 4) for c in ("mean", "std_err")})


@query("tun_resamples_line", f"WITH {FOLD_FITS} SELECT candidate, {SUMMED} FROM errors WHERE candidate = 'size_line' GROUP BY 1")
def tun_resamples_line(spark: SparkSession, root: str) -> DataFrame:
    return fold_errors(spark, root, [("size_line", LINE, models.linear())])


@query("tun_set_line", f"WITH {FOLD_FITS} SELECT *, CAST(rank() OVER (ORDER BY mean) AS INT) AS rank FROM (SELECT candidate, {SUMMED} FROM errors GROUP BY 1)")
def tun_set_line(spark: SparkSession, root: str) -> DataFrame:
    """Two feature designs with one learner, ranked: a workflow set and its leaderboard."""
    designs = {"size": LINE, "key": Design("l_extendedprice", ("l_orderkey",))}
    return tuning.rank_results(fold_errors(spark, root, tuning.cross(designs, {"line": models.linear()})))


@query(
    "tun_grid_line",
    f"WITH folds AS (SELECT * FROM range({FOLDS}) t(k)), "
    + "fits AS ("
    + " UNION ALL ".join(
        f"SELECT 'penalty {p}' AS candidate, k, b, my - b * mx AS a FROM (SELECT k, {_net(p, 0.5)} AS b, avg(l_extendedprice) AS my, avg(l_quantity) AS mx FROM lineitem, folds WHERE l_orderkey % {FOLDS} <> k GROUP BY k)"
        for p in PENALTIES
    )
    + f"), errors AS (SELECT candidate, k, sqrt(avg((l_extendedprice - a - b * l_quantity) ** 2)) AS rmse FROM lineitem JOIN fits ON l_orderkey % {FOLDS} = k GROUP BY 1, 2) "
    + "SELECT candidate, round(avg(rmse), 2) AS mean, count(*) AS n FROM errors GROUP BY 1",
)
def tun_grid_line(spark: SparkSession, root: str) -> DataFrame:
    """A grid of penalties over folds."""
    candidates = [(f"penalty {o['penalty']}", LINE, models.elastic_net(o["penalty"], 0.5)) for o in tuning.grid(penalty=PENALTIES)]
    return fold_errors(spark, root, candidates).select("candidate", F.round("mean", 2).alias("mean"), "n")


EN = Design("quality", ("en",))


def english(spark: SparkSession, root: str) -> DataFrame:
    rows = labelled(spark, root).withColumn("en", (F.col("lang") == "en").cast("double"))
    return kept(rows.withColumn("mark", F.col("quality").cast("double") + 1))


MEANS = "SELECT CAST(lang = 'en' AS DOUBLE) AS en, count(*) AS n, {} AS prediction FROM documents JOIN labels USING (doc_id) GROUP BY 1"


def by_group(scored: DataFrame, value: str, digits: int = 4) -> DataFrame:
    return scored.groupBy("en").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), digits).alias("prediction"))


@query("mod_logit_groups", MEANS.format("round(avg(quality), 4)"))
def mod_logit_groups(spark: SparkSession, root: str) -> DataFrame:
    """Logistic regression on one 0/1 feature gives the shares of the groups."""
    rows, learner = english(spark, root), models.logistic()
    learner.setTol(1e-12)
    return by_group(models.predict(models.fit(EN, learner, rows), rows, ["en"]), "pred_prob")


@query("mod_gbt_groups", MEANS.format("round(avg(quality), 4)"))
def mod_gbt_groups(spark: SparkSession, root: str) -> DataFrame:
    """One boosted tree with one split gives the means of the groups."""
    rows = english(spark, root)
    model = models.fit(EN, models.boosted(trees=1, learn_rate=1.0, depth=1), rows)
    return by_group(models.predict(model, rows, ["en"]), "prediction")


@query("mod_gbt_class_groups", MEANS.format("round(1 / (1 + exp(-2 * (2 * avg(quality) - 1))), 4)"))
def mod_gbt_class_groups(spark: SparkSession, root: str) -> DataFrame:
    """One boosted classification tree: its leaves are mean labels of -1 and 1, twice that is the log-odds."""
    rows = english(spark, root)
    model = models.fit(EN, models.boosted("classification", trees=1, learn_rate=1.0, depth=1), rows)
    return by_group(models.predict(model, rows, ["en"]), "pred_prob")


@query(
    "mod_rf_groups",
    """SELECT CAST(l_quantity > 25 AS DOUBLE) AS large, count(*) AS n, round(avg(CAST(l_quantity > 20 AS INT)), 4) AS share
       FROM lineitem GROUP BY 1""",
)
def mod_rf_groups(spark: SparkSession, root: str) -> DataFrame:
    """A forest of one tree with one split, which sees every row, gives the shares of the groups."""
    rows = kept(lines(spark, root).select((F.col("l_quantity") > 25).cast("double").alias("large"), (F.col("l_quantity") > 20).cast("double").alias("many")))
    scored = models.predict(models.fit(Design("many", ("large",)), models.forest(trees=1, depth=1).setBootstrap(False), rows), rows, ["large"])
    return scored.groupBy("large").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("pred_prob"), 4).alias("share"))


@query("mod_tweedie_groups", MEANS.format("round(avg(quality + 1), 3)"))
def mod_tweedie_groups(spark: SparkSession, root: str) -> DataFrame:
    """A log-link model of one 0/1 feature gives the means of the groups."""
    rows = english(spark, root)
    model, unit = models.fit_in_means(Design("mark", ("en",)), models.tweedie(1.5, 0.0), rows)
    return by_group(models.predict(model, rows, ["en"]).withColumn("prediction", F.col("prediction") * unit), "prediction", 3)


@query("mod_global_ids", "SELECT lang, count(*) AS n, round(avg(quality), 3) AS prediction FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def mod_global_ids(spark: SparkSession, root: str) -> DataFrame:
    """One model for all, the id in hashed slots: the mean of each id."""
    rows = kept(labelled(spark, root))
    model = models.fit(Design("quality", hashed=("lang",), slots=1024), models.linear(), rows)
    scored = models.predict(model, rows, ["lang"])
    return scored.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 3).alias("prediction"))


def _best_cut(feature: str) -> str:
    return f"""SELECT '{feature}' AS feature, max(gl * gl / nl + gr * gr / nr) AS gain FROM (SELECT x, sum(g) OVER w AS gl, sum(n) OVER w AS nl,
  sum(g) OVER () - sum(g) OVER w AS gr, sum(n) OVER () - sum(n) OVER w AS nr FROM (SELECT {feature} AS x, sum(l_extendedprice - m) AS g, count(*) AS n
  FROM lineitem, (SELECT avg(l_extendedprice) AS m FROM lineitem) GROUP BY 1) WINDOW w AS (ORDER BY x)) WHERE nr > 0"""


SPLIT_ON = ("l_tax", "l_quantity", "l_discount")


@query(
    "mod_importance_split",
    f"WITH cuts AS ({' UNION ALL '.join(_best_cut(f) for f in SPLIT_ON)}) SELECT feature, CASE WHEN gain = max(gain) OVER () THEN 1.0 ELSE 0.0 END::DOUBLE AS importance FROM cuts",
)
def mod_importance_split(spark: SparkSession, root: str) -> DataFrame:
    """A tree of one split gives all importance to the feature whose best cut parts the prices best."""
    rows = kept(table(spark, root, "lineitem").select(*SPLIT_ON, "l_extendedprice"))
    model = models.fit(Design("l_extendedprice", SPLIT_ON), models.boosted(trees=1, learn_rate=1.0, depth=1), rows)
    return models.importance(model, model.transform(rows), spark)


@query(
    "mod_kmeans_groups",
    """WITH apart AS (SELECT DISTINCT p_type, dense_rank() OVER (ORDER BY p_type) AS place FROM part)
SELECT p_partkey, place - 1 AS kmeans_group FROM part JOIN apart USING (p_type)""",
)
def mod_kmeans_groups(spark: SparkSession, root: str) -> DataFrame:
    """Parts whose types lie far apart: every part is in the group of its type, groups in the order of their centres."""
    types = [r[0] for r in table(spark, root, "part").select("p_type").distinct().orderBy("p_type").collect()]
    place = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("p_type")).cast("double")
    rows = kept(table(spark, root, "part").select("p_partkey", (place * 1000 + F.col("p_size")).alias("x")))
    flow = models.workflow(Design("p_partkey", ("x",)), models.clusters(len(types), 50)).fit(rows)
    centres = [float(c[0]) for c in flow.stages[-1].clusterCenters()]
    order = F.array(*[F.lit(sorted(centres).index(c)).cast("long") for c in centres])
    return flow.transform(rows).select("p_partkey", order[F.col("prediction")].alias("kmeans_group"))


@query("mod_importance_one", "SELECT 'l_quantity' AS feature, 1.0::DOUBLE AS importance FROM lineitem LIMIT 1")
def mod_importance_one(spark: SparkSession, root: str) -> DataFrame:
    """The only feature of a tree has all the importance."""
    rows = kept(lines(spark, root))
    model = models.fit(LINE, models.boosted(trees=1, learn_rate=1.0, depth=2), rows)
    return models.importance(model, model.transform(rows), spark)


GROUPS = ("recency", "frequency", "price_mean")


@query("mod_kmeans_nearest", f"WITH {RFM_SQL} SELECT count(*) AS n, count(*) AS n_nearest FROM rfm")
def mod_kmeans_nearest(spark: SparkSession, root: str) -> DataFrame:
    """Ten groups of customers: each customer is with the centre nearest to it."""
    rows = kept(rfm_table(spark, root).select("customer_id", *GROUPS))
    flow = models.workflow(Design("customer_id", GROUPS, scaled=True), models.clusters(10)).fit(rows)
    from pyspark.ml.functions import vector_to_array

    scored = flow.transform(rows).withColumn("x", vector_to_array("features"))
    reach = [sum((F.pow(F.col("x")[k] - F.lit(float(v)), 2) for k, v in enumerate(c)), F.lit(0.0)) for c in flow.stages[-1].clusterCenters()]
    own = F.element_at(F.array(*reach), F.col("prediction") + 1)
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(own <= F.array_min(F.array(*reach)) + 1e-9, 1)).alias("n_nearest"))


PANEL_FITS = """panel AS (SELECT n_name AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
aged AS (SELECT *, date - DATE '1995-01-01' AS t FROM panel),
held AS (SELECT min(date) AS d FROM (SELECT DISTINCT date FROM panel ORDER BY date DESC LIMIT 6)),
before AS (SELECT regr_slope(value, t) AS b, regr_intercept(value, t) AS a FROM aged WHERE date < (SELECT d FROM held)),
every AS (SELECT regr_slope(value, t) AS b, regr_intercept(value, t) AS a FROM aged),
reach AS (SELECT id, 1.959964 * sqrt(2 * sum((value - a - b * t) ** 2) / (2 * count(*) - 1)) AS w FROM aged, before WHERE date >= (SELECT d FROM held) GROUP BY id),
ahead AS (SELECT id, CAST(max(date) + to_months(CAST(h AS INT)) AS DATE) AS date FROM panel, range(1, 7) x(h) GROUP BY id, h)"""


def panel_study(spark: SparkSession, root: str, design: Design, learner) -> DataFrame:
    """One model for all series: held out, calibrated per series, refitted on everything, half a year ahead.

    Returns a forecast table: the actual rows and the predictions with an interval of each series' own width.
    """
    aged = lambda df: df.withColumns(
        {"t": F.datediff("date", F.to_date(F.lit("1995-01-01"))).cast("double"), "month": F.month("date").cast("double")}
    )
    panel = kept(aged(nation_monthly(spark, root)))
    split = splits.time_split(panel, "date", 6)
    named = lambda df: df.select(F.lit(1).alias("model_id"), F.lit("global").alias("model_desc"), "*")
    tested = named(models.predict(models.fit(design, learner, splits.training(split)), splits.testing(split), ["id", "date", "value"]))
    future = aged(calendar.future_rows(panel.select("id", "date"), ["id"], "date", 6, "month"))
    ahead = named(models.predict(models.fit(design, learner, panel), future, ["id", "date"]))
    calibrated = forecasts.calibrate(tested, "value")
    return forecasts.forecast_table(panel, ahead, calibrated, "id", "date", "value", digits=1)


@query(
    "study_panel_line",
    f"""WITH {PANEL_FITS} SELECT 1 AS model_id, 'global' AS model_desc, 'prediction' AS key, id, date AS index, round(p, 1) AS value, round(p - w, 1) AS conf_lo, round(p + w, 1) AS conf_hi
FROM (SELECT id, date, a + b * (date - DATE '1995-01-01') AS p FROM ahead, every) JOIN reach USING (id)
UNION ALL SELECT NULL, 'ACTUAL', 'actual', id, date, round(value, 1), NULL, NULL FROM panel""",
)
def study_panel_line(spark: SparkSession, root: str) -> DataFrame:
    """The panel study with a least-squares line through all series."""
    return panel_study(spark, root, Design("value", ("t",)), models.linear())


@query("study_panel")
def study_panel(spark: SparkSession, root: str) -> DataFrame:
    """The panel study with boosted trees, the series' ids in hashed slots."""
    return panel_study(spark, root, Design("value", ("t", "month"), hashed=("id",), slots=64), models.boosted(trees=30, depth=4))
