"""Races, stacks, searches under a budget, early stopping, Tweedie boosting, permutation importance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import metrics, models, shape, splits, tuning, tweedieboost
from tidalframe.operators.models import Design
from tidalframe.plans.closed import _net, lines
from tidalframe.plans.customers import rfm_table
from tidalframe.plans.inputs import kept, labelled
from tidalframe.plans.learners import FLAG, RFM, SPEND, nation_days
from tidalframe.plans.registry import query
from tidalframe.session import cut_lineage
from tidalframe.sources.tables import table

FOLDS = 5
LINE = Design("l_extendedprice", ("l_quantity",))
RACED = (0.0, 4000.0, 9000.0, 16000.0, 30000.0, 60000.0)


def _anova_step(n: int, before: str) -> str:
    """One elimination after ``n`` folds among the candidates of ``before``; the t quantile comes from the freedom left."""
    return f"""x{n} AS (SELECT candidate, k, rmse AS v FROM errors WHERE k < {n} AND candidate IN (SELECT candidate FROM {before})),
e{n} AS (SELECT candidate, k, v, avg(v) OVER (PARTITION BY candidate) AS own, avg(v) OVER (PARTITION BY k) AS fold, avg(v) OVER () AS grand FROM x{n}),
s{n} AS (SELECT count(DISTINCT candidate) AS c, min(own) AS best, sum((v - own - fold + grand) ** 2) AS rest FROM e{n}),
alive{n} AS (SELECT DISTINCT candidate FROM e{n}, s{n} JOIN quantiles ON freedom = (c - 1) * {n - 1} WHERE own - best - t * sqrt(2 * rest / ((c - 1) * {n - 1}) / {n}) <= 0
  UNION SELECT candidate FROM e{n}, s{n} WHERE c = 1)"""


def _quantiles() -> str:
    from tidalframe.functions.quantiles import t_quantile

    wanted = sorted({(c - 1) * (n - 1) for c in range(2, len(RACED) + 1) for n in (3, 4, 5)})
    return "quantiles AS (SELECT * FROM (VALUES " + ", ".join(f"({d}, {t_quantile(0.975, d)}::DOUBLE)" for d in wanted) + ") q(freedom, t))"


@query(
    "tun_race_anova",
    f"WITH folds AS (SELECT * FROM range({FOLDS}) t(k)), fits AS ("
    + " UNION ALL ".join(
        f"SELECT 'penalty {p}' AS candidate, k, b, my - b * mx AS a FROM (SELECT k, {_net(p, 0.5)} AS b, avg(l_extendedprice) AS my, avg(l_quantity) AS mx FROM lineitem, folds WHERE l_orderkey % {FOLDS} <> k GROUP BY k)"
        for p in RACED
    )
    + f"""), errors AS (SELECT candidate, k, sqrt(avg((l_extendedprice - a - b * l_quantity) ** 2)) AS rmse FROM lineitem JOIN fits ON l_orderkey % {FOLDS} = k GROUP BY 1, 2),
{_quantiles()}, every AS (SELECT DISTINCT candidate FROM errors), {_anova_step(3, "every")}, {_anova_step(4, "alive3")}, {_anova_step(5, "alive4")},
ran AS (SELECT candidate, CASE WHEN candidate NOT IN (SELECT candidate FROM alive3) THEN 3 WHEN candidate NOT IN (SELECT candidate FROM alive4) THEN 4 ELSE 5 END AS n_folds,
  candidate NOT IN (SELECT candidate FROM alive5) AS dropped FROM every)
SELECT candidate, CAST(n_folds AS INT) AS n_folds, round(avg(rmse), 1) AS mean, dropped FROM ran JOIN errors USING (candidate) WHERE k < n_folds GROUP BY ALL""",
)
def tun_race_anova(spark: SparkSession, root: str) -> DataFrame:
    """Elastic nets raced over five folds: after three folds those clearly behind leave, by analysis of variance."""
    rows = lines(spark, root).withColumn("fold", (F.col("l_orderkey") % FOLDS).cast("int"))
    learners = [(f"penalty {p}", LINE, models.elastic_net(p, 0.5)) for p in RACED]
    error = lambda scored: scored.agg(metrics.rmse("l_extendedprice", "prediction"))
    race, _ = tuning.race_learners(rows, learners, ["l_extendedprice"], FOLDS, error)
    return race.withColumn("mean", F.round("mean", 1))


def grids() -> list[tuning.Candidate]:
    """Five nets, five forests and five boosters on the customers' features."""
    nets = [(f"net {p}", FLAG, models.logistic(p, 0.5)) for p in (0.0, 0.003, 0.01, 0.03, 0.1)]
    forests = [(f"forest {m} {n}", FLAG, models.forest(trees=40, mtry=str(m), min_n=n, depth=5)) for m, n in ((1, 2), (2, 2), (2, 20), (3, 8), (4, 40))]
    boosters = [(f"boosted {r} {n}", FLAG, models.boosted("classification", trees=20, learn_rate=r, min_n=n, depth=3)) for r, n in ((0.02, 10), (0.05, 20), (0.1, 5), (0.2, 40), (0.4, 20))]
    return [*nets, *forests, *boosters]


def flagged(spark: SparkSession, root: str) -> DataFrame:
    return cut_lineage(splits.random_split(kept(rfm_table(spark, root)), "customer_id", 0.8, ["spend_90_flag"]))


@query("tun_grid_trees")
def tun_grid_trees(spark: SparkSession, root: str) -> DataFrame:
    """Grids of five forests and five boosters over five stratified folds, ranked by area under the curve."""
    rows = cut_lineage(splits.folds(splits.training(flagged(spark, root)), "customer_id", FOLDS, ["spend_90_flag"]))
    oof = tuning.out_of_fold(rows, grids()[5:], ["customer_id", "spend_90_flag"], FOLDS)
    auc = metrics.roc_auc(cut_lineage(oof), "spend_90_flag", "pred_prob", 1, ["candidate", "fold"])
    return tuning.rank_results(tuning.summarise_folds(auc, "auc"), largest=True)


PENALTIES = (1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1)


@query("ens_stack_path")
def ens_stack_path(spark: SparkSession, root: str) -> DataFrame:
    """Fifteen candidates stacked: weights at the penalty the folds choose, members refitted, area under the curve of each and of the blend."""
    rows = flagged(spark, root)
    train = cut_lineage(splits.folds(splits.training(rows), "customer_id", FOLDS, ["spend_90_flag"]))
    candidates = grids()
    oof = cut_lineage(tuning.out_of_fold(train, candidates, ["customer_id", "spend_90_flag"], FOLDS))
    names = {name: f"m{k}" for k, (name, _, _) in enumerate(candidates)}
    short = oof.replace(names, subset=["candidate"])
    wide = shape.wider(short, ["customer_id", "spend_90_flag", "fold"], "candidate", "pred_prob", list(names.values()))
    weights, penalty, _ = tuning.stack_path(wide, list(names.values()), "spend_90_flag", PENALTIES)
    members = tuning.fit_members(train, candidates, {name: weights[m] for name, m in names.items()})
    scored = splits.testing(rows).select("customer_id", "spend_90_flag", *RFM)
    for name, model in members.items():
        keep = ["customer_id", "spend_90_flag", *RFM, *[m for m in names.values() if m in scored.columns]]
        scored = models.predict(model, scored, keep).drop("pred_class").withColumnRenamed("pred_prob", names[name])
    scored = tuning.blend(scored, weights)
    used = [names[name] for name in members]
    long = shape.longer(cut_lineage(scored.select("customer_id", "spend_90_flag", *used, "blend")), ["customer_id", "spend_90_flag"], [*used, "blend"], "model", "score")
    auc = metrics.roc_auc(long, "spend_90_flag", "score", 1, ["model"])
    back = [(name, m, weights[m], penalty) for name, m in names.items() if weights[m] > 0] + [("blend", "blend", 1.0, penalty)]
    return auc.join(spark.createDataFrame(back, "candidate string, model string, weight double, penalty double"), "model").drop("model")


def _two(sums: str, by: str) -> str:
    """Non-negative lasso weights of two members, in closed form: both, one or none above 0, by the least objective."""
    return f"""(SELECT *, CASE WHEN b1 > 0 AND b2 > 0 THEN b1 WHEN s1 * (c1 - p) <= s2 * (c2 - p) THEN 0 ELSE s1 END AS w1,
  CASE WHEN b1 > 0 AND b2 > 0 THEN b2 WHEN s1 * (c1 - p) <= s2 * (c2 - p) THEN s2 ELSE 0 END AS w2
  FROM (SELECT *, (g22 * (c1 - p) - g12 * (c2 - p)) / (g11 * g22 - g12 * g12) AS b1, (g11 * (c2 - p) - g12 * (c1 - p)) / (g11 * g22 - g12 * g12) AS b2,
    greatest(0, (c1 - p) / g11) AS s1, greatest(0, (c2 - p) / g22) AS s2
    FROM (SELECT {by}, sum(n) AS n, sum(a11) / sum(n) AS g11, sum(a12) / sum(n) AS g12, sum(a22) / sum(n) AS g22, sum(a1y) / sum(n) AS c1, sum(a2y) / sum(n) AS c2 FROM {sums}), grid))"""


@query(
    "ens_weights_two",
    f"""WITH d AS (SELECT doc_id % 3 AS fold, quality AS y, least(n_chars / 4000.0, 1)::DOUBLE AS x1, CASE WHEN lang = 'en' THEN 0.9 ELSE 0.6 END::DOUBLE AS x2 FROM documents JOIN labels USING (doc_id)),
grid AS (SELECT unnest([{', '.join(f'{p}::DOUBLE' for p in PENALTIES)}]) AS p),
sums AS (SELECT fold, count(*) AS n, sum(x1 * x1) AS a11, sum(x1 * x2) AS a12, sum(x2 * x2) AS a22, sum(x1 * y) AS a1y, sum(x2 * y) AS a2y, sum(y * y)::DOUBLE AS ayy FROM d GROUP BY 1),
others AS (SELECT h.fold AS held, s.* FROM sums h JOIN sums s ON s.fold <> h.fold),
trained AS {_two("others GROUP BY held", "held AS fold")},
scored AS (SELECT t.p, (s.ayy - 2 * (w1 * s.a1y + w2 * s.a2y) + w1 * w1 * s.a11 + 2 * w1 * w2 * s.a12 + w2 * w2 * s.a22) / s.n AS mse FROM trained t JOIN sums s USING (fold)),
chosen AS (SELECT p FROM scored GROUP BY p ORDER BY avg(mse), p DESC LIMIT 1),
final AS {_two("sums", "0 AS zero")}
SELECT round(w1, 6) AS w1, round(w2, 6) AS w2, p AS penalty FROM final WHERE p = (SELECT p FROM chosen)""",
)
def ens_weights_two(spark: SparkSession, root: str) -> DataFrame:
    """Two scores of the labelled documents stacked, the penalty chosen over three folds."""
    rows = labelled(spark, root).select(
        (F.col("doc_id") % 3).alias("fold"),
        "quality",
        F.least(F.col("n_chars") / 4000.0, F.lit(1.0)).alias("x1"),
        F.when(F.col("lang") == "en", 0.9).otherwise(0.6).alias("x2"),
    )
    weights, penalty, _ = tuning.stack_path(rows, ["x1", "x2"], "quality", PENALTIES)
    return spark.createDataFrame([(round(weights["x1"], 6), round(weights["x2"], 6), penalty)], "w1 double, w2 double, penalty double")


@query("mod_halving")
def mod_halving(spark: SparkSession, root: str) -> DataFrame:
    """Nine regressions of spend searched by successive halving, at most fourteen fits: every fit a row, ranked."""
    rows = kept(rfm_table(spark, root))
    nets = [(f"net {p}", SPEND, models.elastic_net(p, 0.5)) for p in (0.0, 100.0, 10_000.0)]
    forests = [(f"forest {n}", SPEND, models.forest("regression", trees=30, min_n=n, depth=5)) for n in (1, 10, 50)]
    boosters = [(f"boosted {r}", SPEND, models.boosted(trees=20, learn_rate=r, depth=3)) for r in (0.05, 0.1, 0.3)]
    error = lambda scored: scored.agg(metrics.rmse("spend_90_total", "prediction"))
    return tuning.halving(rows, "customer_id", [*nets, *forests, *boosters], error, fits=14)


@query("mod_gbt_stop")
def mod_gbt_stop(spark: SparkSession, root: str) -> DataFrame:
    """Boosted trees, 500 at most, that stop when the error of held-out customers stops falling: their curve."""
    rows = flagged(spark, root).withColumn("held", F.pmod(F.xxhash64(F.lit(3), "customer_id"), F.lit(5)) == 0)
    train = cut_lineage(splits.training(rows))
    model = models.fit(SPEND, models.boosted(trees=500, learn_rate=0.1, depth=3, stop="held"), train)
    curve = models.learning_curve(model, {"fitted": train.where("NOT held"), "validation": train.where("held"), "testing": splits.testing(rows)})
    return curve.withColumn("chosen", F.lit(model.stages[-1].getNumTrees))


@query(
    "mod_permutation",
    """WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
named AS (SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS name FROM lineitem),
taking AS (SELECT row_number() OVER (ORDER BY name, l_quantity, l_extendedprice) AS place, l_extendedprice AS y, l_quantity AS q FROM named),
given AS (SELECT row_number() OVER (ORDER BY md5(name || '#1')) AS place, l_quantity AS q FROM named),
scored AS (SELECT y, a + b * t.q AS e, a + b * g.q AS d FROM taking t JOIN given g USING (place), fit),
base AS (SELECT sqrt(avg((y - e) ** 2)) AS rmse, sqrt(avg((y - d) ** 2)) AS dealt FROM scored)
SELECT 'l_quantity' AS feature, round(dealt, 3) AS error, round(dealt - rmse, 3) AS importance FROM base
UNION ALL SELECT 'l_tax', round(rmse, 3), 0.0 FROM base""",
)
def mod_permutation(spark: SparkSession, root: str) -> DataFrame:
    """How much the error of a line grows when its feature, and one it does not have, is dealt anew."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, root, "lineitem").select(*key, "l_quantity", "l_tax", "l_extendedprice")
    model = models.fit(LINE, models.linear(), rows)
    found = models.permutation_importance(model, rows, key, ["l_quantity", "l_tax"], "l_extendedprice", metrics.rmse)
    return found.select("feature", F.round("error", 3).alias("error"), F.round("importance", 3).alias("importance"))


SPENDERS = """spenders AS (SELECT c_custkey, c_nationkey::DOUBLE AS nation, coalesce(sum(CASE WHEN o_custkey % 3 <> 0 THEN o_totalprice END), 0)::DOUBLE AS spend
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query(
    "mod_tweedie_first",
    f"""WITH {SPENDERS}, cuts AS (SELECT DISTINCT nation AS cut FROM spenders), mean AS (SELECT avg(spend) AS m FROM spenders),
sides AS (SELECT cut, sum(spend - m) FILTER (nation <= cut) AS gl, count(*) FILTER (nation <= cut) AS nl, sum(spend - m) FILTER (nation > cut) AS gr, count(*) FILTER (nation > cut) AS nr, any_value(m) AS m
  FROM spenders, cuts, mean GROUP BY cut),
best AS (SELECT * FROM sides WHERE nr > 0 ORDER BY gl * gl / nl + gr * gr / nr DESC, cut LIMIT 1)
SELECT nation <= cut AS low, count(*) AS n, round(avg(spend), 2) AS prediction FROM spenders, best GROUP BY 1""",
)
def mod_tweedie_first(spark: SparkSession, root: str) -> DataFrame:
    """The first round of Tweedie boosting, one split: each leaf predicts the mean of its customers' spend."""
    spend = F.coalesce(F.sum(F.when(F.col("o_custkey") % 3 != 0, F.col("o_totalprice"))), F.lit(0.0))
    people = table(spark, root, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("nation"))
    orders = table(spark, root, "orders").select("o_custkey", "o_totalprice")
    rows = kept(people.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey", "nation").agg(spend.alias("spend")))
    model = tweedieboost.fit(Design("spend", ("nation",)), rows, trees=1, learn_rate=1.0, depth=1)
    scored = model.predict(rows, ["nation"]).withColumn("prediction", F.round("prediction", 2))
    least = scored.agg(F.min_by("prediction", "nation").alias("first")).first()[0]
    return scored.groupBy((F.col("prediction") == F.lit(least)).alias("low")).agg(F.count(F.lit(1)).alias("n"), F.first("prediction").alias("prediction"))


@query("mod_tweedie_boost")
def mod_tweedie_boost(spark: SparkSession, root: str) -> DataFrame:
    """Boosted trees with Tweedie loss on daily spend with many zeros, the nations in hashed slots: the held-out days."""
    rows = splits.time_split(kept(nation_days(spark, root)), "date", 28)
    design = Design("value", ("year", "month", "mday", "wday", "yday"), hashed=("id",), slots=64)
    model = tweedieboost.fit(design, cut_lineage(splits.training(rows)), trees=30, learn_rate=0.3, depth=4)
    scored = model.predict(splits.testing(rows), ["id", "date", "value"])
    return scored.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean_actual"),
        F.avg("prediction").alias("mean_prediction"),
        F.avg(tweedieboost.deviance(F.col("value"), F.log("prediction"), 1.5)).alias("deviance"),
    )
