"""Properties of fits, tuning, stacking, customer value and streams."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalframe.operators import customers, forecasts, gammagamma, metrics, models, tuning
from tidalframe.operators.models import Design
from tidalframe.session import scratch


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    out = []
    for i in range(600):
        x, z, c = rng.random(), rng.random(), rng.choice("abc")
        y = 2 + 3 * x - z + (1 if c == "b" else 0)
        out.append((i, x, z, c, y, int(y > 3.2), i % 3))
    return spark.createDataFrame(out, "k int, x double, z double, c string, y double, flag int, fold int").cache()


DESIGN = Design("y", ("x", "z"), ("c",))
FLAG = Design("flag", ("x", "z"), ("c",))


def test_least_squares_recovers_truth(rows):
    model = models.fit(DESIGN, models.linear(), rows)
    err = models.predict(model, rows, ["y"]).agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert err < 1e-6


def test_learn_rate_beyond_one_is_an_error():
    assert models.boosted(learn_rate=1.0).getStepSize() == 1.0
    with pytest.raises(ValueError):
        models.boosted(learn_rate=2.0)


def test_thousands_of_series_share_hashed_slots(spark):
    rows = spark.range(40_000).selectExpr("concat('s', id % 20000) as id", "cast(id % 7 as double) as x", "cast(id % 7 + if(id % 2 = 0, 1, 0) as double) as y")
    design = Design("y", ("x",), hashed=("id",), slots=256)
    model = models.fit(design, models.linear(), rows)
    assert model.stages[-1].numFeatures == 257
    assert models.predict(model, rows, ["id"]).count() == 40_000


def test_more_trees_fit_better(rows):
    def err(trees):
        scored = models.predict(models.fit(DESIGN, models.boosted(trees=trees, depth=3), rows), rows, ["y"])
        return scored.agg(metrics.rmse("y", "prediction")).first()[0]

    assert err(8) < err(1)


def test_boosting_by_profile_grows_the_trees_of_all_rows(spark):
    rng = random.Random(8)
    held = [(rng.choice([0.0, 1.0, 2.5, 4.0]), rng.choice([0.1, 0.2, 0.3]), rng.choice(["a", "b", None])) for _ in range(40)]
    held = [(x, z, c, 2 * x - 9 * z + (c == "b") + rng.random()) for x, z, c in held * 50]
    rows = spark.createDataFrame(held, "x double, z double, c string, y double")
    learner = models.boosted(trees=6, depth=3, learn_rate=0.3)
    summed = models.profiles(DESIGN, learner, rows, "n").collect()
    assert len(summed) == len({h[:3] for h in held}) and sum(r["n"] for r in summed) == 2000
    plain, by = models.fit(DESIGN, learner, rows), models.fit(DESIGN, learner, rows, by_profile=True)
    both = models.predict(by, models.predict(plain, rows, [*rows.columns]).withColumnRenamed("prediction", "p"), ["p"])
    assert both.where(F.abs(F.col("p") - F.col("prediction")) > 1e-9).count() == 0
    for other in (models.boosted("classification"), models.boosted(min_n=2), models.boosted(stop="held"), models.forest("regression")):
        with pytest.raises(ValueError):
            models.profiles(DESIGN, other, rows, "n")
    with pytest.raises(Exception):
        models.fit(DESIGN, learner, rows.withColumn("y", F.when(F.col("x") > 3, None).otherwise(F.col("y"))), by_profile=True)


def test_new_level_is_scored(spark, rows):
    model = models.fit(DESIGN, models.linear(), rows)
    new = spark.createDataFrame([(1, 0.5, 0.5, "unseen")], "k int, x double, z double, c string")
    assert models.predict(model, new, ["k"]).count() == 1


def test_saved_model_scores_alike(spark, rows):
    model = models.fit(FLAG, models.logistic(0.01, 0.5), rows)
    again = models.load(models.save(model, scratch(spark, "test-model")))
    a = models.predict(model, rows, ["k"]).orderBy("k").collect()
    assert a == models.predict(again, rows, ["k"]).orderBy("k").collect()


def test_importance_names(spark, rows):
    model = models.fit(DESIGN, models.forest("regression", trees=5), rows)
    found = {r["feature"]: r["importance"] for r in models.importance(model, model.transform(rows), spark).collect()}
    assert max(found, key=found.get) == "x" and sum(found.values()) == pytest.approx(1)


def test_tweedie_mean_is_kept(spark):
    rng = random.Random(2)
    data = [(float(i % 7), 0.0 if rng.random() < 0.7 else 1000 * rng.random() * (1 + i % 7)) for i in range(700)]
    df = spark.createDataFrame(data, "x double, y double")
    model, unit = models.fit_in_means(Design("y", ("x",)), models.tweedie(1.5), df)
    row = models.predict(model, df, ["y"]).agg(F.avg("y"), F.avg("prediction") * unit, F.min("prediction")).first()
    assert row[1] == pytest.approx(row[0], rel=0.05) and row[2] > 0


def test_out_of_fold_covers_every_row_once(rows):
    candidates = [("a", FLAG, models.logistic()), ("b", FLAG, models.forest(trees=3, depth=2))]
    oof = tuning.out_of_fold(rows, candidates, ["k", "flag"], 3)
    assert oof.groupBy("candidate", "k").count().where("count <> 1").count() == 0
    assert oof.count() == 1200
    ranked = tuning.rank_results(
        tuning.summarise_folds(metrics.roc_auc(oof, "flag", "pred_prob", 1, ["candidate", "fold"]), "auc"), largest=True
    ).collect()
    assert {r["n"] for r in ranked} == {3} and {r["rank"] for r in ranked} == {1, 2}
    wide = oof.groupBy("k", "flag").pivot("candidate", ["a", "b"]).agg(F.max("pred_prob"))
    weights = tuning.stack_weights(wide, ["a", "b"], "flag", 0.001)
    assert all(w >= 0 for w in weights.values()) and sum(weights.values()) > 0
    blend = tuning.blend(wide, weights).agg(F.min("blend"), F.max("blend")).first()
    assert 0 <= blend[0] and blend[1] <= 1


def test_stack_drops_noise(spark):
    rng = random.Random(1)
    data = [(t, t * 0.8 + 0.1, rng.random()) for t in (rng.randint(0, 1) for _ in range(400))]
    df = spark.createDataFrame(data, "t int, good double, noise double")
    weights = tuning.stack_weights(df, ["good", "noise"], "t", 0.05)
    assert weights["noise"] == 0.0 and weights["good"] > 0.5


def test_race_drops_the_clearly_worse(spark):
    calls = []

    def evaluate(alive, i):
        calls.append(list(alive))
        data = [(c, {"good": 1.0, "fair": 1.01, "bad": 9.0}[c] + 0.01 * i * (c == "fair")) for c in alive]
        return spark.createDataFrame(data, "candidate string, metric double")

    out = {r["candidate"]: r for r in tuning.race(spark, ["good", "fair", "bad"], evaluate, 5).collect()}
    assert out["bad"]["dropped"] and out["bad"]["n_folds"] == 3 and not out["good"]["dropped"]
    assert "bad" not in calls[3]


def test_grid_and_cross():
    assert len(tuning.grid(a=[1, 2], b=[3, 4, 5])) == 6
    assert [c[0] for c in tuning.cross({"d": DESIGN}, {"m": models.linear(), "n": models.linear()})] == ["d_m", "d_n"]


def test_gamma_gamma_search(spark):
    rng = np.random.default_rng(3)
    data = []
    for _ in range(1500):
        n = int(rng.integers(1, 8))
        nu = rng.gamma(4.0, 1 / 20.0)
        data.append((n, float(rng.gamma(6.0 * n, 1 / (n * nu)))))
    df = spark.createDataFrame(data, "n long, z double").cache()
    guess = (6.0, 4.0, 20.0)
    by_hand = sum(gammagamma.log_likelihood(n, z, *guess) for n, z in data)
    assert gammagamma.score(df, "n", "z", [guess])[0] == pytest.approx(by_hand)
    p, q, gamma, value = gammagamma.fit(df, "n", "z")
    assert value >= by_hand
    moments = gammagamma.moments(df, "n", "z", gamma)
    gradient, curvature = gammagamma.slopes(moments, p, q, gamma)
    assert np.abs(gradient).max() <= 1e-6 * 1500 and np.linalg.eigvalsh(curvature).max() < 0
    at = np.log([p, q, gamma])
    for i in range(3):
        up, down = (at + d * np.eye(3)[i] for d in (1e-4, -1e-4))
        steep = [gammagamma.value(gammagamma.moments(df, "n", "z", float(np.exp(t[2]))), *np.exp(t)) for t in (up, down)]
        assert max(steep) <= value + 1e-6
    mean = customers.expected_spend(F.col("n"), F.col("z"), p, q, gamma)
    assert df.select(F.avg(mean)).first()[0] == pytest.approx(np.mean([z for _, z in data]), rel=0.1)


def test_interval_and_best(spark):
    data = [(1, "m", "a", 10.0, 8.0), (1, "m", "a", 10.0, 13.0), (2, "n", "a", 10.0, 10.5), (2, "n", "a", 10.0, 9.5)]
    df = spark.createDataFrame(data, "model_id int, model_desc string, id string, actual double, prediction double")
    reach = {r["model_id"]: r["_reach"] for r in forecasts.interval_width(forecasts.calibrate(df), ["model_id"], 0.95).collect()}
    assert reach[1] == pytest.approx(1.959964 * math.sqrt(2 * (4 + 9) / 3))
    acc = df.groupBy("model_id", "id").agg(metrics.rmse("actual", "prediction").alias("rmse"))
    assert [r["model_id"] for r in forecasts.best_by_series(acc, "id").collect()] == [2]


def test_metrics_without_a_denominator(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "t double, e double")
    row = df.agg(
        metrics.mape("t", "e").alias("mape"), metrics.rsq("t", "e").alias("rsq"), metrics.smape("t", "e").alias("smape")
    ).first()
    assert row["mape"] == 50.0 and row["rsq"] is None and row["smape"] == pytest.approx(100 * (2 + 1 / 1.5) / 2)


def test_first_last_cutoffs(spark):
    log = spark.createDataFrame(
        [(1, "2020-01-01", 5.0), (1, "2020-01-01", 7.0), (1, "2020-03-01", 6.0), (2, "2020-02-01", 1.0)],
        "id int, d string, m double",
    ).withColumn("d", F.to_date("d"))
    import datetime as dt

    rows = {r["id"]: r for r in customers.transaction_summary(log, "id", "d", "m", dt.date(2020, 4, 1)).collect()}
    assert (rows[1]["x"], rows[1]["t_x"], rows[1]["age"], rows[1]["mean_spend"]) == (1, 60, 91, 9.0)
    feats = customers.features_with_targets(log.where("d < '2020-02-15'"), log.where("d >= '2020-02-15'"), "id", "d", "m")
    got = {r["id"]: (r["recency"], r["frequency"], r["spend_90_total"], r["spend_90_flag"]) for r in feats.collect()}
    assert got == {1: (-31, 2, 6.0, 1), 2: (0, 1, 0.0, 0)}
