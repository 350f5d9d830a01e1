"""Tweedie boosting, races, stacks, searches, early stopping, permutation, correlation in two passes."""

from __future__ import annotations

import math
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalframe.operators import aggregates, metrics, models, ordered, tuning, tweedieboost
from tidalframe.operators.models import Design
from tidalframe.session import cut_by


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    out = []
    for i in range(500):
        x, z, c = rng.random(), rng.random(), rng.choice("abc")
        y = 2 + 3 * x - z + (1 if c == "b" else 0) + rng.gauss(0, 0.3)
        spend = 0.0 if rng.random() < 0.6 else 100 * rng.random() * (1 + 4 * (x > 0.5))
        out.append((i, x, z, c, y, int(y > 3.2), i % 5, spend))
    return spark.createDataFrame(out, "k int, x double, z double, c string, y double, flag int, fold int, spend double").cache()


SPEND = Design("spend", ("x", "z"), hashed=("c",), slots=8)


def test_the_deviance_falls_every_round(rows):
    model = tweedieboost.fit(SPEND, rows, trees=12, learn_rate=0.3, depth=2)
    falls = [d for _, d, _ in model.log]
    assert len(falls) > 3 and all(a > b for a, b in zip(falls, falls[1:], strict=False))
    scored = model.predict(rows, ["x", "spend"])
    again = scored.agg(F.avg(tweedieboost.deviance(F.col("spend"), F.log("prediction"), 1.5))).first()[0]
    assert again == pytest.approx(falls[-1])
    means = {r["big"]: (r["a"], r["p"]) for r in scored.groupBy((F.col("x") > 0.5).alias("big")).agg(F.avg("spend").alias("a"), F.avg("prediction").alias("p")).collect()}
    assert all(p == pytest.approx(a, rel=0.35) for a, p in means.values())


def test_first_leaves_are_means_and_zeros_have_a_leaf(spark):
    df = spark.createDataFrame([(float(k % 2), 0.0 if k % 2 else float(k)) for k in range(40)], "x double, y double")
    model = tweedieboost.fit(Design("y", ("x",)), df, trees=1, learn_rate=1.0, depth=1)
    got = {r["x"]: r["prediction"] for r in model.predict(df, ["x"]).distinct().collect()}
    assert got[0.0] == pytest.approx(19.0) and 0 < got[1.0] < 1
    for bad in (df.withColumn("y", -F.col("x")), df.withColumn("y", F.lit(0.0)), df.limit(0)):
        with pytest.raises(ValueError):
            tweedieboost.fit(Design("y", ("x",)), bad)


# Races


def test_candidates_behind_against_plain_analysis():
    scores = {"a": [1.0, 2.0, 3.0], "b": [1.1, 2.0, 3.1], "c": [3.0, 4.1, 5.0]}
    assert tuning.behind(scores) == {"c"} and tuning.behind({"a": [1.0, 2.0]}) == set()
    x = np.array([scores[n] for n in "abc"])
    rest = x - x.mean(1, keepdims=True) - x.mean(0) + x.mean()
    s = math.sqrt((rest**2).sum() / 4 * 2 / 3)
    assert x[2].mean() - x[0].mean() > 2.776445 * s > x[1].mean() - x[0].mean()


def test_a_race_of_learners_drops_the_worse(rows):
    design = Design("y", ("x", "z"), ("c",))
    racers = [("line", design, models.linear()), ("shrunk", design, models.elastic_net(50.0, 0.0)), ("near", design, models.elastic_net(1e-4, 0.5))]
    error = lambda scored: scored.agg(metrics.rmse("y", "prediction"))
    table, errors = tuning.race_learners(rows, racers, ["k", "y"], 5, error)
    got = {r["candidate"]: r for r in table.collect()}
    assert got["shrunk"]["dropped"] and got["shrunk"]["n_folds"] == 3
    assert not got["line"]["dropped"] and got["line"]["n_folds"] == 5
    by_hand = tuning.out_of_fold(rows, racers[:1], ["k", "y"], 5).groupBy("fold").agg(metrics.rmse("y", "prediction").alias("e"))
    want = {r["fold"]: r["e"] for r in by_hand.collect()}
    assert {r["fold"]: r["error"] for r in errors.where("candidate = 'line'").collect()} == pytest.approx(want)


# Stacks


def test_weights_meet_the_conditions_of_a_minimum():
    rng = np.random.default_rng(3)
    for _ in range(30):
        k = int(rng.integers(1, 16))
        x = rng.random((200, k))
        y = x @ np.maximum(0, rng.normal(size=k)) + rng.normal(size=200) * 0.2
        full = np.column_stack([x, y])
        gram, penalty = full.T @ full / 200, float(10 ** rng.uniform(-5, 0))
        w = tuning.nonnegative_lasso(gram, np.zeros(k), penalty)
        slope = gram[:-1, -1] - gram[:-1, :-1] @ w - penalty
        assert (w >= 0).all() and (slope <= 1e-7).all() and np.abs(slope[w > 0]).max(initial=0) < 1e-7


def test_weights_of_members_that_say_nearly_the_same():
    """Members a hair apart, one that is the sum of two others and constant ones: slopes still end at 0."""
    rng = np.random.default_rng(5)
    for apart in (1e-3, 1e-5, 1e-8, 0.0):
        base = rng.random((400, 3))
        near = base[:, :1] + apart * rng.normal(size=(400, 6))
        x = np.column_stack([base, near, base[:, 0] + base[:, 1], np.full((400, 2), 0.5), np.zeros(400)])
        full = np.column_stack([x, (base[:, 0] + rng.normal(size=400) * 0.3 > 0.5).astype(float)])
        gram = full.T @ full / 400
        for penalty in (1e-1, 1e-3, 1e-6):
            w = tuning.nonnegative_lasso(gram, np.zeros(x.shape[1]), penalty)
            slope = gram[:-1, -1] - gram[:-1, :-1] @ w - penalty
            assert (w >= 0).all() and slope.max() < 1e-6 and np.abs(slope[w > 0]).max(initial=0) < 1e-6


def test_a_path_chooses_the_penalty_of_the_least_error(spark):
    rng = np.random.default_rng(8)
    t = rng.integers(0, 2, 300)
    x = np.column_stack([np.clip(t * 0.6 + 0.2 + rng.normal(0, 0.2, 300), 0, 1), rng.random(300), np.full(300, 0.5)])
    df = spark.createDataFrame([(int(t[k]), *map(float, x[k]), k % 3) for k in range(300)], "t int, good double, noise double, same double, fold int")
    names, penalties = ["good", "noise", "same"], [1e-5, 1e-3, 1e-1, 10.0]
    weights, chosen, table = tuning.stack_path(df, names, "t", penalties)
    fold, full = np.arange(300) % 3, np.column_stack([x, t]).astype(float)
    mse = {}
    for p in penalties:
        errors = []
        for i in range(3):
            train, test = full[fold != i], full[fold == i]
            w = tuning.nonnegative_lasso(train.T @ train / len(train), np.zeros(3), p)
            errors.append(((test[:, -1] - test[:, :-1] @ w) ** 2).mean())
        mse[p] = np.mean(errors)
    assert chosen == min(mse, key=mse.get) and {r["penalty"]: r["mse"] for r in table.collect()} == pytest.approx(mse)
    assert weights["good"] > 0.5 and weights["good"] > 5 * weights["noise"]


def test_members_without_weight_are_not_fitted(rows):
    candidates = [("a", Design("y", ("x",)), models.linear()), ("b", Design("y", ("z",)), models.linear())]
    assert set(tuning.fit_members(rows, candidates, {"a": 0.7, "b": 0.0})) == {"a"}


# Searches


def racing(rows):
    design = Design("y", ("x", "z"), ("c",))
    return [(f"net {p}", design, models.elastic_net(p, 0.0)) for p in (0.0001, 0.1, 1.0, 20.0)]


def test_halving_is_the_same_for_a_counted_budget(rows):
    error = lambda scored: scored.agg(metrics.rmse("y", "prediction"))
    one = tuning.halving(rows, "k", racing(rows), error, eta=2, fits=7).collect()
    assert one == tuning.halving(rows, "k", racing(rows), error, eta=2, fits=7).collect()
    reached = [(r["rung"], r["candidate"]) for r in one]
    assert [r["share"] for r in one if r["rung"] == 0] == [0.25] * 4 and len(reached) == 7
    assert one[-1]["candidate"] == "net 0.0001" and one[-1]["share"] == 1.0 and {r["status"] for r in one} == {"done"}
    short = tuning.halving(rows, "k", racing(rows), error, eta=2, fits=3).collect()
    assert [r["status"] for r in short][:4] == ["done"] * 3 + ["out of budget"]


def test_halving_ends_at_its_deadline_and_lists_failures(rows):
    error = lambda scored: scored.agg(metrics.rmse("y", "prediction"))
    late = tuning.halving(rows, "k", racing(rows), error, seconds=0.0).collect()
    assert {r["status"] for r in late} == {"out of budget"} and len(late) == 4
    broken = [("broken", Design("y", ("missing",)), models.linear()), *racing(rows)[:1]]
    found = {r["candidate"]: r["status"] for r in tuning.halving(rows, "k", broken, error).where("rung = 0").collect()}
    assert found["broken"].startswith("failed") and found["net 0.0001"] == "done"


def test_trees_stop_when_the_validation_error_does_not_fall(rows):
    marked = rows.withColumn("held", F.col("fold") == 0)
    model = models.fit(Design("y", ("x", "z"), ("c",)), models.boosted(trees=300, learn_rate=0.3, depth=3, stop="held", fall=0.05), marked)
    kept = model.stages[-1].getNumTrees
    assert kept < 100
    curve = models.learning_curve(model, {"fitted": marked.where("NOT held"), "held": marked.where("held")}).collect()
    assert len(curve) == 2 * kept
    fitted = [r["error"] for r in curve if r["rows"] == "fitted"]
    assert all(a >= b - 1e-9 for a, b in zip(fitted, fitted[1:], strict=False))


def test_a_dealt_column_is_a_permutation_and_tells_what_matters(rows):
    dealt = models.shuffled(rows, ["k"], ["x", "c"]).collect()
    assert sorted(r["_s_x"] for r in dealt) == sorted(r["x"] for r in dealt) and sum(r["_s_x"] == r["x"] for r in dealt) < 10
    assert all(r["_s_c"] == {q["x"]: q["c"] for q in dealt}[r["_s_x"]] for r in dealt)
    model = models.fit(Design("y", ("x", "z"), ("c",)), models.linear(), rows)
    found = {r["feature"]: r["importance"] for r in models.permutation_importance(model, rows, ["k"], ["x", "z", "c", "spend"], "y", metrics.rmse).collect()}
    assert found["x"] > found["z"] > 0.05 and found["c"] > 0.05 and abs(found["spend"]) < 1e-12


def test_dealing_anew_moves_only_what_the_model_and_the_error_need(rows, monkeypatch):
    model = models.fit(Design("y", ("x", "z"), ("c",)), models.linear(), rows)
    assert models.inputs(model, ["k", "x", "z", "c", "spend"]) == ["x", "z", "c"]
    written, plain = [], ordered.cut_lineage
    monkeypatch.setattr(ordered, "cut_lineage", lambda df: written.append(set(df.columns)) or plain(df))
    models.permutation_importance(model, rows, ["k"], ["x"], "y", metrics.rmse).collect()
    assert written == [{"_s_x", "_at"}, {"x", "z", "c", "y", "_at"}]


def test_folds_are_read_by_folder(spark, rows):
    folded = rows.withColumn("fold", F.when(F.col("k") % 7 != 3, F.col("k") % 3).cast("int"))
    kept = cut_by(folded, "fold")
    assert kept.columns == folded.columns and sorted(map(str, kept.collect())) == sorted(map(str, folded.collect()))
    design = Design("y", ("x", "z"), ("c",))
    ready = tuning.prepared_folds(folded.where("fold IS NOT NULL"), [design], ["k"], 3)
    assert all("PartitionFilters: [isnotnull(fold" in part._jdf.queryExecution().toString() for part in ready[design, 1])
    assert [part.select("fold").distinct().count() for part in ready[design, 1]] == [2, 1]


def test_correlation_of_many_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 30)) * np.logspace(-3, 6, 30) + 1e6
    df = spark.createDataFrame(x.tolist(), [f"c{k}" for k in range(30)])
    got = {(r["x"], r["y"]): r["r"] for r in aggregates.correlation(df, df.columns).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 900
    for i, j in product(range(8, 30), repeat=2):
        assert got[f"c{i}", f"c{j}"] == pytest.approx(want[i, j], abs=2e-5)
    assert aggregates.correlation(df.limit(0), df.columns).count() == 0
