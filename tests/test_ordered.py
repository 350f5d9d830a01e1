"""Order statistics against brute force, with a group that holds most rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalframe.operators import features, metrics, ordered, splits


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        g = "hot" if rng.random() < 0.6 else rng.choice("abcd")
        v = 0.0 if rng.random() < 0.3 else round(rng.gauss(0, 50), rng.choice([0, 3]))
        rows.append((i, g, v))
    return rows


def test_quantiles(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, g string, v double")
    probs = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.77, "q4": 1.0}
    got = {r["g"]: r for r in ordered.exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in {r[1] for r in skewed}:
        vals = [r[2] for r in skewed if r[1] == g]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(vals, p), abs=1e-9)


def test_group_names_do_not_clash(spark, skewed):
    names = ["n", "at", "what", "part"]
    df = spark.createDataFrame(skewed, "k long, g string, v double").select(*[F.col("g").alias(n) for n in names], "v")
    rows = ordered.exact_quantiles(df, names, "v", {"m": 0.5}).collect()
    want = np.median([r[2] for r in skewed if r[1] == "hot"])
    assert [r["m"] for r in rows if r["at"] == "hot"] == [pytest.approx(want)]


def test_quantiles_of_the_whole_and_of_nothing(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, g string, v double")
    row = ordered.exact_quantiles(df, [], "v", {"m": 0.5}).first()
    assert row["m"] == pytest.approx(np.median([r[2] for r in skewed]))
    empty = ordered.exact_quantiles(df.where("v > 1e9"), ["g"], "v", {"m": 0.5})
    assert empty.count() == 0


@pytest.mark.parametrize("col", ["k", "name"])
def test_row_index(spark, skewed, col):
    df = spark.createDataFrame(skewed, "k long, g string, v double").withColumn(
        "name", F.concat("g", F.lit("-same-prefix-"), F.lpad(F.col("k").cast("string"), 5, "0"))
    )
    rows = ordered.row_index(df, col).orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(1, len(skewed) + 1))
    assert [r[col] for r in rows] == sorted(r[col] for r in rows)


def test_level_code_of_text(spark):
    words = ["b", "a", "é", "a", "zz", "z", "", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"]: r["code"] for r in features.level_code(df, "w", "code").collect()}
    levels = sorted({w for w in words if w is not None}, key=lambda w: w.encode())
    assert got == {**{w: i + 1 for i, w in enumerate(levels)}, None: None}


def test_auc_with_ties(spark, skewed):
    rows = [(1 if r[1] == "hot" else 0, round(r[2], 0)) for r in skewed]
    df = spark.createDataFrame(rows, "t int, s double")
    pos, neg = [s for t, s in rows if t], [s for t, s in rows if not t]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert metrics.roc_auc(df, "t", "s").first()["auc"] == pytest.approx(wins / len(pos) / len(neg))
    other = metrics.roc_auc(df, "t", "s", event=0).first()["auc"]
    assert other == pytest.approx(1 - wins / len(pos) / len(neg))


def test_roc_curve_ends(spark, skewed):
    df = spark.createDataFrame([(int(r[1] == "hot"), r[2]) for r in skewed], "t int, s double")
    curve = metrics.roc_curve(df, "t", "s").orderBy(F.col("threshold").desc()).collect()
    assert curve[-1]["sensitivity"] == 1.0 and curve[-1]["specificity"] == 0.0
    sens = [r["sensitivity"] for r in curve]
    assert sens == sorted(sens)


@pytest.mark.parametrize("prop", [0.0, 0.31, 0.8, 1.0])
def test_random_split_is_exact(spark, skewed, prop):
    df = spark.createDataFrame(skewed, "k long, g string, v double")
    once = {r["k"]: r["role"] for r in splits.random_split(df, "k", prop, ["g"], seed=5).collect()}
    again = {r["k"]: r["role"] for r in splits.random_split(df.repartition(3), "k", prop, ["g"], seed=5).collect()}
    assert once == again and len(once) == len(skewed)
    for g in {r[1] for r in skewed}:
        keys = [r[0] for r in skewed if r[1] == g]
        assert sum(once[k] == "training" for k in keys) == int(len(keys) * prop)


def test_folds_are_even_and_exhaustive(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, g string, v double")
    rows = splits.folds(df, "k", 7, ["g"]).collect()
    assert sorted(r["k"] for r in rows) == [r[0] for r in skewed]
    for g in {r[1] for r in skewed}:
        sizes = [sum(r["fold"] == f and r["g"] == g for r in rows) for f in range(7)]
        assert max(sizes) - min(sizes) <= 1 and all(sizes)


def test_folds_of_few_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k long, g string")
    rows = splits.folds(df, "k", 5, ["g"]).collect()
    assert sorted(r["fold"] for r in rows if r["g"] == "a") == [0, 1]


def test_split_by_id_keeps_ids_whole(spark, skewed):
    df = spark.createDataFrame([(r[0] % 101, r[2]) for r in skewed], "id long, v double")
    rows = splits.split_by_id(df, "id", 0.8).collect()
    train = {r["id"] for r in rows if r["role"] == "training"}
    test = {r["id"] for r in rows if r["role"] == "testing"}
    assert not train & test and len(train) == round(0.8 * 101) and len(rows) == len(skewed)


def test_sample_has_no_repeats(spark, skewed):
    df = spark.createDataFrame(skewed, "k long, g string, v double")
    rows = splits.sample_rows(df, "k", 50).collect()
    assert len({r["k"] for r in rows}) == 50
    assert splits.sample_rows(df, "k", 10_000).count() == len(skewed)


@pytest.mark.parametrize("largest", [False, True])
def test_slice_extreme_keeps_ties(spark, skewed, largest):
    df = spark.createDataFrame([(r[0], r[1], round(r[2] / 40)) for r in skewed], "k long, g string, v long")
    rows = ordered.slice_extreme(df.repartition(7), ["g"], "v", largest).collect()
    want = set()
    for g in {r[1] for r in skewed}:
        vals = [(r[0], round(r[2] / 40)) for r in skewed if r[1] == g]
        best = (max if largest else min)(v for _, v in vals)
        want |= {k for k, v in vals if v == best}
    assert {r["k"] for r in rows} == want and len(rows) == len(want)
