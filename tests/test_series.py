"""Every panel operator on null, one-row and failing series; boosted trees per series."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalframe.operators import aggregates, baselines, calendar, customers, forecasts, metrics, nested, ordered, perseries, recursive, seriestrees, splits, windows
from tidalframe.operators.seriestrees import Spec


def months(n):
    return [dt.date(2010 + k // 12, k % 12 + 1, 1) for k in range(n)]


SIZES = {"whole": 40, None: 38, "one": 1, "unknown": 12}


@pytest.fixture(scope="module")
def panel(spark):
    """A whole series, one without an id, one of one row, one whose values are all unknown."""
    rng = np.random.default_rng(4)
    rows = []
    for name, n in SIZES.items():
        rows += [(name, d, None if name == "unknown" else float(round(50 + 10 * (d.month > 6) + rng.normal(), 3))) for d in months(n)]
    return spark.createDataFrame(rows, "id string, date date, value double").cache()


def sizes(df):
    return {r["id"]: r["count"] for r in df.groupBy("id").count().collect()}


def trained(panel):
    return panel.withColumn("one", F.lit(1.0)).withColumn("month", F.month("date").cast("double"))


def line(panel):
    rows = trained(panel)
    fitted = perseries.solve(perseries.gram_sums(rows, "id", ["one", "month"], "value"), "id", ["one", "month"], {"line": 0.0})
    return perseries.predict(rows, fitted, "id", ["one", "month"])


def boosted(panel):
    rows = trained(panel)
    specs = {"small": Spec(trees=3)}
    return seriestrees.predict(rows, seriestrees.fit(rows, "id", "date", ["month"], "value", specs), "id", ["month"], specs)


def seasonal(panel):
    rows = baselines.steps_ahead(panel, ["id"], "date").withColumnRenamed("value", "actual")
    return baselines.seasonal_naive(panel, rows, ["id"], "date", "value", 12).withColumn("model_id", F.lit(1)).withColumn("model_desc", F.lit("m"))


def best(panel):
    accuracy = metrics.accuracy_table(seasonal(panel), ["model_id", "id"], "date")
    return forecasts.keep_best(seasonal(panel), forecasts.best_by_series(accuracy, "id"), "id")


KEEP_ALL = {
    "pad": lambda p: calendar.pad(p, ["id"], "date", "month"),
    "lags": lambda p: windows.add_lags(p, ["id"], "date", "value", [1], ["lag1"]),
    "clean": lambda p: windows.clean_series(p, ["id"], "date", "value", 12),
    "tail split": lambda p: splits.series_tail_split(p, ["id"], "date", 3),
    "time split": lambda p: splits.time_split(p, "date", 3),
    "tier": lambda p: nested.length_tier(p, "id", 9, 3),
    "line": line,
    "boosted": boosted,
    "seasonal": seasonal,
    "best": best,
    "window": lambda p: baselines.window_forecast(p, p.select("id", "date"), ["id"], "date", "value", 3),
    "forecast table": lambda p: forecasts.forecast_table(p.limit(0), seasonal(p), forecasts.calibrate(seasonal(p)), "id", "date", "value"),
}


@pytest.mark.parametrize("name", sorted(KEEP_ALL))
def test_no_series_loses_rows(panel, name):
    assert sizes(KEEP_ALL[name](panel)) == SIZES


def test_one_row_for_every_series(panel):
    nest = nested.nest(panel, "id", "date", "value", 2, "month").collect()
    assert {r["id"]: (len(r["actual"]), len(r["future"])) for r in nest} == {k: (n, 2) for k, n in SIZES.items()}
    assert sizes(calendar.future_rows(panel, ["id"], "date", 2, "month")) == dict.fromkeys(SIZES, 2)
    assert sizes(ordered.slice_extreme(panel.where("value IS NOT NULL"), ["id"], "value")) == {k: 1 for k in SIZES if k != "unknown"}
    assert sizes(ordered.slice_extreme(panel, ["id"], "date", largest=True)) == dict.fromkeys(SIZES, 1)
    assert sizes(ordered.top_rows(panel, ["id"], [F.col("date")], 1)) == dict.fromkeys(SIZES, 1)
    assert sizes(aggregates.series_diagnostics(panel, ["id"], "date")) == dict.fromkeys(SIZES, 1)
    assert sizes(recursive.tail_state(panel, "id", "date", "value", 12)) == dict.fromkeys(SIZES, 1)


def test_pad_keeps_values_and_rows_off_the_grid(spark):
    rows = [(None, dt.date(2020, 1, 1), 10.0), (None, dt.date(2020, 3, 1), 11.0), ("a", dt.date(2020, 1, 1), 1.0), ("a", dt.date(2020, 1, 15), 2.0), ("a", dt.date(2020, 2, 1), 3.0), ("a", None, 4.0)]
    got = calendar.pad(spark.createDataFrame(rows, "id string, date date, value double"), ["id"], "date", "month", 0.0).collect()
    held = sorted((r["id"] or "", r["date"] or dt.date(1, 1, 1), r["value"]) for r in got)
    assert held == [("", dt.date(2020, 1, 1), 10.0), ("", dt.date(2020, 2, 1), 0.0), ("", dt.date(2020, 3, 1), 11.0),
                    ("a", dt.date(1, 1, 1), 4.0), ("a", dt.date(2020, 1, 1), 1.0), ("a", dt.date(2020, 1, 15), 2.0), ("a", dt.date(2020, 2, 1), 3.0)]


def test_failing_series_say_why(panel):
    errors = {(r["id"], r["error"]) for r in boosted(panel).where("prediction IS NULL").select("id", "error").distinct().collect()}
    assert errors == {("one", "1 of 2 training rows"), ("unknown", "0 of 2 training rows")}
    errors = {r["id"] for r in line(panel).where("prediction IS NULL AND error IS NOT NULL").select("id").distinct().collect()}
    assert errors == {"one", "unknown"}


def test_customers_without_an_id_keep_their_targets(spark):
    log = spark.createDataFrame([(None, dt.date(2020, 1, 1), 5.0), (1, dt.date(2020, 1, 2), 7.0), (None, dt.date(2020, 3, 1), 6.0)], "id int, d date, m double")
    got = customers.features_with_targets(log.where("d < '2020-02-01'"), log.where("d >= '2020-02-01'"), "id", "d", "m").collect()
    assert {r["id"]: r["spend_90_total"] for r in got} == {None: 6.0, 1: 0.0}
    assert customers.cohort(log, "id", "d", dt.date(2020, 1, 1), dt.date(2020, 1, 1)).count() == 2


# Boosted trees


def plain_trees(x, y, spec):
    """Trees grown by trying every cut of every feature."""
    prediction = np.full(len(y), y.mean())
    for _ in range(spec.trees):
        rest, node = y - prediction, np.zeros(len(y), int)
        for _ in range(spec.depth):
            deeper = 2 * node
            for k in np.unique(node):
                mine, top = node == k, (1e-9, None)
                for f in range(x.shape[1]):
                    for cut in np.unique(x[mine, f])[:-1]:
                        low = mine & (x[:, f] <= cut)
                        high = mine & ~low
                        if min(low.sum(), high.sum()) < spec.min_n:
                            continue
                        gain = rest[low].sum() ** 2 / low.sum() + rest[high].sum() ** 2 / high.sum() - rest[mine].sum() ** 2 / mine.sum()
                        if gain > top[0] + 1e-9:
                            top = (gain, high)
                if top[1] is not None:
                    deeper[top[1]] += 1
            node = deeper
        for k in np.unique(node):
            prediction[node == k] += spec.learn_rate * rest[node == k].mean()
    return prediction


@pytest.mark.parametrize("spec", [Spec(trees=1, learn_rate=1.0, depth=1), Spec(trees=6, learn_rate=0.5, depth=2), Spec(trees=4, learn_rate=0.3, depth=3, min_n=3)])
def test_trees_of_every_series_against_plain_ones(spark, monkeypatch, spec):
    monkeypatch.setattr(seriestrees, "RUN_ROWS", 60)
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for name, n in (("a", 50), ("b", 31), (None, 40), ("c", 2), ("d", 120)):
        x = np.stack([rng.integers(0, 6, n), rng.normal(size=n).round(2)], 1)
        y = (3.0 * (x[:, 0] > 2) + x[:, 1] * (x[:, 0] > 3) + rng.normal(size=n)).round(3)
        for k, p in enumerate(plain_trees(x, y, spec)):
            rows.append((name, k, float(x[k, 0]), float(x[k, 1]), float(y[k])))
            want[name, k] = p
    df = spark.createDataFrame(rows, "id string, t int, u double, v double, y double").repartition(5)
    fitted = seriestrees.fit(df, "id", "t", ["u", "v"], "y", {"it": Spec(spec.trees, spec.learn_rate, spec.depth, spec.min_n, bins=256)})
    got = seriestrees.predict(df, fitted, "id", ["u", "v"], {"it": spec}).collect()
    assert len(got) == len(rows) and all(r["prediction"] == pytest.approx(want[r["id"], r["t"]]) for r in got)


def test_a_series_that_raises_leaves_the_others(spark, monkeypatch):
    rows = [(i, t, float(t % 5), float(t % 5 > 2)) for i in range(6) for t in range(20)]
    df = spark.createDataFrame(rows, "id int, t int, x double, y double").withColumn("y", F.when(F.col("id") == 3, F.lit(float("nan"))).otherwise(F.col("y")))
    fitted = seriestrees.fit(df, "id", "t", ["x"], "y", {"a": Spec(), "b": Spec(bins=2)}).collect()
    assert len(fitted) == 12 and {(r["id"], r["error"]) for r in fitted if r["error"]} == {(3, "0 of 2 training rows")}
    one = seriestrees.fit(df.limit(0), "id", "t", ["x"], "y", {"a": Spec()})
    assert one.count() == 0
    broken = seriestrees.fit(df, "id", "t", ["x"], "y", {"bad": Spec(trees=-1), "good": Spec(trees=2)}).collect()
    assert {r["model_desc"] for r in broken if r["error"] is None} == {"good"} and sum(r["model_desc"] == "bad" for r in broken) == 6
    assert all(r["error"] for r in broken if r["model_desc"] == "bad")


def test_many_values_are_cut_at_quantiles():
    series = np.repeat([0, 1], [1000, 10])
    values = np.concatenate([np.arange(1000.0), np.arange(10.0)])
    bins, tops = seriestrees.binned(series, values, 16)
    assert bins[:1000].max() == 15 and np.bincount(bins[:1000]).max() <= 63 and (np.diff(bins[:1000]) >= 0).all()
    assert list(bins[1000:]) == list(range(10)) and tops[0, 15] == 999 and tops[1, 9] == 9


def test_series_grown_side_by_side_are_bounded_by_their_histograms(monkeypatch):
    rows = np.array([3] * 5000 + [900] + [2] * 4000)
    spec = Spec(depth=3, bins=64)
    parts = list(seriestrees.pieces(rows, 10, spec))
    assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == len(rows)
    assert all((b - a) * 40 * min(64, rows[a:b].max()) <= seriestrees.HELD for a, b in parts) and len(parts) < 20
    monkeypatch.setattr(seriestrees, "HELD", 10)
    assert list(seriestrees.pieces(rows[:3], 10, spec)) == [(0, 1), (1, 2), (2, 3)] and not list(seriestrees.pieces(rows[:0], 10, spec))
