"""Panels, calendars, nested series, recursion, hierarchies."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalframe.functions import dates
from tidalframe.operators import (
    aggregates,
    baselines,
    calendar,
    nested,
    perseries,
    recursive,
    shape,
    splits,
    temporal,
    windows,
)


def months(n, start=dt.date(2010, 1, 1)):
    out = []
    for i in range(n):
        y, m = divmod(start.year * 12 + start.month - 1 + i, 12)
        out.append(dt.date(y, m + 1, 1))
    return out


@pytest.fixture(scope="module")
def panel(spark):
    """One whole series, one with a gap, one short; an outlier in the first."""
    rng = np.random.default_rng(1)
    rows = []
    for name, n in (("long", 60), ("gap", 48), ("short", 5)):
        for i, d in enumerate(months(n)):
            if name == "gap" and i == 20:
                continue
            value = 100 + 10 * np.sin(i * np.pi / 6) + rng.normal()
            rows.append((name, d, float(round(value + (500 if name == "long" and i == 30 else 0), 2))))
    return spark.createDataFrame(rows, "id string, date date, value double")


def test_outlier_is_bridged(panel):
    rows = windows.clean_series(panel, ["id"], "date", "value", 12).where("id = 'long'").collect()
    changed = [r for r in rows if r["value"] != r["value_clean"]]
    assert [r["date"] for r in changed] == [months(60)[30]]
    assert 80 < changed[0]["value_clean"] < 120


def test_pad_fills_the_gap(panel):
    rows = calendar.pad(panel, ["id"], "date", "month", 0.0).where("id = 'gap'").collect()
    assert len(rows) == 48 and sum(r["value"] == 0.0 for r in rows) == 1


@pytest.mark.parametrize(
    "start, step, unit",
    [
        (dt.date(2020, 1, 31), 1, "day"),
        (dt.date(2020, 1, 6), 7, "week"),
    ],
)
def test_future_step_is_found(spark, start, step, unit):
    rows = [("a", start + dt.timedelta(days=step * i), 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "id string, date date, value double")
    ahead = [r["date"] for r in calendar.future_rows(df, ["id"], "date", 3).orderBy("h").collect()]
    assert ahead == [start + dt.timedelta(days=step * i) for i in (6, 7, 8)]


def test_future_months(panel):
    ahead = calendar.future_rows(panel, ["id"], "date", 2).where("id = 'long'").orderBy("h").collect()
    assert [r["date"] for r in ahead] == months(62)[60:]


def test_partial_dates():
    assert dates.first_day("1997-02") == dt.date(1997, 2, 1) and dates.last_day("1997-02") == dt.date(1997, 2, 28)
    assert dates.last_day("1996") == dt.date(1996, 12, 31)
    with pytest.raises(ValueError):
        dates.split_period("3 moons")


def test_split_edges(panel):
    split = splits.time_split(panel, "date", 6)
    train = splits.training(split).agg(F.max("date")).first()[0]
    test = splits.testing(split).agg(F.min("date")).first()[0]
    assert train < test == months(60)[54]


def test_short_series_is_reported_not_raised(panel):
    cut = nested.split_last(nested.nest(panel, "id", "date", "value", 3, "month"), 6)
    errors = nested.error_report(cut, "id").collect()
    assert [r["id"] for r in errors] == ["short"]
    assert nested.unnest(cut, "id", "test").where("id = 'short'").count() == 5
    tiers = nested.length_tier(panel, "id", 6, 2).select("id", "test_length").distinct().collect()
    assert dict(map(tuple, tiers)) == {"long": 6, "gap": 6, "short": 2}


def test_rolling_mean_even_period(spark):
    rows = [("a", dt.date(2020, 1, 1 + i), float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6])]
    df = spark.createDataFrame(rows, "id string, date date, value double")
    got = windows.add_rolling_mean(df, ["id"], "date", "value", [4]).orderBy("date").collect()
    assert [r["value_roll_4"] for r in got] == [1.5, 2.0, 2.5, 3.5, 4.5, 5.0]


def test_linear_and_stepwise_recursion_agree(panel):
    state = recursive.tail_state(panel, "id", "date", "value", 12)
    weights = {1: 0.5, 12: 0.4}
    one = recursive.linear_recursion(state, "id", 3.0, weights, 15)
    predict = lambda df: df.withColumn("prediction", 3.0 + 0.5 * F.col("lag1") + 0.4 * F.col("lag12"))
    two = recursive.model_recursion(state, "id", predict, [1, 12], 15, checkpoint_every=4)
    for out in (one, two):
        short = out.where("error IS NOT NULL").collect()
        assert [(r["id"], r["h"], r["value"]) for r in short] == [("short", None, None)]
    a = {(r["id"], r["h"]): r["value"] for r in one.where("error IS NULL").collect()}
    b = {(r["id"], r["h"]): r["value"] for r in two.where("error IS NULL").collect()}
    assert a.keys() == b.keys() and {k[0] for k in a} == {"long", "gap"}
    assert all(a[k] == pytest.approx(b[k]) for k in a)


def test_seasonal_naive(panel):
    future = calendar.future_rows(panel, ["id"], "date", 14, "month")
    rows = baselines.seasonal_naive(panel, future, ["id"], "date", "value", 12).where("id = 'long'").orderBy("h").collect()
    last = [r["value"] for r in panel.where("id = 'long'").orderBy("date").collect()][-12:]
    assert [r["prediction"] for r in rows] == last + last[:2]


def test_temporal_levels_agree(panel):
    nodes = temporal.node_forecasts(panel, ["id"], "date", "value", 12, 3)
    out = temporal.reconcile(nodes, ["id"], 12).where("id = 'long'").orderBy("h").collect()
    assert [r["h"] for r in out] == list(range(1, 13))
    s, g = temporal.summing_matrix(12), temporal.reconcile_matrix(12)
    base = np.array([r["forecast"] for r in nodes.where("id = 'long'").orderBy("level", "block").collect()])
    assert np.allclose([r["prediction"] for r in out], g @ base)
    assert np.allclose(g @ s, np.eye(12))


def test_per_series_regression(spark):
    rng = np.random.default_rng(4)
    rows, truth = [], {}
    for sid in ("a", "b"):
        beta = rng.normal(size=3)
        truth[sid] = beta
        for _ in range(40):
            x1, x2 = rng.normal(size=2)
            rows.append((sid, 1.0, float(x1), float(x2), float(beta @ [1, x1, x2])))
    rows.append(("tiny", 1.0, 0.5, 0.5, 1.0))
    rows += [("flat", 1.0, 2.0, 4.0, 1.0)] * 9
    df = spark.createDataFrame(rows, "id string, one double, x1 double, x2 double, y double")
    f = ["one", "x1", "x2"]
    fitted = perseries.solve(perseries.gram_sums(df, "id", f, "y"), "id", f, {"plain": 0.0}).collect()
    by = {r["id"]: r for r in fitted}
    for sid, beta in truth.items():
        assert np.allclose(by[sid]["coefficients"], beta)
    assert by["tiny"]["coefficients"] is None and "1 training rows" in by["tiny"]["error"]
    assert by["flat"]["coefficients"] is None and by["flat"]["error"]


def test_autocorrelation(panel):
    acf = aggregates.autocorrelation(panel.where("id = 'long'"), ["id"], "date", "value", 5)
    x = np.array([r["value"] for r in panel.where("id = 'long'").orderBy("date").collect()])
    c = x - x.mean()
    want = [1.0] + [float(c[k:] @ c[:-k] / (c @ c)) for k in range(1, 6)]
    assert [r["acf"] for r in acf.orderBy("lag").collect()] == pytest.approx(want)
    pacf = aggregates.partial_autocorrelation(acf, ["id"]).orderBy("lag").collect()
    r = np.array(want)
    for k in range(1, 6):
        toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert pacf[k - 1]["pacf"] == pytest.approx(np.linalg.solve(toeplitz, r[1 : k + 1])[-1])


def test_wider_fill_leaves_known_nulls(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2.0), (2, "b", 3.0)], "k int, n string, v double")
    rows = {r["k"]: r for r in shape.wider(df, ["k"], "n", "v", ["a", "b"], fill=0.0).collect()}
    assert rows[1]["a"] is None and rows[2]["a"] == 0.0 and rows[2]["b"] == 3.0


def test_row_stats(spark):
    df = spark.createDataFrame([(1, 1.0, None, 4.0), (2, None, None, None)], "k int, a double, b double, c double")
    rows = {r["k"]: r for r in shape.row_stats(df, ["a", "b", "c"], "p").collect()}
    assert rows[1]["p_mean"] == 2.5 and rows[1]["p_median"] == 2.5 and rows[1]["p_missing"] == 1
    assert rows[1]["p_stdev"] == pytest.approx(np.std([1, 4], ddof=1))
    assert rows[2]["p_mean"] is None and rows[2]["p_median"] is None and rows[2]["p_missing"] == 3


def test_correlation_both_ways(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 40))
    x[:, 1] = x[:, 0] * 0.5 + x[:, 1]
    cols = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols))
    want = np.corrcoef(x.T)
    for chosen in (cols, cols[:3]):
        got = {(r["x"], r["y"]): r["r"] for r in aggregates.correlation(df, chosen).collect()}
        assert len(got) == len(chosen) ** 2
        assert got["c0", "c1"] == pytest.approx(want[0, 1], abs=1e-6)
