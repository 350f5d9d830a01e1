"""Names, selectors, text, feature steps, imputation, files."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as spine
from tidalframe.functions import dates, text
from tidalframe.functions import selectors as sel
from tidalframe.functions.names import snake_names
from tidalframe.operators import features, impute, neighbours
from tidalframe.operators.features import Roles, Steps
from tidalframe.session import scratch, shared_dir
from tidalframe.sources import files


def test_snake_names():
    assert snake_names(["Source Key", "2008 Pay ($)", "isOpen", "% change", "source.key"]) == [
        "source_key",
        "x2008_pay",
        "is_open",
        "percent_change",
        "source_key_2",
    ]


@given(st.lists(st.text(max_size=8), max_size=6))
def test_snake_names_are_usable(names):
    out = snake_names(names)
    assert len(out) == len(names) and all(n and not n[0].isdigit() for n in out)


def test_selectors(spark):
    df = spark.createDataFrame([(1, "a", 2.0, "b")], "a_id int, b_id string, x double, note string")
    assert sel.names(df, sel.ends_with("_id"), sel.everything()) == ["a_id", "b_id", "x", "note"]
    assert sel.names(df, sel.numeric()) == ["a_id", "x"]
    assert sel.names(df, sel.span("b_id", "x"), "a_id") == ["b_id", "x", "a_id"]
    roles = Roles("x", ("a_id",))
    assert roles.nominal_predictors()(df) == ["b_id", "note"] and roles.numeric_predictors()(df) == []


def test_text(spark):
    df = spark.createDataFrame([("$1,234.5 paid",), ("12.5%",), ("-3 up",), ("none",)], "s string")
    assert [r[0] for r in df.select(text.parse_number("s")).collect()] == [1234.5, 12.5, -3.0, None]
    one = spark.createDataFrame([("a_b_c", "--")], "s string, n string").select(
        text.remove_first("s", "_"), text.to_number("n"), text.title(F.lit("delta air lines"))
    )
    assert tuple(one.first()) == ("ab_c", None, "Delta Air Lines")


def test_dates(spark):
    df = spark.createDataFrame([(20010230, "Jan 2001", "TOTAL"), (20010228, "x", "7")], "a int, b string, c string")
    rows = df.select(dates.parse_ymd("a"), dates.parse_month_year("b"), dates.from_parts(F.lit(2001), "c")).collect()
    assert [tuple(None if v is None else v.isoformat() for v in r) for r in rows] == [
        (None, "2001-01-01", None),
        ("2001-02-28", None, "2001-07-01"),
    ]


def test_steps_learn_on_train_only(spark):
    train = spark.createDataFrame([(1, 1.0, "a", 5), (2, 3.0, "b", 5), (3, None, "b", 5)], "id int, x double, c string, k int")
    new = spark.createDataFrame([(9, 5.0, "zebra", 7)], "id int, x double, c string, k int")
    roles = Roles("y", ("id",))
    apply = Steps(
        [
            features.zero_variance(roles.predictors()),
            features.impute_mean(roles.numeric_predictors()),
            features.center(roles.numeric_predictors()),
            features.dummies(roles.nominal_predictors(), one_hot=True),
        ]
    ).fit(train)
    row = apply(new).first()
    assert row.asDict() == {"id": 9, "x": 3.0, "c_a": 0, "c_b": 0}
    assert [r["x"] for r in apply(train).orderBy("id").collect()] == [-1.0, 1.0, 0.0]


def test_levels_that_clean_to_one_name_get_columns_of_their_own(spark):
    df = spark.createDataFrame([(v, 1) for v in ("a b", "a-b", "a_b", "x")], "c string, c_x int")
    out = features.dummies(lambda d: ["c"], one_hot=True)(df)(df)
    assert out.columns == ["c_x", "c_a_b", "c_a_b_2", "c_a_b_3", "c_x_2"]
    assert all(sum(r[1:]) == 1 for r in out.collect())


def gower_by_hand(rows, number, cats, k):
    span = max(r[number] for r in rows) - min(r[number] for r in rows)
    out = {}
    for r in rows:
        if r["y"] is None:
            near = sorted(
                (
                    (abs(r[number] - d[number]) / span + sum(float(r[c] != d[c]) for c in cats)) / (1 + len(cats)),
                    d["key"],
                    d["y"],
                )
                for d in rows
                if d["y"] is not None
            )[:k]
            out[r["key"]] = sum(n[2] for n in near) / len(near)
    return out


@pytest.mark.parametrize("seed, whole, n_cats, k", [(1, True, 2, 5), (2, False, 2, 3), (3, True, 1, 4), (4, True, 3, 2)])
def test_knn_equals_brute_force(spark, seed, whole, n_cats, k):
    """Also with ties, a hot profile and donors missing from a whole category."""
    rng = random.Random(seed)
    rows = []
    for key in range(250):
        num = float(rng.randint(0, 12)) if whole else rng.random() * 10
        if rng.random() < 0.3:
            num = 4.0
        row = {"key": key, "n": num, "y": float(rng.randint(0, 99)) if rng.random() < 0.8 else None}
        for i in range(3):
            row[f"c{i}"] = "hot" if rng.random() < 0.5 else rng.choice("abcdefg")
        if row["c0"] == "g":
            row["y"] = None
        rows.append(row)
    cats = [f"c{i}" for i in range(n_cats)]
    df = spark.createDataFrame(rows, "key int, n double, y double, c0 string, c1 string, c2 string")
    got = {r["key"]: r["y"] for r in impute.impute_knn(df, "key", "y", "n", cats, k).collect()}
    want = gower_by_hand(rows, "n", cats, k)
    assert len(got) == len(rows) and want
    for row in rows:
        assert got[row["key"]] == pytest.approx(want.get(row["key"], row["y"]), abs=1e-9)


def test_csv_traps(spark, tmp_path):
    """Dashes for missing numbers, a repeated row, total rows, the name only in the path."""
    wide = tmp_path / "wide.csv"
    wide.write_text("source key,Jan 2001,Feb 2001\nA,1.5,--\nB,--,2\nB,--,2\n")
    df = files.read_csv(spark, str(wide), "`source key` string, `Jan 2001` string, `Feb 2001` string")
    long = df.unpivot(["source key"], ["Jan 2001", "Feb 2001"], "date", "value").select(
        F.col("source key").alias("id"), dates.parse_month_year("date").alias("date"), text.to_number("value").alias("value")
    )
    assert long.dropna().distinct().count() == 2
    folder = tmp_path / "many"
    folder.mkdir()
    for name in ("blue_lines", "red_air"):
        (folder / f"{name}.csv").write_text("Year,Month,TOTAL\n2002,10,5\n2002,TOTAL,5\n2003,1,NA\n")
    (folder / "notes.txt").write_text("not a table")
    many = files.read_csv_dir(spark, str(folder), "Year int, Month string, TOTAL string")
    rows = many.where(F.col("month") != "TOTAL").select(
        text.title(text.replace_all(F.regexp_extract("path", "([^/]+)\\.csv$", 1), "_", " ")).alias("carrier"),
        dates.from_parts("year", "month").alias("date"),
        text.to_number("total").alias("value"),
    ).dropna()
    assert sorted(r["carrier"] for r in rows.collect()) == ["Blue Lines", "Red Air"]


def test_blank_separated(spark, tmp_path):
    (tmp_path / "log.txt").write_text("  1  19970101   2  29.33\n 11 19970118 1 7\n")
    rows = files.read_blank_separated(spark, str(tmp_path / "log.txt"), 5).collect()
    assert [r["X4"] for r in rows] == ["29.33", "7"] and rows[0]["X5"] is None


def test_scratch_paths_differ(spark):
    assert scratch(spark, "x") != scratch(spark, "x")


class Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, master, folder=None):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext, self.master, self.applicationId = self, master, f"app-{master}-{folder}"
        self.checkpoint = None

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = folder


def test_shared_folder_is_the_one_the_cluster_names():
    named = Session("spark://host:7077", "/shared/place")
    assert shared_dir(named) == "/shared/place" == named.checkpoint
    with pytest.raises(ValueError):
        shared_dir(Session("spark://host:7077"))
    local = Session("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.checkpoint


def gower(a, b, numbers, cats, reach):
    return (sum(abs(a[c] - b[c]) / reach[c] for c in numbers if reach[c]) + sum(a[c] != b[c] for c in cats)) / (len(numbers) + len(cats))


@pytest.mark.parametrize(("seed", "cells", "k"), [(1, 40, 3), (2, 1, 5), (3, 200, 1)])
def test_neighbours_over_all_predictors_equal_brute_force(spark, monkeypatch, seed, cells, k):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 4)
    monkeypatch.setattr(neighbours, "PART_ROWS", 20)
    rng = random.Random(seed)
    rows = []
    for key in range(300):
        y = None if key % 6 == 0 else float(rng.randint(0, 50))
        z = None if key % 7 == 0 else rng.choice("uvw")
        rows.append((key, y, z, rng.choice([1.0, 2.0, 7.5, None]), float(rng.randint(0, 400)), 5.0, rng.choice("abc"), rng.choice(["x", None])))
    names = ["key", "y", "z", "n1", "n2", "same", "c1", "c2"]
    df = spark.createDataFrame(rows, "key long, y double, z string, n1 double, n2 double, same double, c1 string, c2 string")
    numbers, cats = ("n1", "n2", "same"), ("c1", "c2")
    models = [neighbours.fit(df, "key", t, numbers, cats, k, cells) for t in ("y", "z")]
    got = {r["key"]: r for r in neighbours.impute(models, df).collect()}
    dicts = [dict(zip(names, r, strict=True)) for r in rows]
    middle = {c: np.mean([d[c] for d in dicts if d[c] is not None]) for c in numbers}
    reach = {c: max(d[c] for d in dicts if d[c] is not None) - min(d[c] for d in dicts if d[c] is not None) for c in numbers}
    full = [d | {c: middle[c] if d[c] is None else d[c] for c in numbers} for d in dicts]
    assert len(got) == 300
    for d in full:
        for target in ("y", "z"):
            if d[target] is not None:
                assert got[d["key"]][target] == d[target]
                continue
            near = sorted((o for o in full if o[target] is not None), key=lambda o: (gower(d, o, numbers, cats, reach), o["key"]))[:k]
            values = [o[target] for o in near]
            want = np.mean(values) if target == "y" else min(values, key=lambda v: (-values.count(v), v))
            assert got[d["key"]][target] == (pytest.approx(want) if target == "y" else want)


def test_a_row_meets_few_of_a_cells_donors(monkeypatch):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 4, (4200, 2)).astype(float)
    every = np.column_stack([rng.random((4200, 3)).round(2), codes])
    x, donors, reach = every[:200], every[200:], np.ones(3)
    whole = neighbours.distances(x, donors, 3, reach)
    met, plain = [], neighbours.distances
    monkeypatch.setattr(neighbours, "distances", lambda a, b, *rest: met.append(len(a) * len(b)) or plain(a, b, *rest))
    row, donor, far = neighbours.nearest(x, np.full(200, np.inf), donors, 3, reach, 5)
    want = np.argsort(whole, axis=1, kind="stable")[:, :5]
    assert (donor.reshape(200, 5) == want).all() and (far.reshape(200, 5) == np.take_along_axis(whole, want, 1)).all()
    assert sum(met) < 0.25 * whole.size


def test_neighbours_without_donors_or_rows(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, None)], "key long, y double, n double")
    model = neighbours.fit(df, "key", "y", ["n"], [], 3)
    assert [r["y"] for r in neighbours.impute([model], df).collect()] == [None, None]
    some = neighbours.fit(df.withColumn("y", F.lit(4.0)), "key", "y", ["n"], [], 3)
    assert neighbours.impute([some], df.limit(0)).count() == 0 and {r["y"] for r in neighbours.impute([some], df).collect()} == {4.0}


def test_one_search_fills_for_several_numbers_of_neighbours(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(k, rng.choice([None, 1.0, 2.0, 5.0, 9.0]), rng.choice("abc"), rng.choice(["u", "v", None])) for k in range(120)]
    df = spark.createDataFrame(rows, "key long, y double, c string, d string")
    model = neighbours.fit(df, "key", "y", [], ["c", "d"], 5)
    alone = {k: {r["key"]: r["f"] for r in neighbours.with_filled(model, df, "f", k).collect()} for k in (3, 5)}
    asked, plain = [], neighbours.ranked
    monkeypatch.setattr(neighbours, "ranked", lambda *a: asked.append(a[2]) or plain(*a))
    got = neighbours.with_several(model, df, {"f3": 3, "f5": 5}).collect()
    assert asked == [5] and len(got) == 120
    for r in got:
        assert r["f3"] == pytest.approx(alone[3][r["key"]]) and r["f5"] == pytest.approx(alone[5][r["key"]])
    levels = neighbours.with_several(neighbours.fit(df, "key", "d", [], ["c"], 5), df, {"one": 1, "five": 5}).collect()
    assert all(r["one"] == r["five"] == r["d"] for r in levels if r["d"]) and {r["five"] for r in levels} <= {"u", "v"}


def test_the_number_of_neighbours_is_chosen_in_folds(spark):
    rng = random.Random(4)
    rows = [(k, float(x := rng.randint(0, 30)), float(x % 2 * 100 + rng.gauss(0, 30)), k % 3) for k in range(240)]
    df = spark.createDataFrame(rows, "key long, n double, y double, fold int")
    tuned = neighbours.tune(df, "key", "y", ["n"], [], (1, 4, 60), 3)
    assert tuned.count() == 9 and neighbours.best_k(tuned) == 4


def order_tables(spark, at, n=90):
    """Small tables of orders, their lines and customers; one line an order and one more for each third."""
    rng = random.Random(8)
    orders = [(k, k % 7, float(rng.randint(100, 900)), dt.datetime(1995, 1, 1) + dt.timedelta(days=rng.randint(0, 700)), rng.choice(["1-URGENT", "5-LOW"])) for k in range(n)]
    lines = [(k, float(rng.randint(1, 50)), rng.randint(0, 8) / 100) for k in (*range(n), *range(0, n, 3))]
    people = [(k, f"S{k % 3}", float(rng.randint(-99, 999)), k % 4) for k in range(7)]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        ("lineitem", lines, "l_orderkey long, l_quantity double, l_tax double"),
        ("customer", people, "c_custkey long, c_mktsegment string, c_acctbal double, c_nationkey int"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def test_folds_hold_every_order_of_a_known_price(spark, tmp_path):
    root = order_tables(spark, tmp_path)
    got = spine.queries()["fea_knn_folds"](spark, root).collect()
    known = [k for k in range(90) if k % 25 != 3]
    assert {(r["k"], r["fold"]): r["n"] for r in got} == {(k, i): sum(o % 3 == i for o in known) for k in (1, 3, 5, 9) for i in range(3)}


@pytest.mark.parametrize(("numbers", "levels", "far"), [(5, 1, np.inf), (3, 6, 0.05), (0, 4, np.inf), (2, 0, np.inf), (4, 2, 0.0)])
def test_rows_of_a_cell_that_are_searched_together(monkeypatch, numbers, levels, far):
    """The k nearest of each row as brute force finds them, few of them computed in full."""
    rng = np.random.default_rng(3)
    parts = [rng.choice([1.0, 2.5, 100.25, -7.125], (3100, 1)) if f == 1 else rng.uniform(-50, 900, (3100, 1)).round(1) for f in range(numbers)]
    parts += [rng.integers(0, max(1, levels), (3100, 1)) * 1e12 for _ in range(2 if levels else 0)]
    every = np.concatenate(parts, 1)
    every[3000:, 0] += 4000.0  # rows outside of the donors' range
    x, donors = every[2900:], every[:2900]
    reach = np.ptp(donors[:, :numbers], axis=0)
    whole = neighbours.distances(x, donors, numbers, reach)
    met, plain = [], neighbours.paired
    monkeypatch.setattr(neighbours, "paired", lambda a, *rest: met.append(len(a)) or plain(a, *rest))
    row, donor, d = neighbours.nearest(x, np.full(200, far), donors, numbers, reach, 5)
    want = np.argsort(whole, axis=1, kind="stable")[:, :5]
    near = np.take_along_axis(whole, want, 1)
    assert row.tolist() == np.nonzero(near <= far)[0].tolist() and donor.tolist() == want[near <= far].tolist() and (d == near[near <= far]).all()
    assert sum(met) < 0.05 * whole.size or numbers < 3


def test_a_frequent_profile_does_not_fill_its_cell(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "RUN_ROWS", 100)
    rows = [(k, float(k % 11), 1.0 if k % 50 else float(k), "a") for k in range(1000)]
    df = spark.createDataFrame([*rows, (5000, None, 1.0, "a")], "key long, y double, n double, c string").coalesce(1)
    model = neighbours.fit(df, "key", "y", ["n"], ["c"], 3)
    held = sorted(r["_key"] for r in model.donors.collect())
    assert held[:4] == [0, 1, 2, 3] and set(range(50, 1000, 50)) < set(held) and len(held) <= 20 + 11 * 3
    assert {r["y"] for r in neighbours.impute([model], df).collect() if r["key"] == 5000} == {2.0}
    x = np.array([[1.0, 2.0], [3.0, 0.0], [1.0, 2.0], [1.0, 2.0], [3.0, 0.0]])
    assert neighbours.firsts(x, pa.chunked_array([pa.array([7, 1, None, 3, 2])]), 2).tolist() == [2, 1, 4, 3]
