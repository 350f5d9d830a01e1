"""Rows, groups and values that an earlier version lost or changed."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidalframe.functions.names import snake_names
from tidalframe.functions.quantiles import normal_quantile, t_quantile
from tidalframe.operators import aggregates, baselines, calendar, impute, nested, ordered, perseries, shape, splits, tuning, windows
from tidalframe.streaming import jobs


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def late_events(spark, tmp_path):
    """A folder table of one-row files that are not in the order of time."""
    rows = [("a", day(9), 1.0), ("a", day(0), 2.0), ("b", day(5), 3.0), ("a", day(9), 4.0), ("b", day(1), 5.0)]
    path = f"{tmp_path}/events.parquet"
    for row in rows:
        spark.createDataFrame([row], "k string, ts timestamp, v double").coalesce(1).write.mode("append").parquet(path)
    return path, rows


def test_a_folder_is_streamed_whole_whatever_the_order_of_its_files(spark, late_events):
    path, rows = late_events
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    for source in (jobs.read_stream(spark, path, schema), stream):
        out = jobs.run_updates(jobs.windowed_totals(source, "ts", ["k"], "v", late=None), "late", ["k", "start"])
        got = {(r["k"], r["start"]): (r["total"], r["n"]) for r in out.collect()}
        want = {}
        for k, ts, v in rows:
            total, n = want.get((k, ts), (0, 0))
            want[k, ts] = (total + v, n + 1)
        assert got == want


def test_rows_dropped_for_being_late_are_reported(spark, late_events):
    path, _ = late_events
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    totals = jobs.windowed_totals(stream, "ts", ["k"], "v", late="1 hour")
    with pytest.raises(ValueError, match="too late"):
        jobs.run_updates(totals, "late", ["k", "start"])


def test_row_numbers_of_texts_with_one_prefix_and_of_times(spark):
    df = spark.range(5000).selectExpr("concat('Customer#', lpad(cast((id * 7919) % 5000 as string), 9, '0')) as name", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as at", "id")
    for col in ("name", "at"):
        rows = ordered.row_index(df, col).orderBy("row_id").collect()
        assert [r["row_id"] for r in rows] == list(range(1, 5001)) and [r[col] for r in rows] == sorted(r[col] for r in rows)
    dealt = df.select("name").repartitionByRange(64, "name").select(F.spark_partition_id().alias("p"))
    assert dealt.distinct().count() > 50


def test_a_constant_column_has_no_correlation(spark):
    rows = spark.range(50).selectExpr("cast(id as double) as a", "1.0D as b", "cast(id * id as double) as c")
    got = {(r["x"], r["y"]): r["r"] for r in aggregates.correlation(rows, ["a", "b", "c"]).collect()}
    x = np.arange(50.0)
    assert got["a", "b"] is None and got["b", "b"] == 1.0
    assert got["c", "a"] == pytest.approx(np.corrcoef(x, x * x)[0, 1], abs=1e-6)
    wide = spark.range(30).select(*[((F.col("id") * (k + 3)) % 17).cast("double").alias(f"c{k}") for k in range(40)])
    assert aggregates.correlation(wide, wide.columns).count() == 1600


def test_null_groups_keep_their_rows(spark):
    rows = [(None, k, float(k)) for k in range(50)] + [("a", 100 + k, float(k)) for k in range(50)]
    df = spark.createDataFrame(rows, "g string, k long, v double")
    parts = splits.random_split(df, "k", 0.8, ["g"]).groupBy("g", "role").count().collect()
    assert {(r["g"], r["role"]): r["count"] for r in parts} == {(g, role): n for g in (None, "a") for role, n in ((splits.TRAIN, 40), (splits.TEST, 10))}
    folds = splits.folds(df, "k", 5, ["g"]).groupBy("g", "fold").count().collect()
    assert len(folds) == 10 and {r["count"] for r in folds} == {10}
    scaled = windows.standardise(df, ["v"], ["g"])
    assert scaled.count() == 100 and scaled.where("v IS NULL").count() == 0
    assert nested.length_tier(df, "g", 10, 3).count() == 100
    dated = df.withColumn("d", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("v").cast("int")))
    assert calendar.last_period(dated, ["g"], "d", "10 days").count() == 22


def test_a_level_without_values_stays_in_the_profile(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None), (dt.date(2024, 2, 1), 3.0)], "d date, v double")
    got = {(r["feature"], r["level"]): (r["n"], r["med"]) for r in aggregates.seasonal_profile(df, "d", "v").collect()}
    assert got["month", 1] == (0, None) and got["month", 2] == (1, 3.0)


def test_series_without_training_rows_stay_in_the_forecast(spark):
    train = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.0)], "id string, date date, value double")
    future = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "id string, h int")
    got = {r["id"]: r["prediction"] for r in baselines.window_forecast(train, future, ["id"], "date", "value", 3).collect()}
    assert got == {"a": 2.0, "b": None, None: None}


def test_a_series_of_one_date_takes_the_usual_step(spark):
    rows = [("a", dt.date(2024, m, 1)) for m in range(1, 7)] + [("b", dt.date(2024, 3, 1))]
    panel = spark.createDataFrame(rows, "id string, date date")
    got = [r["date"] for r in calendar.future_rows(panel, ["id"], "date", 2).where("id = 'b'").orderBy("h").collect()]
    assert got == [dt.date(2024, 4, 1), dt.date(2024, 5, 1)]
    alone = calendar.future_rows(panel.where("id = 'b'"), ["id"], "date", 1).first()
    assert alone["date"] == dt.date(2024, 3, 2)


def test_names_are_numbered_until_they_differ():
    assert snake_names(["a", "a", "a_2", "A", "a_2"]) == ["a", "a_2", "a_2_2", "a_3", "a_2_3"]


def test_rows_without_a_target_do_not_count(spark):
    rows = [("s", float(x), 2.0 + 3.0 * x) for x in range(10)] + [("s", float(x), None) for x in range(10, 14)] + [("t", 1.0, None)]
    df = spark.createDataFrame(rows, "id string, x double, y double").withColumn("one", F.lit(1.0))
    fitted = {r["id"]: r for r in perseries.solve(perseries.gram_sums(df, "id", ["one", "x"], "y"), "id", ["one", "x"], {"line": 0.0}).collect()}
    assert fitted["s"]["coefficients"] == pytest.approx([2.0, 3.0]) and fitted["s"]["n"] == 10
    assert fitted["t"]["n"] == 0 and fitted["t"]["error"]


@pytest.mark.parametrize(("degrees", "value"), [(1, 12.706205), (2, 4.302653), (5, 2.570582), (9, 2.262157), (10, 2.228139), (30, 2.042272), (1000, 1.962339)])
def test_quantiles_of_t(degrees, value):
    assert t_quantile(0.975, degrees) == pytest.approx(value, abs=1e-6)


def test_normal_quantiles():
    assert [round(normal_quantile(p), 6) for p in (0.975, 0.995, 0.9)] == [1.959964, 2.575829, 1.281552]


def test_a_race_over_more_than_ten_folds(spark):
    def evaluate(alive, fold):
        return spark.createDataFrame([(c, {"good": 1.0, "bad": 2.0}[c] + 0.01 * fold) for c in alive], "candidate string, metric double")

    rows = {r["candidate"]: r for r in tuning.race(spark, ["good", "bad"], evaluate, 12).collect()}
    assert rows["good"]["n_folds"] == 12 and rows["bad"]["dropped"] and rows["bad"]["n_folds"] == 3


def test_a_name_without_a_column_is_an_error(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "c", 2.0), (2, None, 3.0)], "id int, n string, v double")
    assert shape.wider(df, ["id"], "n", "v", ["a", "c"]).count() == 2
    with pytest.raises(Exception, match="without a column: c"):
        shape.wider(df, ["id"], "n", "v", ["a"]).collect()


def test_rows_with_unknown_predictors_are_filled(spark):
    rows = [(k, float(k % 5), "ab"[k % 2], float(k)) for k in range(20)] + [(20, None, "a", None), (21, 2.0, None, None), (22, 3.0, "b", None)]
    df = spark.createDataFrame(rows, "k long, x double, c string, y double")
    got = {r["k"]: r for r in impute.impute_knn(df, "k", "y", "x", ["c"], 3).collect()}
    assert len(got) == 23 and all(r["y"] is not None for r in got.values())
    assert got[20]["x"] is None and got[21]["c"] is None
    assert got[22]["y"] == pytest.approx(np.mean([3.0, 13.0, 7.0]))
    constant = df.withColumn("x", F.lit(1.0))
    assert impute.impute_knn(constant, "k", "y", "x", ["c"], 3).where("y IS NULL").count() == 0
