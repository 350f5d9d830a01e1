"""Gaps, future rows, hold-outs, folds, nested series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import calendar, nested, splits
from tidalframe.plans.inputs import (
    DAILY,
    LOG,
    MONTHLY,
    daily_panel,
    kept,
    labelled,
    monthly_panel,
    transactions,
)
from tidalframe.plans.registry import query
from tidalframe.sources.tables import table


@query(
    "cal_pad",
    f"""WITH {DAILY}, grid AS (SELECT id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM daily GROUP BY id)
        SELECT g.id, g.date, coalesce(d.value, 0.0) AS value FROM grid g LEFT JOIN daily d ON d.id = g.id AND d.date = g.date""",
)
def cal_pad(spark: SparkSession, root: str) -> DataFrame:
    """Days without an order are added with value 0."""
    return calendar.pad(kept(daily_panel(spark, root)), ["id"], "date", "day", 0.0)


@query(
    "cal_future",
    f"""WITH {MONTHLY}, gaps AS (SELECT id, date, date - lag(date) OVER (PARTITION BY id ORDER BY date) AS gap FROM monthly),
ends AS (SELECT id, max(date) AS last_date FROM monthly GROUP BY 1),
steps AS (SELECT unnest(range(1, 25)) AS h)
SELECT id, date, value FROM monthly
UNION ALL SELECT id, CAST(last_date + to_months(CAST(h AS INT)) AS DATE), NULL FROM ends, steps""",
)
def cal_future(spark: SparkSession, root: str) -> DataFrame:
    """24 future months after each series' own end; the step is found from the data."""
    return calendar.with_future(kept(monthly_panel(spark, root)), ["id"], "date", 24)


SPLIT = f"""{DAILY}, cut AS (SELECT min(date) AS cut FROM (SELECT DISTINCT date FROM daily ORDER BY date DESC LIMIT 28))"""


@query(
    "cal_split",
    f"""WITH {SPLIT}
SELECT 'last 28 dates' AS rule, id, date, CASE WHEN date >= (SELECT cut FROM cut) THEN 'testing' ELSE 'training' END AS role FROM daily
UNION ALL
SELECT '3 months', id, date, CASE WHEN date > (SELECT CAST(max(date) - INTERVAL 3 MONTH AS DATE) FROM daily)
  THEN 'testing' ELSE 'training' END FROM daily""",
)
def cal_split(spark: SparkSession, root: str) -> DataFrame:
    """Hold out the last 28 dates of the whole panel, or its last three months."""
    panel = kept(daily_panel(spark, root).select("id", "date"))
    one = splits.time_split(panel, "date", 28).select(F.lit("last 28 dates").alias("rule"), "*")
    return one.unionByName(splits.time_split(panel, "date", "3 months").select(F.lit("3 months").alias("rule"), "*"))


SLICES = 3
CV = f"""{MONTHLY}, back AS (SELECT date, row_number() OVER (ORDER BY date DESC) AS b FROM (SELECT DISTINCT date FROM monthly)),
slices AS (SELECT unnest(range(0, {SLICES})) AS s),
bounds AS (SELECT CAST(s + 1 AS INT) AS slice_id, min(date) AS a, max(date) AS z
  FROM slices JOIN back ON b BETWEEN 6 * s + 1 AND 6 * s + 6 GROUP BY 1),
cv AS (SELECT id, date, value, slice_id, CASE WHEN date < a THEN 'training' ELSE 'testing' END AS role
  FROM monthly JOIN bounds ON date <= z)"""


@query("cal_cv", f"WITH {CV} SELECT id, date, value, slice_id, role FROM cv")
def cal_cv(spark: SparkSession, root: str) -> DataFrame:
    """Three expanding backtest slices of six months each."""
    return splits.time_folds(kept(monthly_panel(spark, root)), "date", 6, SLICES)


@query(
    "cal_cv_plan",
    f"""WITH {CV} SELECT slice_id, role, count(*) AS n, min(date) AS "start", max(date) AS "end" FROM cv GROUP BY 1, 2""",
)
def cal_cv_plan(spark: SparkSession, root: str) -> DataFrame:
    folded = splits.time_folds(kept(monthly_panel(spark, root)), "date", 6, SLICES)
    return splits.plan_summary(folded, "date", ["slice_id", "role"])


@query(
    "cal_roles",
    f"""WITH {SPLIT} SELECT 'training' AS role, id, count(*) AS n, max(date) AS edge FROM daily WHERE date < (SELECT cut FROM cut) GROUP BY 2
        UNION ALL SELECT 'testing', id, count(*), min(date) FROM daily WHERE date >= (SELECT cut FROM cut) GROUP BY 2""",
)
def cal_roles(spark: SparkSession, root: str) -> DataFrame:
    """Both halves of a split, with the dates at its edge."""
    split = splits.time_split(kept(daily_panel(spark, root)), "date", 28)
    train = splits.training(split).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("edge"))
    test = splits.testing(split).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("edge"))
    return train.select(F.lit("training").alias("role"), "*").unionByName(
        test.select(F.lit("testing").alias("role"), "*")
    )


@query(
    "spl_initial",
    """SELECT quality, count(*) AS n, CAST(floor(count(*) * 0.8) AS BIGINT) AS n_training,
       count(*) - CAST(floor(count(*) * 0.8) AS BIGINT) AS n_testing, count(*) AS n_keys
       FROM documents JOIN labels USING (doc_id) GROUP BY 1""",
)
def spl_initial(spark: SparkSession, root: str) -> DataFrame:
    """A stratified 80 % split: every class keeps its share, every row has one role."""
    split = splits.random_split(kept(labelled(spark, root)), "doc_id", 0.8, ["quality"])
    return split.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("role") == "training", 1)).alias("n_training"),
        F.count(F.when(F.col("role") == "testing", 1)).alias("n_testing"),
        F.countDistinct("doc_id").alias("n_keys"),
    )


@query(
    "spl_vfold",
    """WITH sizes AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1), f AS (SELECT unnest(range(0, 5)) AS fold)
       SELECT o_orderstatus, CAST(fold AS INT) AS fold, CAST((n - fold + 4) // 5 AS BIGINT) AS n_rows,
       CAST((n - fold + 4) // 5 AS BIGINT) AS n_keys FROM sizes, f""",
)
def spl_vfold(spark: SparkSession, root: str) -> DataFrame:
    """Five stratified folds whose sizes differ by one row at most."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderstatus")
    folded = splits.folds(orders, "o_orderkey", 5, ["o_orderstatus"])
    return folded.groupBy("o_orderstatus", "fold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys")
    )


@query(
    "spl_by_id",
    f"""WITH {LOG}, n AS (SELECT count(DISTINCT customer_id) AS n, count(*) AS rows FROM log)
        SELECT rows AS n_rows, CAST(round(0.8 * n) AS BIGINT) AS training_ids, n - CAST(round(0.8 * n) AS BIGINT) AS testing_ids,
        CAST(0 AS BIGINT) AS ids_in_both FROM n""",
)
def spl_by_id(spark: SparkSession, root: str) -> DataFrame:
    """80 % of the customers train; no customer is on both sides."""
    split = splits.split_by_id(transactions(spark, root), "customer_id", 0.8)
    per_id = split.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("role").alias("roles"), F.max("role").alias("role")
    )
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.when(F.col("role") == "training", 1)).alias("training_ids"),
        F.count(F.when(F.col("role") == "testing", 1)).alias("testing_ids"),
        F.count(F.when(F.col("roles") > 1, 1)).alias("ids_in_both"),
    )


@query("spl_sample", "SELECT least(count(*), 500) AS n, least(count(*), 500) AS n_keys, least(count(*), 500) AS n_known FROM documents")
def spl_sample(spark: SparkSession, root: str) -> DataFrame:
    """500 random documents, all different, all from the table."""
    docs = table(spark, root, "documents").select("doc_id")
    sample = splits.sample_rows(docs, "doc_id", 500)
    known = sample.join(docs.withColumn("known", F.lit(1)), "doc_id", "left")
    return known.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_keys"), F.count("known").alias("n_known")
    )


NESTED = f"""{DAILY}, ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date) AS i, count(*) OVER (PARTITION BY id) AS n FROM daily),
ends AS (SELECT id, max(date) AS last_date FROM daily GROUP BY 1)"""


@query(
    "nst_nest",
    f"""WITH {NESTED} SELECT id, CAST(count(*) AS INT) AS n_actual, 90 AS n_future, min(date) AS first_date, max(date) AS last_date,
        arg_min(value, date) AS first_value, arg_max(value, date) AS last_value, max(date) + 90 AS last_future FROM daily GROUP BY 1""",
)
def nst_nest(spark: SparkSession, root: str) -> DataFrame:
    """One row per series holding its actual and its future points."""
    rows = nested.nest(kept(daily_panel(spark, root)), "id", "date", "value", 90)
    return rows.select(
        "id",
        F.size("actual").alias("n_actual"),
        F.size("future").alias("n_future"),
        F.element_at("actual", 1)["date"].alias("first_date"),
        F.element_at("actual", -1)["date"].alias("last_date"),
        F.element_at("actual", 1)["value"].alias("first_value"),
        F.element_at("actual", -1)["value"].alias("last_value"),
        F.element_at("future", -1)["date"].alias("last_future"),
    )


@query(
    "nst_split",
    f"WITH {NESTED} SELECT id, date, value, CASE WHEN i > n - 90 THEN 'test' ELSE 'train' END AS part FROM ranked",
)
def nst_split(spark: SparkSession, root: str) -> DataFrame:
    """The last 90 points of each nested series are its test part."""
    cut = nested.split_last(nested.nest(kept(daily_panel(spark, root)), "id", "date", "value", 90), 90)
    parts = [nested.unnest(cut, "id", p).withColumn("part", F.lit(p)) for p in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query(
    "nst_extract",
    f"""WITH {NESTED} SELECT id, date, value, 'actual' AS part FROM daily
        UNION ALL SELECT id, last_date + CAST(h AS INT), NULL, 'future' FROM ends, (SELECT unnest(range(1, 91)) AS h)""",
)
def nst_extract(spark: SparkSession, root: str) -> DataFrame:
    """The nested parts as long rows again."""
    rows = nested.nest(kept(daily_panel(spark, root)), "id", "date", "value", 90)
    parts = [nested.unnest(rows, "id", p).withColumn("part", F.lit(p)) for p in ("actual", "future")]
    return parts[0].unionByName(parts[1])


CUSTOMER_DAYS = """log AS (SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS date,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2)"""


def customer_days(spark: SparkSession, root: str) -> DataFrame:
    from tidalframe.operators.windows import panel_of

    return panel_of(
        transactions(spark, root).withColumnRenamed("customer_id", "id"), ["id"], "date", "price", scale=2
    )


@query(
    "nst_short",
    f"""WITH {CUSTOMER_DAYS}, sized AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY id) > 9 THEN 9 ELSE 3 END AS test_length,
        row_number() OVER (PARTITION BY id ORDER BY date DESC) AS back FROM log)
        SELECT id, date, value, test_length, CASE WHEN back <= test_length THEN 'testing' ELSE 'training' END AS role FROM sized""",
)
def nst_short(spark: SparkSession, root: str) -> DataFrame:
    """Customers with few purchase days get a shorter test part instead of none."""
    tiered = nested.length_tier(kept(customer_days(spark, root)), "id", 9, 3)
    return nested.split_by_tier(tiered, "id", "date").select("id", "date", "value", "test_length", "role")


@query(
    "nst_errors",
    f"""WITH {CUSTOMER_DAYS} SELECT id, CAST(count(*) AS INT) AS n, 'no training rows' AS error FROM log GROUP BY 1 HAVING count(*) <= 9""",
)
def nst_errors(spark: SparkSession, root: str) -> DataFrame:
    """Series too short to be split are reported, the rest goes on."""
    rows = nested.nest(kept(customer_days(spark, root)), "id", "date", "value", 9)
    return nested.error_report(nested.split_last(rows, 9), "id")
