"""Feature steps, learnt on one table and applied to another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.functions import dates
from tidalframe.functions import selectors as sel
from tidalframe.functions.exact import exact_sum
from tidalframe.operators import aggregates, calendar, features, impute, neighbours, windows
from tidalframe.operators.features import Roles, Steps
from tidalframe.plans.inputs import UNKNOWN, kept, order_days, parts, unknown_prices
from tidalframe.plans.registry import query
from tidalframe.plans.scalars import SIGNATURE
from tidalframe.session import cut_lineage
from tidalframe.sources.tables import table

PART_ROLES = Roles("p_retailprice", ("p_partkey", "p_brand"))


@query(
    "fea_prep",
    """WITH train AS (SELECT * FROM part WHERE p_type <> 'PROMO'), s AS (SELECT avg(p_size) AS m, stddev_samp(p_size) AS d FROM train)
SELECT p_partkey, p_brand, round((p_size - m) / d, 6) AS p_size, round(ln(p_retailprice), 6) AS p_retailprice,
  CAST(p_type = 'LARGE' AS INT) AS "p_type_LARGE", CAST(p_type = 'MEDIUM' AS INT) AS "p_type_MEDIUM",
  CAST(p_type = 'SMALL' AS INT) AS "p_type_SMALL", CAST(p_type = 'STANDARD' AS INT) AS "p_type_STANDARD" FROM part, s""",
)
def fea_prep(spark: SparkSession, root: str) -> DataFrame:
    """Steps learnt without one part type and applied to all: its flags are all 0."""
    steps = Steps(
        [
            features.log("p_retailprice"),
            features.zero_variance(PART_ROLES.predictors()),
            features.normalize(PART_ROLES.numeric_predictors()),
            features.dummies(PART_ROLES.nominal_predictors()),
        ]
    )
    rows = parts(spark, root).withColumn("p_size", F.col("p_size").cast("double"))
    apply = steps.fit(rows.where(F.col("p_type") != "PROMO"))
    return apply(rows).withColumns({c: F.round(c, 6) for c in ("p_size", "p_retailprice")})


def order_dates(spark: SparkSession, root: str) -> DataFrame:
    days = table(spark, root, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return days.withColumns(dates.signature("d"))


DAYS_SQL = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"
UNUSED = "year_iso, month_xts, hour, minute, second, hour12, am_pm, wday_xts, week_iso"


@query(
    "fea_rm",
    f"WITH {DAYS_SQL}, sig AS (SELECT d, {SIGNATURE} FROM days) SELECT * EXCLUDE ({UNUSED}, half) FROM sig",
)
def fea_rm(spark: SparkSession, root: str) -> DataFrame:
    """Columns removed by name and by pattern: what a daily model has no use for."""
    apply = features.remove("half", sel.matches(dates.UNUSED_FOR_DAYS))(order_dates(spark, root))
    return apply(order_dates(spark, root))


@query(
    "fea_zv",
    f"WITH {DAYS_SQL}, sig AS (SELECT d, {SIGNATURE} FROM days) SELECT * EXCLUDE (hour, minute, second, hour12, am_pm) FROM sig",
)
def fea_zv(spark: SparkSession, root: str) -> DataFrame:
    """Clock columns of plain dates hold one value and go."""
    rows = order_dates(spark, root)
    return features.zero_variance(sel.everything())(rows)(rows)


@query(
    "fea_dummy",
    """SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INT) AS "c_mktsegment_BUILDING",
  CAST(c_mktsegment = 'FURNITURE' AS INT) AS "c_mktsegment_FURNITURE", CAST(c_mktsegment = 'HOUSEHOLD' AS INT) AS "c_mktsegment_HOUSEHOLD",
  CAST(c_mktsegment = 'MACHINERY' AS INT) AS "c_mktsegment_MACHINERY", CAST(half = 'high' AS INT) AS half_high, CAST(half = 'low' AS INT) AS half_low
  FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN 'high' ELSE 'low' END AS half FROM customer)""",
)
def fea_dummy(spark: SparkSession, root: str) -> DataFrame:
    """Segments without their first level, and a one-hot pair."""
    rows = table(spark, root, "customer").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") >= 0, "high").otherwise("low").alias("half")
    )
    steps = Steps(
        [
            features.dummies(lambda df: ["c_mktsegment"]),
            features.dummies(lambda df: ["half"], one_hot=True),
        ]
    )
    return steps.fit(rows)(rows)


@query(
    "fea_normalize",
    """WITH s AS (SELECT avg(p_size) AS m, stddev_samp(p_size) AS d, avg(p_retailprice) AS pm, stddev_samp(p_retailprice) AS pd FROM part)
SELECT p_partkey, round((p_size - m) / d, 6) AS normalized, round(p_retailprice - pm, 6) AS centered, round(p_retailprice / pd, 6) AS scaled FROM part, s""",
)
def fea_normalize(spark: SparkSession, root: str) -> DataFrame:
    rows = parts(spark, root).select(
        "p_partkey",
        F.col("p_size").cast("double").alias("normalized"),
        F.col("p_retailprice").alias("centered"),
        F.col("p_retailprice").alias("scaled"),
    )
    steps = Steps(
        [
            features.normalize(lambda df: ["normalized"]),
            features.center(lambda df: ["centered"]),
            features.scale(lambda df: ["scaled"]),
        ]
    )
    out = steps.fit(rows)(rows)
    return out.withColumns({c: F.round(c, 6) for c in ("normalized", "centered", "scaled")})


@query("fea_log", "SELECT o_orderkey, round(ln(o_totalprice), 6) AS o_totalprice FROM orders")
def fea_log(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return Steps([features.log("o_totalprice")]).fit(rows)(rows).withColumn("o_totalprice", F.round("o_totalprice", 6))


@query(
    "fea_discretize",
    """WITH b AS (SELECT quantile_cont(c_acctbal, [1/6, 2/6, 3/6, 4/6, 5/6]) AS q FROM customer)
SELECT c_custkey, 'bin' || (1 + (c_acctbal > q[1])::INT + (c_acctbal > q[2])::INT + (c_acctbal > q[3])::INT
  + (c_acctbal > q[4])::INT + (c_acctbal > q[5])::INT) AS c_acctbal FROM customer, b""",
)
def fea_discretize(spark: SparkSession, root: str) -> DataFrame:
    """Six bins of equal count, their edges exact quantiles."""
    rows = table(spark, root, "customer").select("c_custkey", "c_acctbal")
    return features.discretize("c_acctbal", 6)(rows)(rows)


@query(
    "fea_mutate",
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, p_retailprice / p_size AS price_per_size FROM part""",
)
def fea_mutate(spark: SparkSession, root: str) -> DataFrame:
    """A computed feature, then a number turned into a category."""
    rows = table(spark, root, "part").select("p_partkey", "p_size", "p_retailprice")
    steps = Steps(
        [
            features.mutate(price_per_size=F.col("p_retailprice") / F.col("p_size")),
            features.as_text("p_size"),
            features.remove("p_retailprice"),
        ]
    )
    return steps.fit(rows)(rows)


@query("fea_no_missing", f"WITH {UNKNOWN} SELECT o_orderkey, o_custkey, o_orderpriority FROM unknown")
def fea_no_missing(spark: SparkSession, root: str) -> DataFrame:
    rows = unknown_prices(spark, root)
    return features.complete_columns()(rows)(rows)


@query(
    "fea_impute_mean",
    f"WITH {UNKNOWN} SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM unknown)), 6) AS price FROM unknown",
)
def fea_impute_mean(spark: SparkSession, root: str) -> DataFrame:
    rows = unknown_prices(spark, root).select("o_orderkey", "price")
    return features.impute_mean(lambda df: ["price"])(rows)(rows).withColumn("price", F.round("price", 6))


@query(
    "fea_impute_knn",
    """WITH src AS (SELECT p_partkey, p_size, p_brand, p_type, CASE WHEN p_name NOT LIKE 'red%' THEN p_retailprice END AS price FROM part),
reach AS (SELECT CAST(max(p_size) - min(p_size) AS DOUBLE) AS reach FROM src),
near AS (SELECT r.p_partkey, d.price FROM src r, src d, reach WHERE r.price IS NULL AND d.price IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY r.p_partkey ORDER BY (abs(r.p_size - d.p_size) / reach
    + CASE WHEN r.p_brand = d.p_brand THEN 0.0 ELSE 1.0 END::DOUBLE + CASE WHEN r.p_type = d.p_type THEN 0.0 ELSE 1.0 END::DOUBLE) / 3.0::DOUBLE, d.p_partkey) <= 5),
filled AS (SELECT p_partkey, CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS price FROM near GROUP BY 1)
SELECT s.p_partkey, s.p_size, s.p_brand, s.p_type, coalesce(s.price, f.price) AS price FROM src s LEFT JOIN filled f USING (p_partkey)""",
)
def fea_impute_knn(spark: SparkSession, root: str) -> DataFrame:
    """Unknown prices from the five most similar parts."""
    price = F.when(~F.col("p_name").startswith("red"), F.col("p_retailprice"))
    rows = table(spark, root, "part").select("p_partkey", "p_size", "p_brand", "p_type", price.alias("price"))
    return impute.impute_knn(rows, "p_partkey", "price", "p_size", ["p_brand", "p_type"], 5, scale=2)


ORDER_FACTS = """lines AS (SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
  CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS taxes FROM lineitem GROUP BY 1),
facts AS (SELECT o_orderkey, CASE WHEN o_orderkey % 25 <> 3 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 25 <> 4 THEN c_mktsegment END AS segment,
  CAST(o_orderdate AS DATE) - DATE '1992-01-01' AS day, c_acctbal AS balance, n_lines, quantity, taxes, o_orderpriority AS priority, c_nationkey AS nation
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN lines ON o_orderkey = l_orderkey)"""
NUMBERS, CATEGORIES = ("day", "balance", "n_lines", "quantity", "taxes"), ("priority", "segment", "nation")


def order_facts(spark: SparkSession, root: str) -> DataFrame:
    """Orders with eight predictors; one price and one segment in 25 unknown."""
    lines = table(spark, root, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), exact_sum("l_quantity").alias("quantity"), exact_sum("l_tax").alias("taxes")
    )
    people = table(spark, root, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    joined = orders.join(people, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    left = F.col("o_orderkey") % 25
    return joined.select(
        "o_orderkey",
        F.when(left != 3, F.col("o_totalprice")).alias("price"),
        F.when(left != 4, F.col("c_mktsegment")).alias("segment"),
        F.datediff("o_orderdate", F.lit("1992-01-01")).alias("day"),
        F.col("c_acctbal").alias("balance"),
        "n_lines",
        "quantity",
        "taxes",
        F.col("o_orderpriority").alias("priority"),
        F.col("c_nationkey").alias("nation"),
    )


def _gower(numbers: tuple[str, ...], categories: tuple[str, ...]) -> str:
    parts = [f"abs(a.{c} - b.{c})::DOUBLE / r.{c}" for c in numbers]
    parts += [f"CASE WHEN a.{c} IS NOT DISTINCT FROM b.{c} THEN 0.0 ELSE 1.0 END::DOUBLE" for c in categories]
    return f"({' + '.join(parts)}) / {len(parts)}::DOUBLE"


@query(
    "fea_knn_all",
    f"""WITH {ORDER_FACTS}, r AS (SELECT {', '.join(f'(max({c}) - min({c}))::DOUBLE AS {c}' for c in NUMBERS)} FROM facts),
near AS (SELECT a.o_orderkey, b.price FROM facts a, facts b, r WHERE a.price IS NULL AND b.price IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a.o_orderkey ORDER BY {_gower(NUMBERS, CATEGORIES)}, b.o_orderkey) <= 5),
prices AS (SELECT o_orderkey, CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS filled FROM near GROUP BY 1),
alike AS (SELECT a.o_orderkey, b.segment FROM facts a, facts b, r WHERE a.segment IS NULL AND b.segment IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a.o_orderkey ORDER BY {_gower(NUMBERS, ('priority', 'nation'))}, b.o_orderkey) <= 5),
votes AS (SELECT o_orderkey, segment, row_number() OVER (PARTITION BY o_orderkey ORDER BY count(*) DESC, segment) AS place FROM alike GROUP BY 1, 2)
SELECT f.o_orderkey, coalesce(f.price, p.filled) AS price, coalesce(f.segment, v.segment) AS segment
FROM facts f LEFT JOIN prices p USING (o_orderkey) LEFT JOIN (SELECT * FROM votes WHERE place = 1) v USING (o_orderkey)""",
)
def fea_knn_all(spark: SparkSession, root: str) -> DataFrame:
    """Unknown prices and segments from the five most similar orders by all other columns."""
    rows = cut_lineage(order_facts(spark, root))
    models = [neighbours.fit(rows, "o_orderkey", target, NUMBERS, CATEGORIES, 5) for target in ("price", "segment")]
    return neighbours.impute(models, rows, scale=2).select("o_orderkey", "price", "segment")


@query(
    "fea_knn_folds",
    f"""WITH {ORDER_FACTS}, known AS (SELECT *, CAST(o_orderkey % 3 AS INT) AS fold FROM facts),
r AS (SELECT i, {', '.join(f'(max({c}) - min({c}))::DOUBLE AS {c}' for c in NUMBERS)} FROM known, range(3) t(i) WHERE fold <> i GROUP BY i),
near AS (SELECT a.fold, a.o_orderkey, a.price AS truth, b.price,
    row_number() OVER (PARTITION BY a.o_orderkey ORDER BY {_gower(NUMBERS, CATEGORIES)}, b.o_orderkey) AS nth
  FROM known a JOIN known b ON a.fold <> b.fold JOIN r ON r.i = a.fold WHERE a.price IS NOT NULL AND b.price IS NOT NULL QUALIFY nth <= 9),
guess AS (SELECT k, fold, o_orderkey, truth, avg(price) AS e FROM near, (VALUES (1), (3), (5), (9)) t(k) WHERE nth <= k GROUP BY ALL)
SELECT CAST(k AS INT) AS k, fold, count(*) AS n, round(sqrt(avg((truth - e) * (truth - e))), 3) AS rmse FROM guess GROUP BY 1, 2""",
)
def fea_knn_folds(spark: SparkSession, root: str) -> DataFrame:
    """Errors of 1, 3, 5 and 9 neighbours over three folds, ranges and donors from the other folds."""
    rows = order_facts(spark, root).withColumn("fold", (F.col("o_orderkey") % 3).cast("int"))
    tuned = neighbours.tune(cut_lineage(rows), "o_orderkey", "price", NUMBERS, CATEGORIES, (1, 3, 5, 9), 3)
    return tuned.withColumn("rmse", F.round("rmse", 3))


HORIZON = 28


def _roll(k: int) -> str:
    f = f"(PARTITION BY category, identifier ORDER BY date ROWS BETWEEN {k // 2} PRECEDING AND {(k + 1) // 2 - 1} FOLLOWING)"
    c = f"value_lag{HORIZON}"
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) OVER {f} AS DOUBLE) / nullif(count({c}) OVER {f}, 0) AS {c}_roll_{k}"


@query(
    "hier_features",
    f"""WITH base AS (SELECT r_name, c_mktsegment, CAST(o_orderdate AS DATE) AS date, o_totalprice AS v
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
levels AS (SELECT category, identifier, date, CAST(SUM(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS value FROM (
  SELECT 'all' AS category, 'all' AS identifier, date, v FROM base UNION ALL SELECT 'region', r_name, date, v FROM base
  UNION ALL SELECT 'segment', c_mktsegment, date, v FROM base) GROUP BY 1, 2, 3),
grid AS (SELECT category, identifier, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM levels GROUP BY 1, 2),
padded AS (SELECT g.*, coalesce(l.value, 0.0) AS value FROM grid g LEFT JOIN levels l USING (category, identifier, date)),
extended AS (SELECT * FROM padded UNION ALL SELECT category, identifier, max(date) + CAST(h AS INT), NULL
  FROM padded, (SELECT unnest(range(1, {HORIZON + 1})) AS h) GROUP BY category, identifier, h),
lagged AS (SELECT *, lag(value, {HORIZON}) OVER (PARTITION BY category, identifier ORDER BY date) AS value_lag{HORIZON} FROM extended)
SELECT category, identifier, date, value, value_lag{HORIZON}, {', '.join(_roll(k) for k in (7, 14, 28, 56))} FROM lagged""",
)
def hier_features(spark: SparkSession, root: str) -> DataFrame:
    """From orders to the model table of a hierarchy: totals, gaps, future, lag, rolling means."""
    customers = table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nations = table(spark, root, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    regions = table(spark, root, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    rows = order_days(spark, root).join(customers, "o_custkey").join(nations, "c_nationkey").join(regions, "n_regionkey")
    levels = kept(aggregates.hierarchy(rows, {"region": "r_name", "segment": "c_mktsegment"}, "date", "spend", scale=2))
    ids = ["category", "identifier"]
    padded = kept(calendar.pad(levels, ids, "date", "day", 0.0))
    extended = calendar.with_future(padded, ids, "date", HORIZON, "day")
    lagged = windows.add_lags(extended, ids, "date", "value", [HORIZON])
    return windows.add_rolling_mean(lagged, ids, "date", f"value_lag{HORIZON}", [7, 14, 28, 56], scale=2)
