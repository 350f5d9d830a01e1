"""Aggregations: levels of a hierarchy, profiles, diagnostics, correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidalframe.functions import dates
from tidalframe.functions.exact import decimal, total
from tidalframe.operators.joins import by_group
from tidalframe.operators.ordered import counted, quantiles_of_counts


def hierarchy(
    df: DataFrame, levels: dict[str, str], date: str, value: str, scale: int | None = None
) -> DataFrame:
    """Totals by date for every level, as (category, identifier, date, value).

    ``levels`` maps category names to id columns. Rows are first added up at the
    finest grain; only those cells are expanded over the grouping sets.
    """
    cols = list(levels.values())
    cells = df.groupBy(*cols, date).agg(F.sum(decimal(value, scale)).alias("_v"))
    sets = [[F.col(date)], *[[F.col(c), F.col(date)] for c in cols]]
    grouped = cells.groupingSets(sets, *cols, date).agg(
        F.sum("_v").cast("double").alias("_total"), *[F.grouping(c).alias(f"_g_{c}") for c in cols]
    )
    category, identifier = F.lit("all"), F.lit("all")
    for name, c in levels.items():
        chosen = F.col(f"_g_{c}") == 0
        category = F.when(chosen, F.lit(name)).otherwise(category)
        identifier = F.when(chosen, F.col(c).cast("string")).otherwise(identifier)
    return grouped.select(
        category.alias("category"), identifier.alias("identifier"), F.col(date), F.col("_total").alias("value")
    )


def by_period(df: DataFrame, by: Sequence[str], date: str, unit: str, *aggs) -> DataFrame:
    """Group by calendar period."""
    return df.groupBy(*by, dates.floor_to(date, unit).alias(date)).agg(*aggs)


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and share per column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns],
    )
    long = counts.unpivot(["_n"], df.columns, "column_name", "n_missing")
    return long.select(
        "column_name", "n_missing", F.try_divide("n_missing", "_n").alias("pct_missing")
    )


def profile(df: DataFrame, cols: Sequence[str], scale: int | None = None) -> DataFrame:
    """Count, nulls, mean, sd, extremes, quartiles and distinct count per numeric column.

    Everything follows from how often each value of each column occurs.
    """
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in cols], "column_name", "v")
    counts = counted(long, ["column_name"], "v")
    known = F.when(F.col("_v").isNotNull(), F.col("_n"))
    added = total(decimal("_v", scale) * F.col("_n"))
    base = counts.groupBy("column_name").agg(
        F.sum("_n").alias("n"),
        F.sum(F.when(F.col("_v").isNull(), F.col("_n")).otherwise(0)).alias("n_missing"),
        F.try_divide(added, F.sum(known)).alias("mean"),
        F.min("_v").alias("p0"),
        F.max("_v").alias("p100"),
        F.count("_v").alias("n_unique"),
    )
    gap = F.col("_v") - F.col("mean")
    spread = (
        counts.join(base.select("column_name", "mean"), "column_name")
        .groupBy("column_name")
        .agg(F.sqrt(F.try_divide(F.sum(gap * gap * F.col("_n")), F.sum(known) - 1)).alias("sd"))
    )
    quartiles = quantiles_of_counts(counts, ["column_name"], {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    out = base.join(spread, "column_name").join(quartiles, "column_name", "left")
    return out.withColumn("sd", F.round("sd", 4))


def series_diagnostics(panel: DataFrame, ids: Sequence[str], date: str) -> DataFrame:
    """Rows, first and last date, step quantiles in seconds and the likely scale.

    The panel holds one row per series and date, so a series is bounded by the
    calendar.
    """
    w = Window.partitionBy(*ids).orderBy(date)
    step = (F.datediff(date, F.lag(date).over(w)) * 86400).cast("double")
    q = lambda p: F.percentile("_step", F.lit(p))
    out = panel.select(*ids, date, step.alias("_step")).groupBy(*ids).agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.min(date).alias("start"),
        F.max(date).alias("end"),
        F.min("_step").alias("diff_min"),
        q(0.25).alias("diff_q1"),
        q(0.5).alias("diff_median"),
        F.try_divide(F.sum("_step"), F.count("_step")).alias("diff_mean"),
        q(0.75).alias("diff_q3"),
        F.max("_step").alias("diff_max"),
    )
    days = F.col("diff_median") / 86400
    scale = (
        F.when(days < 7, "day").when(days < 28, "week").when(days < 89, "month").when(days < 360, "quarter")
    ).otherwise("year")
    return out.withColumn("scale", scale)


def correlation(wide: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Correlation matrix of columns as (x, y, r) rows, incomplete rows dropped.

    One pass finds means and spreads, a second one adds up the products of the standardised
    columns, whatever their number: each task keeps one triangle of sums, and the driver
    the matrix of the columns. A column that does not vary has no correlation with another.
    """
    full = wide.select(*cols).dropna("any")
    facts = full.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    spark, schema = wide.sparkSession, "x string, y string, r double"
    if not cols or not facts["n"]:
        return spark.createDataFrame([], schema)
    varied = [i for i in range(len(cols)) if facts[f"s{i}"]]
    found: dict[tuple[int, int], float | None] = {}
    if len(varied) > 1:
        scaled = full.select(F.array(*[(F.col(cols[i]) - facts[f"m{i}"]) / facts[f"s{i}"] for i in varied]).alias("v"))
        matrix = Correlation.corr(scaled.select(array_to_vector("v").alias("v")), "v").first()[0].toArray()
        found = {(i, j): float(matrix[a, b]) for a, i in enumerate(varied) for b, j in enumerate(varied)}
    rows = [(x, y, 1.0 if i == j else found.get((i, j))) for i, x in enumerate(cols) for j, y in enumerate(cols)]
    return spark.createDataFrame(rows, schema).withColumn("r", F.round("r", digits))


def autocorrelation(panel: DataFrame, ids: Sequence[str], date: str, value: str, lags: int) -> DataFrame:
    """Autocorrelation per series for lags 0..``lags``."""
    ids = list(ids)
    whole = Window.partitionBy(*ids)
    w = whole.orderBy(date)
    centred = panel.select(*ids, date, (F.col(value) - F.avg(value).over(whole)).alias("_c"))
    shifted = centred.select(
        *ids, "_c", *[F.lag("_c", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)]
    )
    sums = shifted.groupBy(*ids).agg(
        F.sum(F.col("_c") * F.col("_c")).alias("_l0"),
        *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_l{k}") for k in range(1, lags + 1)],
    )
    cells = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), F.try_divide(f"_l{k}", "_l0").alias("acf"))
            for k in range(lags + 1)
        ]
    )
    return sums.select(*ids, F.inline(cells))


def partial_autocorrelation(acf: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Partial autocorrelation from an autocorrelation table, by Levinson's recursion.

    One group is one series' short list of lags.
    """
    ids = list(ids)
    fields = [acf.schema[c] for c in ids]
    schema = T.StructType([*fields, T.StructField("lag", T.IntegerType()), T.StructField("pacf", T.DoubleType())])

    def solve(pdf):
        import pandas as pd

        rho = pdf.sort_values("lag")["acf"].to_numpy()
        phi: list[float] = []
        out = []
        for k in range(1, len(rho)):
            num = rho[k] - sum(p * rho[k - 1 - j] for j, p in enumerate(phi))
            den = 1.0 - sum(p * rho[j + 1] for j, p in enumerate(phi))
            last = num / den if den else float("nan")
            phi = [p - last * phi[k - 2 - j] for j, p in enumerate(phi)] + [last]
            out.append(last)
        frame = pd.DataFrame({c: [pdf[c].iloc[0]] * len(out) for c in ids})
        frame["lag"] = range(1, len(out) + 1)
        frame["pacf"] = out
        return frame

    return acf.groupBy(*ids).applyInPandas(solve, schema)


def seasonal_profile(df: DataFrame, date: str, value: str) -> DataFrame:
    """Distribution of a value by weekday, month, quarter and year."""
    keyed = df.select(
        F.col(value).alias("_v"),
        F.dayofweek(date).alias("weekday"),
        F.month(date).alias("month"),
        F.quarter(date).alias("quarter"),
        F.year(date).alias("year"),
    )
    long = keyed.unpivot(["_v"], ["weekday", "month", "quarter", "year"], "feature", "level")
    counts = counted(long.withColumnRenamed("_v", "v"), ["feature", "level"], "v")
    base = counts.groupBy("feature", "level").agg(
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)).alias("n"),
        F.min("_v").alias("lowest"),
        F.max("_v").alias("highest"),
    )
    box = quantiles_of_counts(counts, ["feature", "level"], {"q1": 0.25, "med": 0.5, "q3": 0.75})
    return by_group(base, box, ["feature", "level"], "left")
