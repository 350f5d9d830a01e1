"""Hold-outs by time, random splits, folds. Every split is a column, not a copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidalframe.functions import dates
from tidalframe.operators.ordered import hashed_cuts, hashed_place

TRAIN, TEST = "training", "testing"


def last_dates_cutoff(df: DataFrame, date: str, n: int) -> Column:
    """The n-th last distinct date as a scalar: rows from it on are held out.

    The distinct dates are ranked by a top-n, so no task sorts them all.
    """
    top = df.select(date).distinct().orderBy(F.col(date).desc()).limit(n)
    return top.agg(F.min(date)).scalar()


def time_split(df: DataFrame, date: str, assess: int | str) -> DataFrame:
    """Add ``role``. A number holds out that many last dates, a period that time."""
    if isinstance(assess, int):
        held = F.col(date) >= last_dates_cutoff(df, date, assess)
    else:
        end = df.agg(F.max(date).alias("_end"))
        held = F.col(date) > end.select(dates.minus("_end", assess)).scalar()
    return df.withColumn("role", F.when(held, TEST).otherwise(TRAIN))


def time_folds(df: DataFrame, date: str, assess: int, slices: int, skip: int | None = None) -> DataFrame:
    """Expanding backtest slices as (slice_id, role) rows.

    Slice 1 holds out the last ``assess`` dates, slice 2 the ones ``skip`` dates
    earlier, and so on; training is everything before. A row is repeated once
    per slice it takes part in.
    """
    skip = skip or assess
    need = assess + skip * (slices - 1)
    recent = df.select(date).distinct().orderBy(F.col(date).desc()).limit(need)
    back = recent.agg(F.sort_array(F.collect_set(date), asc=False).alias("_d")).scalar()
    out = []
    for i in range(slices):
        first = F.try_element_at(back, F.lit(assess + skip * i))
        last = F.try_element_at(back, F.lit(1 + skip * i))
        role = F.when(F.col(date) < first, TRAIN).when(F.col(date) <= last, TEST)
        out.append(F.struct(F.lit(i + 1).alias("slice_id"), role.alias("role")))
    return df.select("*", F.inline(F.array(*out))).where(F.col("role").isNotNull())


def training(df: DataFrame) -> DataFrame:
    return df.where(F.col("role") == TRAIN).drop("role")


def testing(df: DataFrame) -> DataFrame:
    return df.where(F.col("role") == TEST).drop("role")


def _with_cuts(df: DataFrame, cuts: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Bring one row of cuts per stratum to the rows (one row in all without strata)."""
    if not by:
        one = cuts.select(F.struct(*names).alias("c")).scalar()
        return df.withColumns({n: one[n] for n in names})
    renamed = cuts.select(*[F.col(c).alias(f"_k_{c}") for c in by], *names)
    match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
    return df.join(renamed, match, "left").drop(*[f"_k_{c}" for c in by])


def random_split(
    df: DataFrame, key: str | Sequence[str], prop: float, strata: Sequence[str] = (), seed: int = 1
) -> DataFrame:
    """Add ``role``: exactly floor(prop·n) rows of every stratum are training.

    Rows are ordered by a hash of their key, so a rerun gives the same split.
    """
    quota = {"_cut": F.floor(F.col("_size") * F.lit(prop))}
    cuts = hashed_cuts(df, key, strata, quota, seed)
    train = hashed_place(key, seed) <= F.col("_cut")
    role = F.when(train, TRAIN).otherwise(TEST).alias("role")
    return _with_cuts(df, cuts, strata, ["_cut"]).select(*df.columns, role)


def folds(
    df: DataFrame, key: str | Sequence[str], v: int, strata: Sequence[str] = (), seed: int = 1
) -> DataFrame:
    """Add ``fold`` 0..v-1, as even as possible within every stratum."""
    size = F.col("_size")
    ends, quotas = F.lit(0), {}
    for f in range(v - 1):
        ends = ends + F.floor((size - f + v - 1) / v)
        quotas[f"_cut{f}"] = ends
    cuts = hashed_cuts(df, key, strata, quotas, seed)
    place = hashed_place(key, seed)
    fold = F.lit(0)
    for name in quotas:
        fold = fold + F.when(place > F.col(name), 1).otherwise(0)
    return _with_cuts(df, cuts, strata, list(quotas)).select(*df.columns, fold.alias("fold"))


def split_by_id(df: DataFrame, id: str, prop: float, seed: int = 1) -> DataFrame:
    """Add ``role`` so that round(prop·n) of the distinct ids are training.

    The rows are only compared with one cut place; they are not joined.
    """
    quota = {"_cut": F.floor(F.col("_size") * F.lit(prop) + 0.5)}
    cuts = hashed_cuts(df.select(id).distinct(), id, [], quota, seed)
    train = hashed_place(id, seed) <= F.col("_cut")
    role = F.when(train, TRAIN).otherwise(TEST).alias("role")
    return _with_cuts(df, cuts, [], ["_cut"]).select(*df.columns, role)


def sample_rows(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 1) -> DataFrame:
    """A reproducible random sample of ``n`` rows, taken as a distributed top-n."""
    return df.orderBy(hashed_place(key, seed)).limit(n)


def plan_summary(df: DataFrame, date: str, by: Sequence[str] = ("role",)) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(date).alias("start"), F.max(date).alias("end")
    )


def series_tail_split(panel: DataFrame, ids: Sequence[str], date: str, n: int) -> DataFrame:
    """Add ``role``: the last ``n`` rows of each series are testing."""
    w = Window.partitionBy(*ids).orderBy(F.col(date).desc())
    return panel.withColumn("role", F.when(F.row_number().over(w) <= n, TEST).otherwise(TRAIN))
