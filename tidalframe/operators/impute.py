"""Nearest-neighbour imputation without pairing every row with every donor.

Distance is Gower's: the mean over features of |a-b|/range for the number and of
0/1 for each category. For every subset of categories, the donors that agree on
that subset are put in order of the number; the nearest ones by number in each
of these orders contain the nearest ones overall. So a row meets a fixed number
of candidates per subset, found by position.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidalframe.functions.exact import mean
from tidalframe.operators.ordered import edges, running_totals, top_rows, with_bucket
from tidalframe.session import cut_lineage


def _subsets(cols: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(cols), -1, -1) for s in combinations(cols, n)]


def _agreements(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """Every row once per subset of the categories, with its values of that subset."""
    views = [
        F.struct(
            F.lit(i).alias("subset"),
            *[(F.col(c).cast("string") if c in subset else F.lit("")).alias(f"v{j}") for j, c in enumerate(cats)],
        )
        for i, subset in enumerate(_subsets(cats))
    ]
    return df.withColumn("_agree", F.explode(F.array(*views)))


def _candidates(
    wanted: DataFrame, donors: DataFrame, key: str, number: str, cats: Sequence[str], k: int, cuts: list[float]
) -> DataFrame:
    """Up to 2k distinct donor numbers around each wanted profile, k donors at each.

    ``wanted`` holds distinct profiles. Returns (profile columns, donor struct).
    """
    cell = ["_agree", number]
    asking, giving = _agreements(wanted, cats), _agreements(donors, cats)
    places = (
        giving.select(*cell).distinct().withColumn("_donor", F.lit(1).cast("long"))
        .unionByName(asking.select(*cell).distinct().withColumn("_donor", F.lit(0).cast("long")))
        .groupBy(*cell).agg(F.max("_donor").alias("_donor"))
    )
    ranked = running_totals(with_bucket(places, number, cuts), ["_agree"], [number], ["_donor"])
    spots = ranked.select(*cell, "_donor", F.col("before__donor").alias("_before"))
    donor_spots = spots.where("_donor = 1").select(
        "_agree", F.col(number).alias("_at"), (F.col("_before") + 1).alias("_rank")
    )
    offsets = F.sequence(F.col("_before") - k + 1, F.col("_before") + k)
    asked = asking.join(spots.drop("_donor"), cell).withColumn("_rank", F.explode(offsets))
    near = asked.join(donor_spots, ["_agree", "_rank"]).select(*wanted.columns, "_agree", "_at")
    named = top_rows(giving, cell, [F.col(key)], k).select(
        "_agree", F.col(number).alias("_at"), F.struct(*donors.columns).alias("_donor")
    )
    return near.join(named, ["_agree", "_at"]).select(*wanted.columns, "_donor")


def gower(number: str, cats: Sequence[str], reach: Column, donor: Column) -> Column:
    parts = [F.coalesce(F.try_divide(F.abs(F.col(number) - donor[number]), reach), F.lit(0.0))]
    parts += [F.when(F.col(c) == donor[c], 0.0).otherwise(1.0) for c in cats]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total / F.lit(float(len(parts)))


def impute_knn(
    df: DataFrame,
    key: str,
    target: str,
    number: str,
    cats: Sequence[str],
    k: int = 5,
    scale: int | None = None,
) -> DataFrame:
    """Fill nulls of ``target`` by the mean of its k nearest donors.

    A null category is a level of its own and a null number counts as the column's mean,
    so every row has a profile; the columns themselves stay as they are.
    Ties in distance go to the smaller key. Rows of one profile share their
    neighbours, so the search runs once per distinct profile; and of the donors
    of one profile only the k smallest keys can ever be chosen, so the search
    runs over those.
    """
    given, own_number, own_cats = df, "_number", [f"_cat{i}" for i in range(len(cats))]
    middle = df.agg(F.avg(number).cast(df.schema[number].dataType)).scalar()
    level = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    df = df.withColumns({own_number: F.coalesce(number, middle), **{o: level(c) for o, c in zip(own_cats, cats, strict=True)}})
    number, cats = own_number, own_cats
    profile = [number, *cats]
    known = df.where(F.col(target).isNotNull()).select(key, target, *profile)
    donors = cut_lineage(top_rows(known, profile, [F.col(key)], k))
    wanted = cut_lineage(df.where(F.col(target).isNull()).select(*profile).distinct())
    cuts = edges(donors.select(number).distinct(), number)
    reach = df.agg((F.max(number) - F.min(number)).cast("double")).scalar()
    found = _candidates(wanted, donors, key, number, cats, k, cuts)
    donor = F.col("_donor")
    scored = found.select(
        *profile,
        gower(number, cats, reach, donor).alias("_distance"),
        donor[key].alias("_key"),
        donor[target].alias("_value"),
    ).distinct()
    w = Window.partitionBy(*profile).orderBy("_distance", "_key")
    kept = scored.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= k)
    filled = kept.groupBy(*profile).agg(mean("_value", scale).alias("_filled"))
    return df.join(filled, profile, "left").select(
        *[F.coalesce(F.col(target), F.col("_filled")).alias(c) if c == target else F.col(c) for c in given.columns]
    )
