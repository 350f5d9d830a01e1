"""Order statistics without a one-task sort.

A window over a whole table, or over a group holding a third of it, puts that
many rows into one task. Here an order is cut into buckets instead: totals per
bucket give each bucket its offset, and only rows of one (group, bucket) meet in
a task. Bucket edges are a bounded list of numbers read once; which bucket a row
belongs to depends on the row alone, so a recomputed task gives the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidalframe.operators.joins import by_group
from tidalframe.session import cut_lineage, parallelism

BUCKET = "_bucket"


def edges(df: DataFrame, col: str, parts: int | None = None) -> list[float]:
    """Approximate quantiles of a numeric column: at most ``parts - 1`` numbers, as many as the rows ask for."""
    least = parts or parallelism(df.sparkSession, 0)
    quantiles = lambda n: F.percentile_approx(F.col(col).cast("double"), [i / n for i in range(1, n)], 20 * n)
    found, rows = df.agg(quantiles(least), F.count(F.lit(1))).first()
    if not parts and (more := parallelism(df.sparkSession, rows)) > least:
        found = df.agg(quantiles(more)).first()[0]
    return sorted(set(found or []))


def with_bucket(df: DataFrame, col: str, cuts: Sequence[float], out: str = BUCKET) -> DataFrame:
    """Add the order-preserving bucket number of a numeric column."""
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    splits = [-float("inf"), *cuts, float("inf")]
    number = Bucketizer(splits=splits, inputCol="_edge", outputCol=out, handleInvalid="keep")
    return number.transform(df.withColumn("_edge", F.col(col).cast("double"))).drop("_edge")


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    descending: bool = False,
) -> DataFrame:
    """Add ``before_<c>`` (sum over earlier rows of the group) and ``total_<c>``.

    ``df`` needs a bucket column (see ``with_bucket``) and rows that are unique
    by group and order columns.
    """
    by, end = list(by), (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    cell = [*by, BUCKET]
    over_cells = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = over_cells.orderBy(end(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    cells = df.groupBy(*cell).agg(*[F.sum(c).alias(f"_cell_{c}") for c in sums])
    offsets = cells.select(
        *[F.col(c).alias(f"_k_{c}") for c in cell],
        *[F.coalesce(F.sum(f"_cell_{c}").over(earlier), F.lit(0)).alias(f"_offset_{c}") for c in sums],
        *[F.sum(f"_cell_{c}").over(over_cells).alias(f"total_{c}") for c in sums],
    )
    match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cell]
    joined = df.join(offsets, match, "inner")
    in_cell = (
        Window.partitionBy(*cell)
        .orderBy(*[end(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_offset_{c}") + F.coalesce(F.sum(c).over(in_cell), F.lit(0))).alias(f"before_{c}")
            for c in sums
        ],
        *[f"total_{c}" for c in sums],
    )


def row_index(df: DataFrame, order: str, out: str = "row_id", keep: bool = True) -> DataFrame:
    """Dense 1..n over a unique column of any type that can be ordered; without ``keep`` that column is left out.

    The rows are dealt out by ranges of the column, put in order and written down with
    their place in their range, in one shuffle; counts per range give each its offset.
    """
    parts = parallelism(df.sparkSession, df.select(order).count())
    # The number's high bits are the range, its low ones the place in it.
    placed = df.repartitionByRange(parts, order).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id())
    columns = [c for c in df.columns if keep or c != order]
    placed = cut_lineage(placed.select(*columns, "_at")).withColumn(BUCKET, F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_bucket_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(F.col(BUCKET).alias("_bucket_")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_bucket_", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.join(offsets, F.col(BUCKET) == F.col("_bucket_"))
    return numbered.select((F.col("_before") + F.col("_at") + 1).alias(out), *columns)


def counted(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, _v, _n): how often each value occurs per group, written down once.

    Equal values meet before the first shuffle, so a hot group or a hot value
    costs one row per task. Several passes read the counts, hence the checkpoint.
    """
    kept = df.select(*by, F.col(value).cast("double").alias("_v"))
    return cut_lineage(kept.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n")))


def quantiles_of_counts(counts: DataFrame, by: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group of a ``counted`` table; nulls are left out.

    Bucket totals tell which bucket holds each wanted position. Only the rows of
    those buckets are put in order.
    """
    by, known = list(by), counts.where(F.col("_v").isNotNull())
    rows = with_bucket(known, "_v", edges(known, "_v"))
    cell = [*by, BUCKET]
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(*cell).agg(F.sum("_n").alias("_in_cell")).withColumns(
        {"_before": F.coalesce(F.sum("_in_cell").over(earlier), F.lit(0)), "_size": F.sum("_in_cell").over(group)}
    )
    wanted = []
    for name, p in probs.items():
        position = (F.col("_size") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            wanted.append(
                F.struct(
                    F.lit(f"{side}_{name}").alias("_what"),
                    (at - F.col("_before")).alias("_at"),
                    (position - F.floor(position)).alias("_part"),
                )
            )
    inside = lambda w: (w["_at"] >= 0) & (w["_at"] < F.col("_in_cell"))
    asked = cells.withColumn("_asked", F.filter(F.array(*wanted), inside)).where(F.size("_asked") > 0)
    asked = cut_lineage(asked.select(*[F.col(c).alias(f"_k_{c}") for c in cell], "_asked"))
    match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cell]
    in_cell = Window.partitionBy(*cell).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(asked, match).withColumn("_start", F.coalesce(F.sum("_n").over(in_cell), F.lit(0)))
    hit = (F.col("_at") >= F.col("_start")) & (F.col("_at") < F.col("_start") + F.col("_n"))
    found = placed.select(*by, "_v", "_n", "_start", F.inline("_asked")).where(hit)
    ends = found.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("_what") == f"{side}_{name}", F.col(col))).alias(f"_{side}_{name}_{col}")
            for name in probs
            for side, col in (("lo", "_v"), ("hi", "_v"), ("lo", "_part"))
        ]
    )
    out = []
    for name in probs:
        low, high, part = (F.col(f"_{x}_{name}_{c}") for x, c in (("lo", "_v"), ("hi", "_v"), ("lo", "_part")))
        out.append((low + (high - low) * part).alias(name))
    return ends.select(*by, *out)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Exact interpolated quantiles per group, one output column per entry."""
    return quantiles_of_counts(counted(df, by, value), by, probs)


def hashed(key: str | Sequence[str], seed: int) -> Column:
    """Seeded hash of a row's key."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.xxhash64(F.lit(seed), *keys)


def hashed_place(key: str | Sequence[str], seed: int) -> Column:
    """A row's place in a random but reproducible order: its hash, then its key."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.struct(hashed(keys, seed).alias("hash"), *[F.col(k) for k in keys])


def hashed_cuts(
    df: DataFrame,
    key: str | Sequence[str],
    by: Sequence[str],
    quotas: dict[str, Column],
    seed: int,
    bits: int = 16,
) -> DataFrame:
    """Per stratum, the place of the row at which each quota is filled.

    A quota is an expression of ``_size``, the stratum's row count. Rows are
    counted per leading bits of their hash; only the rows of the one cell in
    which a quota is filled are put in order. The result has one row per stratum
    (by, one place per quota), so applying it to the rows needs no shuffle.
    """
    by, cell_of = list(by), F.shiftright(hashed(key, seed), 64 - bits)
    rows = df.select(*by, cell_of.alias("_cell"), hashed_place(key, seed).alias("_place"))
    cells = rows.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    stratum = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = stratum.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumns(
        {"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_size": F.sum("_n").over(stratum)}
    )
    wanted = [
        F.struct(F.lit(name).alias("_quota"), (q.cast("long") - F.col("_before")).alias("_nth")) for name, q in quotas.items()
    ]
    filled = placed.select(*[F.col(c).alias(f"_k_{c}") for c in (*by, "_cell")], "_n", F.inline(F.array(*wanted)))
    filled = cut_lineage(filled.where((F.col("_nth") > 0) & (F.col("_nth") <= F.col("_n"))).drop("_n"))
    match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*by, "_cell")]
    asked = rows.join(filled, match)
    order = Window.partitionBy(*by, "_cell", "_quota").orderBy("_place")
    at = asked.withColumn("_row", F.row_number().over(order)).where("_row = _nth")
    strata = cells.select(*by).distinct() if by else None
    found = at.groupBy(*by).agg(
        *[F.max(F.when(F.col("_quota") == name, F.col("_place"))).alias(name) for name in quotas]
    )
    return cut_lineage(found if strata is None else by_group(strata, found, by, "left"))


def top_rows(df: DataFrame, by: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """First ``n`` rows per group by a total order.

    Spark trims every group to ``n`` rows inside each map task before the
    shuffle, so a hot group never travels whole.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(w)).where(F.col("_row") <= n).drop("_row")


def slice_extreme(df: DataFrame, by: Sequence[str], value: str, largest: bool = False) -> DataFrame:
    """Rows holding their group's smallest (or largest) value, ties kept.

    Each input partition keeps only its own winners per group, before anything
    is shuffled; the winners of a hot group stay spread over as many tasks as
    there were input partitions. The true extreme, a partial aggregate, then
    picks among them by a semi join on (group, value).
    """
    by = list(by)
    order = F.col(value).desc() if largest else F.col(value).asc_nulls_last()
    local = Window.partitionBy(*by, "_part").orderBy(order)
    winners = (
        df.withColumn("_part", F.spark_partition_id())
        .withColumn("_rank", F.rank().over(local))
        .where(F.col("_rank") == 1)
        .drop("_part", "_rank")
    )
    best = df.groupBy(*by).agg((F.max if largest else F.min)(value).alias(value))
    return by_group(winners, best, [*by, value], "left_semi")
