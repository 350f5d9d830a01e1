"""Tables and binary files in the folder that driver and executors share.

The folder is the one named by ``spark.checkpoint.dir``. Tables are written by Spark.
Binary files are written by tasks through ``pyarrow.fs``, which opens local, HDFS and
object-store addresses alike. A file's name is new on every attempt and reaches the
readers only through the manifest table that Spark commits, so a repeated or lost
task leaves at most a file nobody reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalframe.session import scratch


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, computed once: a Parquet table below the shared folder."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(base: str):
    """(file system, path) of a folder's address."""
    from pyarrow import fs

    if "://" not in base and not base.startswith("file:"):
        return fs.LocalFileSystem(), base
    return fs.FileSystem.from_uri(base)


def new_file(base: str, suffix: str):
    """(output stream, address) of a new file in the folder ``base``."""
    system, path = filesystem(base)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return system.open_output_stream(f"{path}/{name}"), f"{base}/{name}"


def read_file(address: str) -> bytes:
    system, path = filesystem(address)
    with system.open_input_stream(path) as f:
        return f.read()


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def met(rows: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """Rows with the one row of their group (same ``key``), however large a group is.

    ``size`` names the column of ``groups`` that says how many rows a group has. A group of
    more than a quarter of a partition's share is sent to the rows: there are at most four
    of them for each partition. The others are small and meet their rows by a shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    share = max(1, total // (4 * partitions(rows)))
    large, small = groups.filter(F.col(size) > share), groups.filter(F.col(size) <= share)
    hot = rows.join(F.broadcast(large), key)
    rest = rows.join(F.broadcast(large.select(key)), key, "left_anti").hint("merge").join(small, key, how)
    return hot.unionByName(rest)


def numbered(df: DataFrame, group: list, order: list, name: str) -> DataFrame:
    """Adds ``name``: numbers without gaps from 0 within each group, also within a huge one.

    A group is cut into buckets by a hash of the order columns, as many as its share of
    all rows asks for; each bucket is numbered by itself and shifted by the sizes of the
    buckets before it. No task holds a whole group. Rows alike in all order columns must
    be interchangeable. ``group`` and ``order`` name columns; ``name`` must be new.
    """
    from pyspark.sql import Window

    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.greatest(F.lit(1.0), F.sum("_rows").over(Window.partitionBy()) / F.lit(4.0 * partitions(df)))
    sizes = counts.withColumn("_buckets", F.ceil(F.col("_rows") / share).cast("long")).drop("_rows")
    cut = df.join(sizes.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_buckets"), [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]).drop(*[f"_g_{g}" for g in group])
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.col("_buckets"))).drop("_buckets")
    held = cut.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    keys = [*group, "_bucket"]
    offsets = offsets.select(*[F.col(k).alias(f"_o_{k}") for k in keys], "_before")
    own = Window.partitionBy(*keys).orderBy(*order)
    ranked = cut.withColumn("_own", F.row_number().over(own) - 1)
    joined = ranked.join(offsets, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys])
    return joined.withColumn(name, (F.col("_before") + F.col("_own")).cast("long")).drop("_before", "_own", "_bucket", *[f"_o_{k}" for k in keys])
