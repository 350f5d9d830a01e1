"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


# Folders made for sessions without a named one, by application.
_own: dict[str, str] = {}


def build_session(master: str = "local[8]", app: str = "tidalframe", **conf: str) -> SparkSession:
    """Start (or fetch) a session with the settings the library expects.

    Broadcast joins are left to Spark: a side is broadcast only when its file
    statistics or its measured shuffle size are below the threshold.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where that is unset, one given to the context by ``setCheckpointDir`` counts. A folder
    of our own, removed at the end, is made only for an in-process master, where driver
    and executors share one disk; a real cluster has to name its folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    base = base or _own.get(context.applicationId)
    if not base:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _own[context.applicationId] = tempfile.mkdtemp(prefix="tidalframe-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tidalframe/{app}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, computed once.

    It survives the loss of any executor; later reads are pruned by column and filter,
    and its size on disk tells Spark whether it can be broadcast.
    """
    path = scratch(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_by(df: DataFrame, column: str) -> DataFrame:
    """As ``cut_lineage``, with a folder for each value of a column of few values: a filter on it reads only its folders."""
    path = scratch(df.sparkSession, "rows")
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def spread(df: DataFrame) -> DataFrame:
    """Rows held by the executors for a fit that reads them many times.

    What is lost with an executor is read again from the source. Rows are dealt anew only
    where the source has fewer partitions than the cluster has cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < cores
    return (df.repartition(cores) if few else df).persist(StorageLevel.MEMORY_AND_DISK)


# Rows that one ordered bucket should hold.
BUCKET_ROWS = 500_000


def parallelism(spark: SparkSession, rows: int) -> int:
    """How many ordered buckets to cut an order of that many rows into."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(64, 2 * shuffle, -(-rows // BUCKET_ROWS))
