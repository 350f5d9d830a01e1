"""Batch functions run on streams. A run takes all the input there is and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidalframe.functions.exact import total
from tidalframe.session import scratch


def read_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table as a stream of its files: a folder's, or the one file the path is."""
    reader = spark.readStream.schema(schema)
    files = spark.read.schema(schema).parquet(path).inputFiles()
    folder, _, name = path.rstrip("/").rpartition("/")
    if len(files) == 1 and files[0].rpartition("/")[2] == name:
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.option("recursiveFileLookup", "true").parquet(path)


def windowed_totals(
    stream: DataFrame,
    time: str,
    by: list[str],
    value: str,
    late: str | None,
    width: str = "1 day",
    scale: int | None = None,
) -> DataFrame:
    """Totals per key and tumbling window.

    Rows that come more than ``late`` after a later one are not waited for; with None all
    are, whatever the order of the files, and the state holds every window of the input.
    """
    return (
        (stream.withWatermark(time, late) if late else stream)
        .groupBy(*by, F.window(time, width).alias("w"))
        .agg(total(value, scale).alias("total"), F.count(F.lit(1)).alias("n"))
        .select(*by, F.col("w.start").alias("start"), "total", "n")
    )


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that a run left out because they came too late."""
    return sum(state.numRowsDroppedByWatermark for p in query.recentProgress for state in p.stateOperators)


def run_updates(result: DataFrame, name: str, keys: list[str], may_drop: bool = False) -> DataFrame:
    """Run an aggregating stream to the end and read its latest row per key.

    Rows dropped for being late are an error unless ``may_drop``.
    Each micro-batch writes the rows it changed under its own number, so a batch
    that is repeated after a failure overwrites itself.
    """
    spark = result.sparkSession
    out, state = scratch(spark, name), scratch(spark, name + "-state")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        result.writeStream.outputMode("update")
        .option("checkpointLocation", state)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if (dropped := dropped_rows(query)) and not may_drop:
        raise ValueError(f"{dropped} rows came too late for their window")
    written = spark.read.option("basePath", out).parquet(out)
    values = [c for c in result.columns if c not in keys]
    latest = F.max_by(F.struct(*values), "batch").alias("_row")
    return written.groupBy(*keys).agg(latest).select(*keys, "_row.*")


def run_append(result: DataFrame, name: str) -> DataFrame:
    """Run a row-by-row stream into Parquet and read it back."""
    spark = result.sparkSession
    out, state = scratch(spark, name), scratch(spark, name + "-state")
    query = (
        result.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(out)

