"""Text files: headed CSV, directories of CSV, headerless delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidalframe.functions.names import clean_names


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Headed CSV. Without a schema Spark reads the data twice to infer one."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_dir(
    spark: SparkSession, path: str, schema: StructType | str | None = None, glob: str = "*.csv"
) -> DataFrame:
    """Every CSV below a directory as one table with clean names and a ``path`` column."""
    reader = (
        spark.read.option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    raw = reader.csv(path)
    return clean_names(raw.select(F.col("_metadata.file_path").alias("path"), *raw.columns))


def read_blank_separated(spark: SparkSession, path: str, n_fields: int) -> DataFrame:
    """Headerless text split on runs of blanks into ``X1`` … ``Xn``."""
    fields = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).select(
        *[F.try_element_at(fields, F.lit(i)).alias(f"X{i}") for i in range(1, n_fields + 1)]
    )


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
