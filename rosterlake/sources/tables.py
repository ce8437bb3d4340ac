"""Reading and writing tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.schemas import conform
from rosterlake.session import prepare

# about a third smaller than Spark's default for parquet
COMPRESSION = "zstd"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A parquet table. With a schema its columns are checked and brought to their types.

    The file's own types are read, not forced: pandas files hold unsigned numbers and
    nanosecond timestamps, which would fail under a declared read schema.
    """
    df = prepare(spark).read.parquet(path)
    return df if schema is None else conform(df, schema)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``; one file per task, no gathering into a single file."""
    writer = df.write.mode("overwrite").partitionBy(*(partition_by or []))
    writer.parquet(path, compression=COMPRESSION)


def write_silver(df: DataFrame, path: str, table_format: str = "parquet") -> None:
    """Full refresh of a lake table in the layout's format. A format that is not on the classpath
    fails by its name; what is installed never decides which format a table has."""
    options = {"compression": COMPRESSION} if table_format == "parquet" else {}
    df.write.format(table_format).mode("overwrite").options(**options).save(path)


def read_silver(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    return prepare(spark).read.format(table_format).load(path)


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of the parquet files at or below ``path``, on any Hadoop store; their
    content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", "*.parquet").load(path).select("path", "length")


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """table_name, file_count, byte_count of tables by name, from the listing of their files."""
    return reduce(
        DataFrame.unionByName,
        [
            parquet_files(spark, path)
            .agg(F.count("*").alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("byte_count"))
            .select(F.lit(name).alias("table_name"), "file_count", "byte_count")
            for name, path in paths.items()
        ],
    )
