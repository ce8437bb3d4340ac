"""Bronze landing and the silver jobs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake import schemas
from rosterlake.operators.cleaning import dedup_in_blocks, silver_stamp
from rosterlake.session import LakeLayout
from rosterlake.sources.tables import parquet_files, read_table, write_parquet, write_silver

# table -> key columns of its silver job
SILVER_JOBS = {
    "staff_master": ["staff_id"],
    "staff_timesheet": ["timesheet_id"],
    "patient_assignment": ["assignment_id"],
    "leave_records": ["leave_id"],
}


def list_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the *.parquet files or folders directly in ``folder``, on any Hadoop store."""
    below = F.regexp_extract("path", f"{re.escape(folder.rstrip('/'))}/([^/]+)\\.parquet(/|$)", 1)
    names = parquet_files(spark, folder).select(below.alias("name")).where("name <> ''").distinct()
    return sorted(row.name for row in names.collect())


def land_bronze(
    spark: SparkSession, source: str, layout: LakeLayout, tables: Sequence[str] | None = None
) -> list[str]:
    """Copy every parquet table of a folder into the bronze layer, replacing what is there.

    Each table is a distributed read and write. The known tables are checked against their
    schema on the way; others are landed as they are.
    """
    landed = list(list_tables(spark, source) if tables is None else tables)
    for table in landed:
        path = f"{source.rstrip('/')}/{table}.parquet"
        df = read_table(spark, path, schemas.TABLES.get(table))
        write_parquet(df, layout.bronze(table))
    return landed


def read_bronze(spark: SparkSession, layout: LakeLayout, table: str) -> DataFrame:
    return read_table(spark, layout.bronze(table), schemas.TABLES.get(table))


def clean_for_silver(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key, stamped with the time of processing.

    Without an order of their own, rows of one key are ordered by all other columns, so that
    a repeated run keeps the same row. The keys are read once when this is called.
    """
    if order_by is None:
        order_by = [F.col(name) for name in df.columns if name not in keys]
    return dedup_in_blocks(df, keys, order_by).transform(silver_stamp)


def run_silver_job(
    spark: SparkSession,
    layout: LakeLayout,
    table: str,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str | Column] | None = None,
) -> str:
    """Bronze table -> one row per key -> silver table; returns the silver path."""
    keys = SILVER_JOBS[table] if keys is None else keys
    cleaned = clean_for_silver(read_bronze(spark, layout, table), keys, order_by)
    path = layout.silver(table)
    write_silver(cleaned, path, layout.table_format)
    return path


def run_silver_jobs(spark: SparkSession, layout: LakeLayout) -> dict[str, str]:
    """The silver jobs of all declared tables."""
    return {table: run_silver_job(spark, layout, table) for table in SILVER_JOBS}
