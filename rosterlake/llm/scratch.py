"""Tables that an operator writes on its way, in the folder that the whole cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rosterlake.sources.workspace import shared_folder


def store(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once as parquet under ``spark.checkpoint.dir`` and read them from there.

    This cuts the lineage: whatever executor is lost later, the rows are read again and not
    computed again. Each call takes a new folder, so a repeated job never reads another's rows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
