"""Tables in the shared folder, written once and read by later steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.session import shared_folder


def written(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that a lost executor costs no more than a read."""
    path = shared_folder(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
