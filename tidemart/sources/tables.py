"""Plain tables: JDBC, dimension scans, comma text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.text import row_text


def jdbc_table(
    spark: SparkSession, url: str, table: str, properties: dict | None = None,
    split_column: str | None = None, bounds: tuple = (), partitions: int = 1,
) -> DataFrame:
    """A database table; give a split column and its bounds to read it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if split_column:
        reader = reader.options(
            partitionColumn=split_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def scan_jdbc_table(table: DataFrame) -> DataFrame:
    """Every row of a table as one comma-joined text."""
    return table.select(row_text(table).alias("value"))


def scan_dim(dim: DataFrame, **conditions) -> DataFrame:
    """Dimension rows whose columns equal the given values; filters reach the scan."""
    out = dim
    for column, value in conditions.items():
        out = out.filter(F.col(column) == F.lit(str(value)))
    return out


def scan_jdbc_dim_sql(table: DataFrame, name: str = "dim_base_province") -> DataFrame:
    """Register the province dimension of a database under a SQL name."""
    dim = table.select(F.col("id").cast("bigint").alias("id"), "name", "area_code", "iso_code")
    dim.createOrReplaceTempView(name)
    return dim


def checked_csv_event(records: DataFrame, value: str = "value") -> DataFrame:
    """Like ``parse_csv_event``, plus ``raw``, the text itself, and ``readable``: it has a time."""
    raw = records.select("*", F.col(value).alias("raw"))
    rows = parse_csv_event(raw, value, "raw")
    return rows.withColumn("readable", F.col("ts").isNotNull())


def parse_csv_event(records: DataFrame, value: str = "value", *keep: str) -> DataFrame:
    """``key,epoch_ms`` text to ``key``, ``n`` = 1 and ``ts``; a text without a time has a null ``ts``."""
    parts = F.split(F.col(value), ",")
    return records.select(
        parts[0].alias("key"), F.lit(1).cast("bigint").alias("n"), F.try_element_at(parts, F.lit(2)).try_cast("bigint").alias("ts"), *keep
    )
