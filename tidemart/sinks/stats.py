"""Statistics sinks."""

from __future__ import annotations

import re
import time
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLOSED = re.compile(r"/day=([^/]+)/closed=([^/]+)/")


def write_stats(df: DataFrame, path: str, batch_id: int | None = None, writer: str | None = None, rows_per_file: int = 1 << 20, together: bool = False) -> None:
    """Add a batch of statistics by day of ``stt``; a writer's retried batch replaces itself.

    A batch without a number and a writer is one of its own. A day gets a file for every ``rows_per_file`` rows, so a small
    day has one; files are dealt out over all cores, with or without adaptive execution. ``together`` says that the rows
    of a day lie in as few tasks as that already: they are written from there, neither cached nor shuffled.
    """
    if (batch_id is None) != (writer is None):
        raise ValueError("a batch number and its writer go together")
    name = uuid4().hex if writer is None else f"{writer}-{batch_id}"
    # day and batch are added after the shuffle: neither is cached or shuffled with every row
    rows = df if together else df.persist()
    dealt = rows if together else _by_size(rows, rows_per_file, F.substring("stt", 1, 10))
    placed = dealt.withColumns({"day": F.substring("stt", 1, 10), "batch": F.lit(name)})
    out = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch")
    (out.option("maxRecordsPerFile", rows_per_file) if together else out).parquet(f"{path}/batches")
    if not together:
        rows.unpersist()


def _by_size(rows: DataFrame, rows_per_file: int, day=None) -> DataFrame:
    """Rows dealt out by ``day`` (the column of that name by default), those of a large day by a hash over as many tasks as it needs files."""
    day = F.col("day") if day is None else day
    # no more than one row for each file's worth of rows
    counts = rows.groupBy(day.alias("_day")).count().filter(F.col("count") > rows_per_file).collect()
    large = {r["_day"]: -(-r["count"] // rows_per_file) for r in counts}
    salt = F.lit(0).cast("long")
    for each, files in large.items():
        salt = F.when(day.eqNullSafe(F.lit(each)), F.pmod(F.xxhash64(*rows.columns), F.lit(files))).otherwise(salt)
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, day, salt)


def _stored(spark: SparkSession, path: str, schema: T.StructType | None, names: str, day: str | None) -> DataFrame | None:
    """The files of one day or of all, ``names`` being the other columns; None if there are none."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, *T.StructType.fromDDL(f"day STRING, {names}").fields]))
    try:
        rows = reader.parquet(path if day is None else f"{path}/day={day}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.withColumn("day", F.col("day").cast("string")).withColumn("batch", F.col("batch").cast("string"))


def _closed(rows: DataFrame | None) -> DataFrame | None:
    """The newest compacted rows of every day."""
    if rows is None:
        return None
    newest: dict[str, str] = {}
    for f in rows.inputFiles():
        found = CLOSED.search(f)
        newest[found.group(1)] = max(found.group(2), newest.get(found.group(1), ""))
    return rows.filter(F.concat_ws("/", "day", "closed").isin([f"{d}/{s}" for d, s in newest.items()])).drop("closed")


def _batches_and_closed(spark: SparkSession, path: str, schema: T.StructType | None, day: str | None) -> DataFrame | None:
    """Every batch once: compacted, or as it was written if no compaction has it."""
    batches = _stored(spark, f"{path}/batches", schema, "batch STRING", day)
    closed = _closed(_stored(spark, f"{path}/compacted", schema, "batch STRING, closed STRING", day))
    if batches is None or closed is None:
        return batches if closed is None else closed
    done = closed.select("day", "batch").distinct()
    if day is None:
        batches = batches.join(done, ["day", "batch"], "left_anti")
    else:  # a row per batch of one day; the scan leaves their folders out
        batches = batches.filter(~F.col("batch").isin([r.batch for r in done.collect()]))
    return batches.unionByName(closed)


def read_stats(spark: SparkSession, path: str, schema: T.StructType | None = None, day: str | None = None) -> DataFrame:
    """Stored statistics, with their ``day`` as text; of one ``day`` (2024-01-31) only its folder is looked at.

    With the ``schema`` of what was written, no file is opened for it, and a day without statistics is empty.
    """
    rows = _batches_and_closed(spark, path, schema, day)
    if rows is None:
        if schema is None:
            raise ValueError(f"no statistics under {path}")
        return spark.createDataFrame([], schema).withColumn("day", F.lit(None).cast("string"))
    return rows.drop("batch")


def compact_stats(spark: SparkSession, path: str, day: str, rows_per_file: int = 1 << 20) -> None:
    """Put the batches of a day into as few files as its rows need, beside the old ones.

    Rows keep the name of the batch they came with, so a reader takes each batch once, and one that comes later is still
    seen. Nothing is replaced or removed: running readers are not disturbed, and storage rules may remove by age the
    batches of compacted days.
    """
    rows = _batches_and_closed(spark, path, None, day)
    if rows is not None:
        stamp = f"{time.time_ns() // 1_000_000:014d}-{uuid4().hex[:12]}"
        placed = _by_size(rows, rows_per_file).withColumn("closed", F.lit(stamp))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "closed").parquet(f"{path}/compacted")


def write_jdbc(df: DataFrame, url: str, table: str, columns: list[str] | None = None, batch_size: int = 5_000, **options) -> None:
    """Append rows to a database table, by column name.

    Databases cannot replace a retried batch by themselves: give the table a key
    that makes repeats harmless.
    """
    rows = df.select(*columns) if columns else df
    rows.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_size, **options).mode("append").save()


def write_stats_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Statistics to a database, all columns."""
    write_jdbc(df, url, table, **options)


def write_jdbc_tuple(df: DataFrame, url: str, table: str, **options) -> None:
    """The key counts of a window, four columns."""
    write_jdbc(df, url, table, ["stt", "edt", "key", "ct"], **options)


def write_console(df: DataFrame, name: str, checkpoint: str | None = None):
    """Print a table or a stream, for looking at it by hand."""
    if not df.isStreaming:
        return df.show(truncate=False)
    writer = df.writeStream.format("console").queryName(name).outputMode("append")
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
