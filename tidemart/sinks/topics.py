"""Writing JSON text to topics (see ``sources.topics`` for where they live)."""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.topics import BROKER, topic_path


def write_topic(df: DataFrame, uri: str, topic: str, checkpoint: str | None = None, trigger: dict | None = None):
    """Append a ``value`` column to one topic.

    A stream returns its started query; its file sink writes each record once.
    """
    rows = df.select("value")
    if uri.startswith(BROKER):
        options = {"kafka.bootstrap.servers": uri[len(BROKER):], "topic": topic}
        fmt = "kafka"
    else:
        options, fmt = {"path": topic_path(uri, topic)}, "text"
    if not df.isStreaming:
        return rows.write.format(fmt).options(**options).mode("append").save()
    writer = rows.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def topic_rows(routed: DataFrame) -> DataFrame:
    """Routed change records as topic name and payload."""
    return routed.select(F.col("sink_table").alias("topic"), F.to_json("after").alias("value"))


def published(spark: SparkSession, uri: str, writer: str, batch_id: int) -> DataFrame | None:
    """The topics that hold a batch of a writer already: at most one row per topic."""
    batch = f"{uri.rstrip('/')}/topic=*/writer={writer}/batch_id={batch_id}"
    # the stated type keeps names such as 007; no text is read
    files = spark.read.schema("value STRING, topic STRING, writer STRING, batch_id BIGINT").option("basePath", uri.rstrip("/"))
    try:
        return files.text(batch).select(F.col("topic").alias("_done")).distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_topic_dynamic(rows: DataFrame, uri: str, batch_id: int | None = None, writer: str | None = None, files: int = 8) -> None:
    """Write ``(topic, value)`` rows to the topic each row names.

    In folders a batch owns ``topic=…/writer=…/batch_id=…``. What was published is never touched again: a reader may
    have taken its files, and would take new ones for new records. So a writer's retried batch, which has the same rows,
    only writes the topics that its first attempt did not get to; a topic's folder appears at once, with all its files.
    The writer of a stream holds the query's id (see ``streaming.runs.writer_of``), which its checkpoint keeps: numbers
    that start again with a new checkpoint are another writer's. A call without writer and number is a batch of its own.
    A topic gets at most ``files`` files per batch, dealt out by a hash of the record, with or without adaptive
    execution (stateful streams run without).
    """
    if (batch_id is None) != (writer is None):
        raise ValueError("a batch number and its writer go together")
    if uri.startswith(BROKER):
        rows.write.format("kafka").option("kafka.bootstrap.servers", uri[len(BROKER):]).save()
        return
    done = published(rows.sparkSession, uri, writer, batch_id) if writer else None
    # folders keep a null name and an empty one as the same
    new = rows if done is None else rows.join(done, F.nullif("topic", F.lit("")).eqNullSafe(F.col("_done")), "left_anti")
    placed = new.select("topic", F.lit(writer or f"batch-{uuid4().hex}").alias("writer"), F.lit(batch_id or 0).alias("batch_id"), "value")
    (
        placed.repartition("topic", F.pmod(F.xxhash64("value"), F.lit(files))).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "writer", "batch_id").text(uri.rstrip("/"))
    )
