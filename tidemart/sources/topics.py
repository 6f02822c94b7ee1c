"""Topics of JSON text.

A topic lives on a broker (``kafka://host:port``) or, under any other address,
in a folder ``<root>/topic=<name>`` that Spark lists like a queue of files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.text import parse_json
from tidemart.functions.times import with_event_time

BROKER = "kafka://"


def topic_path(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/topic={topic}"


def read_topic(
    spark: SparkSession, uri: str, topic: str, stream: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """The text records of a topic in a ``value`` column.

    On a broker a first start reads from the latest offset; later starts resume
    from the query's checkpoint.
    """
    reader = spark.readStream if stream else spark.read
    if uri.startswith(BROKER):
        options = {"kafka.bootstrap.servers": uri[len(BROKER):], "subscribe": topic}
        if stream:
            options["startingOffsets"] = "latest"
        return reader.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("value"))
    path = topic_path(uri, topic)
    reader = reader.option("recursiveFileLookup", "true")
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    try:
        return reader.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    # nothing was written yet: make the topic, so that a reader may start before its writer
    spark.createDataFrame([], "value STRING").write.mode("append").text(path)
    return reader.text(path)


def topic_table(
    records: DataFrame, name: str, schema: T.StructType, ms: str = "ts", delay: str = "2 seconds"
) -> DataFrame:
    """Register a topic as a SQL view with its event time ``rt`` and watermark."""
    table = with_event_time(parse_json(records, schema), ms, delay if records.isStreaming else None)
    table.createOrReplaceTempView(name)
    return table
