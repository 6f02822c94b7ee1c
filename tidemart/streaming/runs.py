"""Starting, checkpointing and finishing streaming queries."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

NOW = {"availableNow": True}


def checkpointed_run(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to files, each row once, resuming from ``checkpoint``."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def run_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand each micro-batch to ``write(rows, batch_id)``; ``write`` must bear a repeat."""
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def writer_of(rows: DataFrame, name: str) -> str:
    """Who writes a micro-batch: the job's name and its query's id, which is kept in the checkpoint.

    A restart from the same checkpoint is the same writer and may repeat its last batch; one with a new checkpoint,
    which counts batches from zero again, is another.
    """
    query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise ValueError("not inside a micro-batch")
    return f"{name}-{query}"


def passthrough(spark: SparkSession, uri: str, source: str, target: str, checkpoint: str, trigger: dict | None = None):
    """Copy a topic to another, unchanged."""
    from tidemart.sinks.topics import write_topic
    from tidemart.sources.topics import read_topic

    return write_topic(read_topic(spark, uri, source), uri, target, checkpoint, trigger)


class LateRows(StreamingQueryListener):
    """Counts the rows that queries lose because they come behind the watermark: every batch, of every query of a session.

    Add it before the queries start (``watch_late``). Counts are kept by the query's id, so restarts from a checkpoint add up.
    """

    def __init__(self):
        self.lost: Counter[str] = Counter()
        self.batches: Counter[str] = Counter()
        self._ended = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._news:
            self.lost[str(progress.id)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            self.batches[str(progress.id)] += 1

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def of(self, query: StreamingQuery, wait: float = 60) -> int:
        """Rows a query has lost so far; of one that has ended, once its last batch has been reported."""
        with self._news:
            if not query.isActive and not self._news.wait_for(lambda: str(query.runId) in self._ended, wait):
                raise TimeoutError("the query's end has not been reported")
            return self.lost[str(query.id)]


def watch_late(spark: SparkSession) -> LateRows:
    """Count late rows of all queries started from now on; ``spark.streams.removeListener`` ends it."""
    listener = LateRows()
    spark.streams.addListener(listener)
    return listener
