"""Dimension tables: text columns, one row per primary key, upserted per batch.

A table is a Parquet folder that only grows. ``change_kind=changes/change_part=<stamp>`` holds what one batch changed: null
in the columns that a change does not name, empty text in those it empties. Reading merges: each column takes its last
value by time (``ts_ms``, then type, then arrival). That is the same however often and in whatever order batches are
written, so a repeated batch, a second writer or a job with a new checkpoint neither loses nor doubles anything.
``compact`` writes the same changes less what others have overtaken as ``change_kind=merged``; a reader takes the newest of
these and the changes since. No file is ever replaced, so a running reader is not disturbed.
"""

from __future__ import annotations

import re
import time
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = ["change_ms", "change_type", "change_made", "change_tie"]
CHANGE = "change_key STRING, change_ms BIGINT, change_type STRING, change_made STRING, change_tie BIGINT"
PLACE = "change_kind STRING, change_part STRING"
MERGED = re.compile(r"/change_kind=merged/change_part=([^/]+)/")


def dim_columns(sink_columns: str) -> list[str]:
    return sink_columns.split(",")


def primary_key(sink_pk: str | None) -> str:
    return sink_pk or "id"


def named_columns(sink_columns: str, sink_pk: str | None) -> list[str]:
    """The columns of a table, its key among them."""
    columns, pk = dim_columns(sink_columns), primary_key(sink_pk)
    return columns if pk in columns else [pk, *columns]


def declared_columns(rules: DataFrame) -> DataFrame:
    """The columns each rule's table is made with, all text, and which is the key."""
    pk = F.when(F.coalesce("sink_pk", F.lit("")) == "", "id").otherwise(F.col("sink_pk"))
    columns = F.posexplode(F.split("sink_columns", ",", -1)).alias("position", "column")
    rows = rules.select("sink_table", pk.alias("pk"), columns)
    return rows.select("sink_table", "position", "column", (F.col("column") == F.col("pk")).alias("is_key"))


def _stamp() -> str:
    """A name for a batch of changes that sorts by the time it was made."""
    return f"{time.time_ns() // 1_000_000:014d}-{uuid4().hex[:12]}"


def change_rows(changes: DataFrame, columns: list[str], pk: str, made: str) -> DataFrame:
    """Change records as rows of the table's folder; records without a key are dropped."""
    after = F.col("after")
    values = [F.when(F.map_contains_key("after", c), F.coalesce(after[c], F.lit(""))).alias(c) for c in columns]
    return changes.filter(after[pk].isNotNull()).select(
        after[pk].alias("change_key"), F.col("ts_ms").try_cast("bigint").alias("change_ms"), F.col("type").alias("change_type"),
        F.lit(made).alias("change_made"), F.xxhash64(*[after[c] for c in columns]).alias("change_tie"), *values,
    )


def _last(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per key, the last value of each column with its place in time: hash aggregates, combined before the shuffle."""
    order = F.struct(*ORDER)
    last = [F.max(F.when(F.col(f"`{c}`").isNotNull(), F.struct(order.alias("at"), F.col(f"`{c}`").alias("value")))).alias(c) for c in columns]
    return rows.groupBy("change_key").agg(*last, F.max(order).alias("change_last"))


def merged(rows: DataFrame, columns: list[str], pk: str | None = None) -> DataFrame:
    """One row per key: every column's last value, null where it was emptied or never named.

    With ``pk`` this column is taken from the key, so that a condition on it reaches the scan.
    """
    values = [F.col("change_key").alias(c) if c == pk else F.nullif(F.col(f"`{c}`")["value"], F.lit("")).alias(c) for c in columns]
    return _last(rows.filter("change_key IS NOT NULL"), columns).select(*values)


def reduced(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The same changes less what later ones have overtaken: per key at most a row for each column and one for its last change."""
    last = _last(rows, columns)
    times = F.array(*[F.col(f"`{c}`")["at"] for c in columns], F.col("change_last"))
    at = F.explode(F.array_distinct(F.filter(times, lambda t: t.isNotNull()))).alias("change_at")

    def value(c: str) -> Column:
        return F.when(F.col(f"`{c}`")["at"].eqNullSafe(F.col("change_at")), F.col(f"`{c}`")["value"]).alias(c)

    return last.select("*", at).select("change_key", "change_at.*", *[value(c) for c in columns])


def _append(rows: DataFrame, path: str, kind: str, part: str) -> None:
    """Add a part to a table; its folder appears at once, with all its files."""
    placed = rows.withColumns({"change_kind": F.lit(kind), "change_part": F.lit(part)})
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("change_kind", "change_part").parquet(path)


def _folder(spark: SparkSession, path: str, columns: list[str] | None) -> DataFrame | None:
    """All rows of a table's folder, with these columns or all it has; None if nobody has made it."""
    text = "".join(f", `{c}` STRING" for c in columns or [])
    reader = spark.read.option("mergeSchema", "true") if columns is None else spark.read.schema(f"{CHANGE}{text}, {PLACE}")
    try:
        rows = reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows


def _current(rows: DataFrame) -> DataFrame:
    """The newest compacted changes and those made since: whole folders are left out when the scan is planned."""
    parts = sorted({m.group(1) for f in rows.inputFiles() if (m := MERGED.search(f))})
    if not parts:
        return rows.filter("change_kind = 'changes'")
    newest = F.lit(parts[-1])
    kind, part = F.col("change_kind"), F.col("change_part")
    return rows.filter(((kind == "merged") & (part == newest)) | ((kind == "changes") & (part >= newest)))


def _own_columns(rows: DataFrame) -> list[str]:
    """A table's columns in the order they were first declared or named."""
    meta = {f.name for f in T.StructType.fromDDL(f"{CHANGE}, {PLACE}").fields}
    return [c for c in rows.columns if c not in meta]


def read_dim(spark: SparkSession, root: str, table: str, columns: list[str] | None = None, pk: str | None = None) -> DataFrame:
    """A dimension table as it is now.

    With ``columns`` the result has just these: one that the table lacks is null, and a table that nobody has made yet
    is empty, so that a lookup finds nothing and goes on. Without, a missing table is an error, and the columns are found
    in the files. Name the key as ``pk`` to have conditions on it reach the files.
    """
    rows = _folder(spark, f"{root}/{table}", columns)
    if rows is None:
        if columns is None:
            raise ValueError(f"no dimension table {table} under {root}")
        return spark.createDataFrame([], ", ".join(f"`{c}` STRING" for c in columns))
    return merged(_current(rows), columns or _own_columns(rows), pk)


def ensure_dim_table(spark: SparkSession, root: str, table: str, sink_columns: str, sink_pk: str | None = None) -> None:
    """Make an empty table unless there is one, and add the columns that it lacks: a row without a key declares them."""
    columns = named_columns(sink_columns, sink_pk)
    rows = _folder(spark, f"{root}/{table}", None)
    if rows is None or not set(columns) <= set(_own_columns(rows)):
        text = "".join(f", `{c}` STRING" for c in columns)
        _append(spark.createDataFrame([[None] * (5 + len(columns))], CHANGE + text), f"{root}/{table}", "changes", _stamp())


def upsert_dim(changes: DataFrame, root: str, table: str, sink_columns: str, sink_pk: str | None = None) -> None:
    """Apply the change records of one table: only they are written, nothing is read.

    Columns that the table lacks are added to it. A change counts by its time, so applying it again changes nothing.
    """
    columns, made = named_columns(sink_columns, sink_pk), _stamp()
    if clash := {c for c in columns if c in T.StructType.fromDDL(f"{CHANGE}, {PLACE}").names}:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    rows = change_rows(changes, columns, primary_key(sink_pk), made)
    _append(reduced(rows, columns), f"{root}/{table}", "changes", made)


def compact_dim(spark: SparkSession, root: str, table: str, settle_ms: int = 0) -> None:
    """Write what a table's changes up to now amount to, as the start for later readers.

    A plain Spark job, beside readers and writers; ``settle_ms`` is the longest that a writer other than the caller may
    take for a batch, whose changes are left to the next time. Folders older than the newest compaction are read by
    nobody who starts now; storage rules may remove them by age.
    """
    upto = f"{time.time_ns() // 1_000_000 - settle_ms:014d}-"
    rows = _folder(spark, f"{root}/{table}", None)
    if rows is not None:
        old = _current(rows).filter((F.col("change_kind") == "merged") | (F.col("change_part") < upto))
        _append(reduced(old, _own_columns(rows)), f"{root}/{table}", "merged", upto)
