"""Database change records (JSON with source, before, after, op, ts_ms)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import schemas as S
from tidemart.functions.text import checked_json, readable_rows
from tidemart.operators.routing import drop_deletes


def cdc_normalize(records: DataFrame) -> DataFrame:
    """Change JSON in ``value`` to the shape ``schemas.CHANGE``; unknown operations stay, unreadable lines go.

    ``checked_json(records, S.CHANGE_IN)`` tells which lines these are.
    """
    parsed = readable_rows(checked_json(records, S.CHANGE_IN))
    kind = F.col("op")
    for op, name in S.CHANGE_TYPES.items():
        kind = F.when(F.col("op") == op, name).otherwise(kind)
    return parsed.select(
        F.col("source.db").alias("database"), F.col("source.table").alias("table"),
        "before", "after", kind.alias("type"), "ts_ms",
    )


def cdc_snapshot_rules(records: DataFrame) -> DataFrame:
    """Routing rules from the change records of the rules table, with their arrival time."""
    live = drop_deletes(cdc_normalize(records))
    fields = [F.col("after")[f.name].alias(f.name) for f in S.RULE.fields]
    return live.select(*fields, F.col("ts_ms").try_cast("bigint").alias("arrival"))
