"""Change records and the table-driven rules that route them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import schemas as S
from tidemart.functions.text import comma_list, keep_keys


def drop_deletes(df: DataFrame) -> DataFrame:
    """All but deletes; a record without a type passes."""
    return df.filter(~F.col("type").eqNullSafe("delete"))


def rules_first_wins(rules: DataFrame, order: str = "arrival", latest: bool = False) -> DataFrame:
    """One rule per (source table, operation): the first to arrive, or the last."""
    keys = ["source_table", "operate_type"]
    rest = [c for c in rules.columns if c not in (*keys, order)]
    row = F.struct(order, *rest)
    picked = rules.groupBy(*keys).agg((F.max(row) if latest else F.min(row)).alias("_row"))
    return picked.select(*keys, "_row.*").select(rules.columns)


def rules_broadcast_join(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Change records with the rule of their table and type; no rule, no row.

    Rules are one row per table and operation. No hint is given: the planner
    sends them to every task while they are under the broadcast threshold.
    ``listed`` is the rule's column list, split once per rule.
    """
    on = (F.col("c.table") == F.col("r.source_table")) & (F.col("c.type") == F.col("r.operate_type"))
    side = rules.select(
        "source_table", "operate_type", "sink_type", "sink_table", "sink_pk", comma_list("sink_columns").alias("listed")
    )
    joined = changes.alias("c").join(side.alias("r"), on)
    return joined.select("c.*", "r.sink_type", "r.sink_table", "r.sink_pk", "r.listed")


def prune_columns(df: DataFrame, listed, entries: str = "after") -> DataFrame:
    """Keep only the map entries named in the array ``listed``; names are not trimmed."""
    return df.withColumn(entries, keep_keys(entries, F.col(listed) if isinstance(listed, str) else listed))


def route_by_rules(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Pruned change records with ``sink_table`` and ``sink_type``.

    Rules of any other sink type than the two known drop their records.
    """
    known = rules.filter(F.col("sink_type").isin(S.SINK_DIMENSION, S.SINK_TOPIC))
    return prune_columns(rules_broadcast_join(drop_deletes(changes), known), "listed").drop("listed")


def to_topics(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sink_type") == S.SINK_TOPIC)


def to_dimensions(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sink_type") == S.SINK_DIMENSION)
