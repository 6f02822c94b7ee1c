"""Connected components of a graph of any size, by rounds of joins on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.store import written


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang every node's larger (or smaller) neighbours on the smallest one it knows."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    sees = both if large else both.filter("v < u")
    least = sees.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    seen = sees.join(least, "u")
    if large:
        out = seen.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = seen.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that it reaches, for every node that has an edge to another.

    ``edges`` has two long columns ``u`` and ``v`` without nulls, in any direction, repeated or not. Large and small
    stars follow each other until nothing changes; the number of rounds grows with the logarithm of the longest path.
    Each round is one aggregate and one join on a node, written to the shared folder; the driver sees a count and a
    checksum. A node with very many neighbours is an aggregate and a skewed join, never a group in one task.
    """
    now = written(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = state
        now = written(star(star(now, True), False), "edges")
