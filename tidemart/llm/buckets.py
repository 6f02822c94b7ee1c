"""Meeting of items that share a bucket: rows in, bounded tiles of every bucket out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tiles(rows: DataFrame, key: list[str], item: str, most: int, details: DataFrame | None = None) -> DataFrame:
    """Rows of buckets with at least two items, so dealt out that each pair of a bucket meets in one tile.

    A bucket of up to ``most`` items is one tile. A larger one is cut into parts by a hash of the item, and every two
    parts meet in a tile of their own; a tile of two parts (``i < j``) compares across them only, one part alone
    (``i = j``) within itself. Adds ``i``, ``j`` and ``part``, and the columns of ``details``, which has a row per item,
    and shuffles rows to their tiles, sorted by tile.
    """
    sizes = rows.groupBy(*key).agg(F.count("*").alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / F.lit(most // 2)).cast("int")
    rows = rows.join(sizes, key).withColumn("parts", F.when(F.col("size") <= most, F.lit(1)).otherwise(parts))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(1), item), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(*[c for c in rows.columns if c not in ("size", "parts", "other")], F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    if details is not None:
        rows = rows.join(details, item)
    return rows.repartition(*key, "i", "j").sortWithinPartitions(*key, "i", "j")
