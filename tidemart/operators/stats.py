"""Windowed statistics.

Inputs carry an event-time column ``rt``; on a stream it has a watermark. Sums
are combined before the shuffle, so a hot key costs one row per task. Distinct
orders are counted in two steps, first per order and then per key, which keeps
both steps spread, needs no set in memory and also runs on streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import schemas as S
from tidemart.functions.tokens import Prefixes, candidate_words, in_dictionary
from tidemart.functions.times import window_bounds

WIDTH = "10 seconds"


def _window(width: str):
    return F.window("rt", width).alias("window")


def visitor_stats(facts: DataFrame, width: str = WIDTH) -> DataFrame:
    """Visitor measures per area, channel, newness and version in each window."""
    sums = [F.sum(m).alias(m) for m in S.VISITOR_MEASURES]
    stats = facts.groupBy(_window(width), *S.VISITOR_KEYS).agg(*sums, F.min("ts").alias("ts"))
    return window_bounds(stats).select([f.name for f in S.VISITOR_STATS.fields])


def product_stats(facts: DataFrame, width: str = WIDTH) -> DataFrame:
    """Product measures and order counts per product in each window."""
    sums = [F.sum(m).alias(m) for m in S.PRODUCT_COUNTS + S.PRODUCT_AMOUNTS]
    per_order = facts.groupBy(_window(width), "sku_id", "order_kind", "order_id").agg(*sums, F.min("ts").alias("ts"))

    def orders(kind: str):
        counted = (F.col("order_kind") == kind) & F.col("order_id").isNotNull()
        return F.sum(F.when(counted, 1).otherwise(0))

    stats = per_order.groupBy("window", "sku_id").agg(
        *[F.sum(m).alias(m) for m in S.PRODUCT_COUNTS],
        *[F.sum(m).cast("decimal(18,2)").alias(m) for m in S.PRODUCT_AMOUNTS],
        orders("order").alias("order_ct"), orders("paid").alias("paid_order_ct"),
        orders("refund").alias("refund_order_ct"), F.min("ts").alias("ts"),
    )
    return window_bounds(stats)


def province_stats(order_wide: DataFrame, width: str = WIDTH) -> DataFrame:
    """Amount and number of distinct orders per province in each window."""
    per_order = order_wide.groupBy(_window(width), "province_id", "order_id").agg(
        F.sum("split_total_amount").alias("amount"), F.min("create_time").alias("ts")
    )
    stats = per_order.groupBy("window", "province_id").agg(
        F.sum("amount").cast("decimal(18,2)").alias("order_amount"),
        F.count("order_id").alias("order_count"),
        F.min("ts").alias("ts"),
    )
    return window_bounds(stats)


def province_stats_rows(order_wide: DataFrame, width: str = WIDTH) -> DataFrame:
    """Amount and number of order lines per province in each window."""
    stats = order_wide.groupBy(_window(width), "province_id").agg(
        F.sum("split_total_amount").cast("decimal(18,2)").alias("order_amount"),
        F.count(F.lit(1)).alias("order_count"),
        F.min("create_time").alias("ts"),
    )
    return window_bounds(stats)


def window_stats_join(order_wide: DataFrame, width: str = WIDTH) -> DataFrame:
    """Distinct orders next to order lines per province and window.

    Joining the two statistics on province and window is the same as summing
    both from the per-order step, without reading the lines twice.
    """
    per_order = order_wide.groupBy(_window(width), "province_id", "order_id").agg(
        F.sum("split_total_amount").alias("amount"), F.count(F.lit(1)).alias("lines")
    )
    stats = per_order.filter(F.col("province_id").isNotNull()).groupBy("window", "province_id").agg(
        F.sum("amount").cast("decimal(18,2)").alias("order_amount"),
        F.count("order_id").alias("order_count"),
        F.sum("lines").alias("row_count"),
    )
    return window_bounds(stats)


#: Bytes of text whose words make about a million rows, and how many times that one window may hold in a task of its own.
TASK_BYTES, HOT_WINDOW = 8 << 20, 8


def windows_together(
    searches: DataFrame, width: str = WIDTH, task_bytes: int = TASK_BYTES, text: str = "full_word"
) -> tuple[DataFrame, str | None]:
    """Searches dealt out by day, those of a large day by window over as many tasks as it has ``task_bytes`` of text.

    Every window lies whole in one task, whose number is in the column that is named second: its words need no shuffle,
    and the rows of a day lie where their files are written. Where a window has too much text for that, the searches
    come back as they are, without a column. For tables only.
    """
    start = searches.withColumn("_start", _window(width)).withColumn("_start", F.col("_start.start"))
    placed = start.withColumn("_day", F.to_date("_start"))
    per_window = placed.groupBy("_day", "_start").agg(F.sum(F.octet_length(text)).alias("_bytes"))
    per_day = per_window.groupBy("_day").agg(F.sum("_bytes").alias("_bytes"), F.max("_bytes").alias("_most"))
    # no more than one row for each task's worth of text
    large = per_day.filter(F.col("_bytes") > task_bytes).collect()
    if any(r["_most"] > HOT_WINDOW * task_bytes for r in large):
        return searches, None
    parts = [(r["_day"], -(-r["_bytes"] // task_bytes)) for r in large]
    tasks = max(sum(n for _, n in parts), searches.sparkSession.sparkContext.defaultParallelism)
    known = F.broadcast(searches.sparkSession.createDataFrame(parts, "_day date, _parts bigint"))
    part = F.pmod(F.xxhash64("_start"), F.coalesce("_parts", F.lit(1)))
    placed = placed.join(known, "_day", "left").withColumn("_place", F.xxhash64("_day", part))
    return placed.select(*searches.columns, "_place").repartition(tasks, "_place"), "_place"


def keyword_stats(
    searches: DataFrame, width: str = WIDTH, dictionary: DataFrame | None = None, singles: bool = True,
    place: str | None = None,
) -> DataFrame:
    """Searches per word in each window.

    With a dictionary the Han candidates are counted first and checked after, so the check sees one row per word and
    window; without one a Han run counts as one word. ``place`` is the column that ``windows_together`` names.
    """
    words = candidate_words(searches, "full_word", Prefixes(dictionary) if dictionary is not None else None, counts="_n")
    flag = ["_han"] if dictionary is not None else []
    placed = [place] if place else []  # a window has one place, so the groups are the same
    stats = words.groupBy(*placed, _window(width), "word", *flag).agg(
        F.sum("_n").alias("ct"), F.min("ts").alias("ts")
    )
    if dictionary is not None:
        stats = in_dictionary(stats, dictionary, singles=singles)
    stats = window_bounds(stats.withColumnRenamed("word", "keyword"))
    return stats.withColumn("source", F.lit(S.KEYWORD_SOURCE)).select([f.name for f in S.KEYWORD_STATS.fields])


def page_area_counts(pages: DataFrame, width: str = WIDTH) -> DataFrame:
    """Pages per area code in each window."""
    stats = pages.groupBy(_window(width), F.col("common.area_code").alias("province_id")).agg(
        F.count(F.lit(1)).alias("order_count")
    )
    return window_bounds(stats)


def key_count(events: DataFrame, width: str = "2 seconds") -> DataFrame:
    """Sum of ``n`` per key in each window."""
    return window_bounds(events.groupBy(_window(width), "key").agg(F.sum("n").alias("ct")))
