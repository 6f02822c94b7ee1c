"""Daily report numbers over the stored statistics. ``day`` is such as 20240131."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_text(day: int) -> str:
    """20240131 as 2024-01-31."""
    text = str(day)
    return f"{text[:4]}-{text[4:6]}-{text[6:]}"


def on_day(stats: DataFrame, day: int) -> DataFrame:
    """Rows whose window starts on ``day``: a range on ``stt``, which reaches the scan.

    Stored statistics are partitioned by ``day``; there only that partition is read.
    """
    date = day_text(day)
    if "day" in stats.columns:
        stats = stats.filter(F.col("day") == date)
    return stats.filter(F.col("stt").between(f"{date} 00:00:00", f"{date} 23:59:59"))


def daily_gmv(product_stats: DataFrame, day: int) -> DataFrame:
    """Amount ordered on a day; null when nothing was."""
    return on_day(product_stats, day).agg(F.sum("order_amount").cast("decimal(18,2)").alias("order_amount"))


def keyword_topn(keyword_stats: DataFrame, day: int, n: int = 5) -> DataFrame:
    """The ``n`` words searched most on a day; ties by word."""
    totals = on_day(keyword_stats, day).groupBy("keyword").agg(F.sum("ct").alias("ct"))
    return totals.orderBy(F.desc("ct"), "keyword").limit(n)


def channel_topn(visitor_stats: DataFrame, day: int, n: int = 5) -> DataFrame:
    """The ``n`` channels with most page views on a day; ties by channel."""
    totals = on_day(visitor_stats, day).groupBy("ch").agg(F.sum("pv_ct").alias("pv_ct"))
    return totals.orderBy(F.desc("pv_ct"), "ch").limit(n)
