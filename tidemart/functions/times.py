"""Epoch-millisecond times. Text follows the session time zone unless said."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ms) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(_col(ms))


def ymd(ms) -> Column:
    """``yyyy-MM-dd`` of an epoch-millisecond time."""
    return F.date_format(event_time(ms), "yyyy-MM-dd")


def ymd_hms(ms) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an epoch-millisecond time, on a 24-hour clock."""
    return F.date_format(event_time(ms), SECONDS_FORMAT)


def utc_text(ms) -> Column:
    """UTC date and time with a blank between them; no trailing zero fractions."""
    utc = F.to_utc_timestamp(event_time(ms), F.current_timezone())
    return F.regexp_replace(F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSS"), r"\.?0+$", "")


def yyyymmdd(stt) -> Column:
    """Day number of a ``yyyy-MM-dd HH:mm:ss`` text, such as 20240131."""
    return F.date_format(F.to_timestamp(_col(stt), SECONDS_FORMAT), "yyyyMMdd").cast("int")


def now_ms() -> Column:
    """Wall clock in milliseconds, at second precision."""
    return F.unix_timestamp() * 1000


def with_event_time(df: DataFrame, ms="ts", delay: str | None = None, name: str = "rt") -> DataFrame:
    """Add the event-time column, and its watermark when ``delay`` is given."""
    out = df.withColumn(name, event_time(ms))
    return out.withWatermark(name, delay) if delay else out


def bounded_watermark(df: DataFrame, delay: str, name: str = "rt") -> DataFrame:
    """Declare how far out of order rows may come."""
    return df.withWatermark(name, delay)


def window_bounds(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace a window column by its start and end as text, ``stt`` and ``edt``."""
    return df.withColumns(
        {
            "stt": F.date_format(F.col(f"{window}.start"), SECONDS_FORMAT),
            "edt": F.date_format(F.col(f"{window}.end"), SECONDS_FORMAT),
        }
    ).drop(window)
