"""Streaming forms of the three log operators that remember devices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions.text import is_entry
from tidemart.functions.times import with_event_time, ymd
from tidemart.operators.logs import entry_pages, fix_is_new, unique_visit
from tidemart.streaming.runs import run_batches


def _with_fresh(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` with null keys, then rows of ``keys`` with a null record."""
    record = F.struct(*df.columns)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in keys.schema.fields]
    rows = df.select(record.alias("record"), *nothing)
    return rows.unionByName(keys.select(F.lit(None).cast(df.select(record).schema[0].dataType).alias("record"), "*"))


def _records(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("record").isNotNull()).select("record.*")


def _keys(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("record").isNull()).drop("record")


def _run_settled(stream: DataFrame, settle, write, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """Settle each micro-batch, which reads it more than once, and hand it on."""

    def both(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        write(settle(rows), batch_id)
        rows.unpersist()

    return run_batches(stream, both, checkpoint, trigger)


def fresh_devices(df: DataFrame, salts: int = 8) -> DataFrame:
    """The log, and the devices that claim to be new for the first time.

    The state holds device names only and never expires. A busy device is first
    thinned in ``salts`` groups of its own, so its claims do not meet in one task.
    """
    claims = df.filter(F.col("common.is_new") == "1").select(
        F.col("common.mid").alias("mid"), F.pmod(F.xxhash64("ts"), F.lit(salts)).alias("salt")
    )
    devices = claims.dropDuplicates(["mid", "salt"]).select("mid").dropDuplicates(["mid"])
    return _with_fresh(df, devices)


def fix_is_new_stream(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None, salts: int = 8
) -> StreamingQuery:
    """Leave ``is_new='1'`` on a device's first claim, across batches and without expiry.

    A device keeps it on its earliest claim of the micro-batch in which it first
    claims. Each batch goes to ``write(rows, batch_id)``, which must bear a repeat.
    """
    return _run_settled(
        fresh_devices(df, salts), lambda rows: fix_is_new(_records(rows), _keys(rows)), write, checkpoint, trigger
    )


def fresh_visits(df: DataFrame, salts: int = 8) -> DataFrame:
    """Entry pages, and the (device, day) pairs seen for the first time; state lasts a day."""
    entries = entry_pages(df)
    visits = with_event_time(entries, "ts", "1 day").select(
        F.col("common.mid").alias("mid"), ymd("ts").alias("day"), "rt",
        F.pmod(F.xxhash64("ts"), F.lit(salts)).alias("salt"),
    )
    visits = visits.dropDuplicatesWithinWatermark(["mid", "day", "salt"]).dropDuplicatesWithinWatermark(["mid", "day"])
    return _with_fresh(entries, visits.select("mid", "day"))


def unique_visit_stream(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None, salts: int = 8
) -> StreamingQuery:
    """Each device's first entry page of a day, the earliest of the micro-batch that brings one.

    Each batch goes to ``write(rows, batch_id)``, which must bear a repeat.
    """

    def settle(rows: DataFrame) -> DataFrame:
        keyed = unique_visit(_records(rows)).withColumns({"mid": F.col("common.mid"), "day": ymd("ts")})
        return keyed.join(_keys(rows), ["mid", "day"], "left_semi").drop("mid", "day")

    return _run_settled(fresh_visits(df, salts), settle, write, checkpoint, trigger)


def user_jump_stream(
    df: DataFrame, within_ms: int = 10_000, delay: str = "2 seconds", slot_ms: int | None = None, kind: bool = False
) -> DataFrame:
    """Entry pages that led nowhere (see ``operators.logs.user_jump``).

    Two aggregations follow each other. The first gathers a device's rows over a short step, an even part of
    ``within_ms``, and decides all but the last of them; of the step only its first and last row are kept. The second
    puts a device's steps beside each other in windows that slide by ``slot_ms`` and are ``within_ms`` longer: the last row of a step is
    decided in the window whose first ``slot_ms`` holds it, which sees all that can follow in time. So a group holds the
    rows of one device and step, or a few steps' ends; what was decided inside a step passes the second aggregation as a
    group of its own. The answer comes when the watermark has passed the window, up to ``slot_ms + within_ms`` after the
    row. A short slot, the default, keeps that delay small; it may not be shorter than ``within_ms``.
    """
    step_ms = within_ms // next(n for n in (8, 7, 6, 5, 4, 3, 2, 1) if within_ms % n == 0)
    slot_ms = -(-max(slot_ms or within_ms, within_ms) // step_ms) * step_ms
    rows = with_event_time(df, "ts", delay).select(
        F.col("common.mid").alias("mid"), "ts", "rt", is_entry().alias("entry"),
        F.xxhash64(*df.columns).alias("tie"), F.when(is_entry(), F.struct(*df.columns)).alias("record"),
    )
    gathered = rows.groupBy(F.window("rt", f"{step_ms} milliseconds").alias("step"), "mid").agg(
        F.array_sort(F.collect_list(F.struct("ts", "tie", "entry", "record"))).alias("rows")
    )
    record = rows.schema["record"].dataType
    jump_type = f"struct<record:{record.simpleString()},kind:string>"

    def inside(row, i):
        """Rows of a step lie less than ``within_ms`` apart, so the next row alone decides."""
        after = F.get("rows", i + 1)
        return F.when(row["entry"] & after["entry"], F.struct(row["record"].alias("record"), F.lit("matched").alias("kind")))

    jumps = F.filter(F.transform("rows", inside), lambda j: j.isNotNull())
    first, last = F.get("rows", F.lit(0)), F.element_at("rows", -1)
    ends = F.struct(
        last["ts"].alias("ts"), last["entry"].alias("entry"), last["record"].alias("record"), first["ts"].alias("first_ts"), first["entry"].alias("first_entry")
    )
    start = F.unix_millis(F.col("step.start"))
    parts = gathered.select("mid", F.window_time("step").alias("rt"), start.alias("start"), ends.alias("ends"), jumps.cast(f"array<{jump_type}>").alias("jumps"))
    # a row for the step's ends, and one of another group for its jumps
    parts = parts.withColumn("own", F.explode(F.when(F.size("jumps") > 0, F.array(F.lit(None), "start")).otherwise(F.array(F.lit(None).cast("long")))))
    span = F.window("rt", f"{slot_ms + within_ms} milliseconds", f"{slot_ms} milliseconds")
    met = parts.groupBy(span, "mid", "own").agg(
        F.array_sort(F.collect_list(F.when(F.col("own").isNull(), F.col("ends")))).alias("ends"),
        F.flatten(F.collect_list(F.when(F.col("own").isNotNull(), F.col("jumps")))).alias("jumps"),
    )
    end = F.unix_millis(F.col("window.start")) + slot_ms

    def decided(row, i):
        after = F.get("ends", i + 1)
        in_time = F.coalesce(after["first_ts"] - row["ts"] < within_ms, F.lit(False))
        jump = row["entry"] & (row["ts"] < end) & (~in_time | after["first_entry"])
        return F.when(jump, F.struct(row["record"].alias("record"), F.when(in_time, "matched").otherwise("timeout").alias("kind")))

    last_jumps = F.filter(F.transform("ends", decided), lambda j: j.isNotNull()).cast(f"array<{jump_type}>")
    all_jumps = F.when(F.col("own").isNull(), last_jumps).when(F.col("own") < end, F.col("jumps"))
    out = met.select(F.inline(all_jumps)).select("kind", "record.*")
    return out if kind else out.drop("kind")
