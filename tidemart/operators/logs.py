"""App-log operators: new devices, log split, unique visits, bounced visits.

Log rows have the shape of ``schemas.LOG``. None of these sends all rows of one
device to one task: a device may hold a large share of the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart import schemas as S
from tidemart.functions.text import is_entry
from tidemart.functions.times import event_time, ymd


def fix_is_new(df: DataFrame, devices: DataFrame | None = None) -> DataFrame:
    """Leave ``is_new='1'`` only on each device's first record that claims it.

    With ``devices(mid)`` only those devices may keep a claim, the others are
    known from before.
    Records with any other value pass through unshuffled. The claiming ones are
    joined to the first claim on (device, time), so the rows of one device
    spread over its times.
    """
    claims = df.filter(F.col("common.is_new") == "1")
    others = df.filter(~F.col("common.is_new").eqNullSafe("1"))
    first = claims.groupBy(F.col("common.mid").alias("_mid")).agg(F.min("ts").alias("_ts"))
    if devices is not None:
        first = first.join(devices.select(F.col("mid").alias("_mid")), "_mid", "left_semi")
    keyed = claims.withColumn("_key", F.col("common.mid")).withColumn("_tie", F.xxhash64(*df.columns))
    joined = keyed.join(first, (keyed["_key"] == first["_mid"]) & (keyed["ts"] == first["_ts"]), "left")
    same_time = Window.partitionBy("_key", "ts").orderBy("_tie")
    earliest = F.col("_mid").isNotNull() & (F.row_number().over(same_time) == 1)
    ranked = joined.withColumn("_earliest", earliest)
    fixed = ranked.withColumn(
        "common", F.col("common").withField("is_new", F.when(F.col("_earliest"), "1").otherwise("0"))
    )
    return fixed.select(df.columns).unionByName(others)


def start_records(df: DataFrame) -> DataFrame:
    return df.filter(F.col("start").isNotNull()).drop("page", "displays")


def page_records(df: DataFrame) -> DataFrame:
    return df.filter(F.col("start").isNull()).drop("start")


def display_records(df: DataFrame, whole_record: bool = False) -> DataFrame:
    """One row per display of a page, with the page's ``mid`` and ``page_id``.

    ``whole_record`` gives the page record once per display instead.
    """
    pages = page_records(df)
    if whole_record:
        return pages.withColumn("_d", F.explode("displays")).drop("_d")
    rows = pages.select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts",
        F.explode("displays").alias("_d"),
    )
    return rows.select("_d.*", "mid", "page_id", "ts")


def split_log(df: DataFrame, whole_record: bool = False) -> dict[str, DataFrame]:
    """The start, page and display topics of one parsed log."""
    return {
        S.TOPIC_START: start_records(df),
        S.TOPIC_PAGE: page_records(df),
        S.TOPIC_DISPLAY: display_records(df, whole_record),
    }


def parse_log(df: DataFrame, value: str = "value") -> DataFrame:
    """Log lines as columns of ``schemas.LOG`` plus ``raw``, the line itself, and ``readable``: it is a JSON object."""
    readable = F.coalesce(F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT"), F.lit(False))
    parts = [F.col("_log")[f].alias(f) for f in S.LOG.fieldNames()]
    # inline makes the parse a step of its own (see functions.text.parse_json)
    both = F.struct(F.from_json(value, S.LOG).alias("_log"), F.col(value).alias("raw"), readable.alias("readable"))
    return df.select(F.inline(F.array(both))).select(*parts, "raw", "readable")


def _entries(variant) -> Column:
    """The fields of a JSON object; null for any other value."""
    return F.try_variant_get(variant, "$", "map<string,variant>")


def record_text() -> Column:
    """The line of a parsed log record, with ``common.is_new`` as the column has it and all else as it came."""
    record = _entries(F.try_parse_json("raw"))
    fixed = F.transform_values(
        _entries(record["common"]), lambda k, v: F.when(k == "is_new", _text_variant(F.col("common.is_new"))).otherwise(v)
    )
    changed = F.transform_values(record, lambda k, v: F.when(k == "common", F.to_variant_object(fixed)).otherwise(v))
    same = F.get_json_object("raw", "$.common.is_new").eqNullSafe(F.col("common.is_new"))
    return F.when(same, F.col("raw")).otherwise(F.to_json(changed))


def _text_variant(text: Column) -> Column:
    return F.parse_json(F.to_json(F.array(text))).cast("array<variant>")[0]


def display_texts() -> Column:
    """Each display of a line as ``(readable, value)``: JSON of its own, everything it came with, plus the page's ``mid``,
    ``page_id`` and ``ts``. A display that is no JSON object is not readable and stays as it came.
    """
    origin = F.create_map(
        F.lit("mid"), _text_variant(F.col("common.mid")), F.lit("page_id"), _text_variant(F.col("page.page_id")),
        F.lit("ts"), F.parse_json(F.col("ts").cast("string")),
    )
    own = lambda d: F.map_filter(_entries(d), lambda k, _: ~k.isin("mid", "page_id", "ts"))
    shown = F.try_variant_get(F.try_parse_json("raw"), "$.displays", "array<variant>")

    def one(d: Column) -> Column:
        whole = F.coalesce(F.schema_of_variant(d).startswith("OBJECT"), F.lit(False))
        text = F.when(whole, F.to_json(F.map_concat(own(d), origin))).otherwise(F.coalesce(F.to_json(d), F.lit("null")))
        return F.struct(whole.alias("readable"), text.alias("value"))

    return F.transform(F.coalesce(shown, F.array().cast("array<variant>")), one)


def log_topics(df: DataFrame, whole_record: bool = False) -> DataFrame:
    """The topics of a log as ``(topic, value)`` JSON rows, from one pass over it.

    Of a log from ``parse_log`` records go on whole, and lines and displays that are no JSON objects to a topic of their
    own, where they can be counted. A log with the columns of ``schemas.LOG`` alone gives just these.
    """

    def row(topic, value):
        return F.struct(F.lit(topic).alias("topic"), value.alias("value"))

    def fields(*columns):
        return F.to_json(F.struct(*columns))

    if "raw" in df.columns:
        start = page = record_text()

        def display(d: Column) -> Column:
            good = row(S.TOPIC_DISPLAY, page if whole_record else d["value"])
            return F.when(d["readable"], good).otherwise(row(S.TOPIC_UNREADABLE, d["value"]))

        displays = F.transform(display_texts(), display)
    else:
        columns = [c for c in df.columns if c != "start"]
        names = df.schema["displays"].dataType.elementType.names
        origin = [F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), F.col("ts")]
        start, page = fields(*[c for c in df.columns if c not in ("page", "displays")]), fields(*columns)
        shown = F.coalesce("displays", F.array().cast(df.schema["displays"].dataType))
        displays = F.transform(shown, lambda d: row(S.TOPIC_DISPLAY, page if whole_record else fields(*[d[n].alias(n) for n in names], *origin)))
    rows = F.when(F.col("start").isNotNull(), F.array(row(S.TOPIC_START, start))).otherwise(F.concat(F.array(row(S.TOPIC_PAGE, page)), displays))
    if "readable" in df.columns:
        rows = F.when(F.col("readable"), rows).otherwise(F.array(row(S.TOPIC_UNREADABLE, F.coalesce("raw", F.lit("")))))
    return df.select(F.inline(rows))


def entry_pages(df: DataFrame) -> DataFrame:
    return df.filter(is_entry())


def search_rows(df: DataFrame) -> DataFrame:
    """The search text of result pages, with its event time."""
    hits = df.filter((F.col("page.last_page_id") == S.SEARCH_PAGE) & F.col("page.item").isNotNull())
    return hits.select(F.col("page.item").alias("full_word"), "ts", event_time("ts").alias("rt"))


def unique_visit(df: DataFrame) -> DataFrame:
    """Each device's first entry page of each calendar day.

    The first time per device and day is a hash aggregate of two small columns; the records only meet it in a join on
    (device, day, time), which spreads a busy device. Records of the same time are told apart by a hash of the row.
    """
    keyed = entry_pages(df).withColumns({"_mid": F.col("common.mid"), "_day": ymd("ts"), "_tie": F.xxhash64(*df.columns)})
    first = keyed.groupBy(F.col("_mid").alias("_m"), F.col("_day").alias("_d")).agg(F.min("ts").alias("_first"))
    same = keyed["_mid"].eqNullSafe(first["_m"]) & keyed["_day"].eqNullSafe(first["_d"]) & keyed["ts"].eqNullSafe(first["_first"])
    same_time = Window.partitionBy("_mid", "_day", "ts").orderBy("_tie")
    earliest = keyed.join(first, same, "left_semi").withColumn("_n", F.row_number().over(same_time))
    return earliest.filter("_n = 1").select(df.columns)


def time_slots(df: DataFrame, within_ms: int, slot_ms: int) -> DataFrame:
    """Rows of ``(mid, ts, entry, tie, record)`` spread over time slots per device.

    A row lies in its own slot; one near a slot's start is also copied, without
    its record, to the slot before. Every slot then sees what follows each of
    its rows by less than ``within_ms``, provided ``slot_ms >= within_ms``.
    """
    into = F.pmod(F.col("ts"), F.lit(slot_ms))
    slot = F.col("ts") - into
    slots = F.when(into < within_ms, F.array(slot, slot - slot_ms)).otherwise(F.array(slot))
    spread = df.select("*", F.explode(slots).alias("slot"))
    own = F.col("slot") == slot
    return spread.withColumn("own", own).withColumn("record", F.when(own & F.col("entry"), F.col("record")))


def user_jump(
    df: DataFrame, within_ms: int = 10_000, slot_ms: int | None = None, kind: bool = False
) -> DataFrame:
    """Entry pages that led nowhere.

    An entry page is kept unless the device's next record is a non-entry page
    less than ``within_ms`` later. ``kind=True`` adds whether another entry page
    came in time (``matched``) or nothing did (``timeout``).
    """
    slot_ms = max(slot_ms or 8 * within_ms, within_ms)
    rows = df.select(
        F.col("common.mid").alias("mid"), "ts", is_entry().alias("entry"),
        F.xxhash64(*df.columns).alias("tie"), F.struct(*df.columns).alias("record"),
    )
    order = Window.partitionBy("mid", "slot").orderBy("ts", "tie")
    ahead = time_slots(rows, within_ms, slot_ms).select(
        "own", "entry", "record",
        F.lead("entry").over(order).alias("next_entry"),
        (F.lead("ts").over(order) - F.col("ts")).alias("gap"),
    )
    in_time = F.coalesce(F.col("gap") < within_ms, F.lit(False))
    jumps = ahead.filter("own AND entry").filter(~in_time | F.col("next_entry"))
    out = jumps.select("record.*", F.when(in_time, "matched").otherwise("timeout").alias("kind"))
    return out if kind else out.drop("kind")
