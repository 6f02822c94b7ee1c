"""One query per operator over the input tables.

Each takes (session, folder of parquet tables). The jobs' own ten-second bounds
find few partners in sparse data, so the windowed queries come twice: with those
bounds, and with hours (``_hourly``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart import schemas as S
from tidemart.functions import text, times, tokens
from tidemart.operators import facts, joins, logs, reports, routing, stats
from tidemart.plans.layers import Layers
from tidemart.session import shared_folder, use_settings
from tidemart.sinks import dimensions, topics
from tidemart.sinks.stats import compact_stats, read_stats, write_stats
from tidemart.sources import changes as C
from tidemart.sources import driver_tables as D
from tidemart.sources import tables as TB
from tidemart.sources.topics import read_topic, topic_path, topic_table
from tidemart.streaming import runs, stateful
from tidemart.streaming.jobs import CAPTURED, READERS

HOUR_MS = 3_600_000
HOURLY = {"width": "1 hour", "jump_ms": 6 * HOUR_MS}
REPORT_DAY, GMV_DAY, SEARCH_DAY = 20240110, 19980310, 20240101
FAR_MS = 4_102_444_800_000  # 2100-01-01: a row that lets every window close

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def keep(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(use_settings(spark), folder)

        QUERIES[name] = run
        return fn

    return keep


def flat_log(df: DataFrame) -> DataFrame:
    return df.select("common.mid", "common.is_new", "page.page_id", "page.last_page_id", "page.item", "ts")


def flat_changes(df: DataFrame) -> DataFrame:
    return df.select(
        "database", "table", "type", "ts_ms", F.col("after")["id"].alias("after_id"),
        F.col("after")["status"].alias("after_status"), F.col("after")["note"].alias("after_note"),
        F.col("before")["id"].alias("before_id"),
    )


# ---- sources ------------------------------------------------------------


def topic_of(spark, df: DataFrame, name: str) -> str:
    """Write rows as a JSON topic into the shared folder; gives the address."""
    uri = shared_folder(spark, name)
    topics.write_topic(text.to_value(df), uri, name)
    return uri


def finish(query) -> None:
    query.awaitTermination()


@query("read_topic")
def _(spark, folder):
    uri = topic_of(spark, D.page_log(spark, folder), S.TOPIC_PAGE)
    out = shared_folder(spark, "read_topic")
    parsed = flat_log(text.parse_json(read_topic(spark, uri, S.TOPIC_PAGE), S.LOG))
    finish(runs.checkpointed_run(parsed, f"{out}/data", f"{out}/checkpoint", runs.NOW))
    return spark.read.parquet(f"{out}/data")


@query("topic_table")
def _(spark, folder):
    records = text.to_value(D.page_log(spark, folder))
    topic_table(records, "page_view", S.LOG)
    return spark.sql(
        "select common.mid as mid, page.item as full_word, date_format(rt, 'yyyy-MM-dd HH:mm:ss') as rt "
        "from page_view where page.last_page_id = 'search' and page.item is not null"
    )


@query("cdc_normalize")
def _(spark, folder):
    return flat_changes(Layers(spark, folder).changes())


@query("cdc_snapshot_rules")
def _(spark, folder):
    return C.cdc_snapshot_rules(D.rule_records(spark, folder))


@query("scan_jdbc_table")
def _(spark, folder):
    users = D.table(spark, folder, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(16,2)"))
    return TB.scan_jdbc_table(users)


@query("scan_dim")
def _(spark, folder):
    return TB.scan_dim(D.dimensions(spark, folder)[S.DIM_SKU], tm_id="7", category3_id="6907")


@query("scan_jdbc_dim_sql")
def _(spark, folder):
    nation = D.table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"), F.col("n_name").alias("iso_code"),
    )
    TB.scan_jdbc_dim_sql(nation)
    return spark.sql("select id, name, area_code, iso_code from dim_base_province")


@query("parse_csv_event")
def _(spark, folder):
    return TB.parse_csv_event(D.csv_events(spark, folder))


# ---- sinks --------------------------------------------------------------


@query("write_topic")
def _(spark, folder):
    uri = topic_of(spark, D.page_log(spark, folder), S.TOPIC_PAGE)
    return flat_log(text.parse_json(read_topic(spark, uri, S.TOPIC_PAGE, stream=False), S.LOG))


@query("write_topic_dynamic")
def _(spark, folder):
    uri = shared_folder(spark, "dynamic")
    topics.write_topic_dynamic(topics.topic_rows(routing.to_topics(Layers(spark, folder).routed())), uri)
    return spark.read.option("basePath", uri).text(f"{uri}/topic=*").select("topic", "value")


@query("ensure_dim_table")
def _(spark, folder):
    rules = Layers(spark, folder).rules().filter(F.col("sink_type") == S.SINK_DIMENSION)
    return dimensions.declared_columns(rules)


@query("upsert_dim")
def _(spark, folder):
    """Two batches, the later changes first, with a compaction in between and a repeat after it."""
    root, columns = shared_folder(spark, "dims"), "id,user,status,note"
    made = routing.drop_deletes(Layers(spark, folder).changes())
    first = F.col("type") == "insert"
    dimensions.upsert_dim(made.filter(~first), root, "DIM_ORDER", columns)
    dimensions.compact_dim(spark, root, "DIM_ORDER")
    dimensions.upsert_dim(made.filter(first), root, "DIM_ORDER", columns)
    dimensions.upsert_dim(made.filter(~first), root, "DIM_ORDER", columns)  # a repeat changes nothing
    return dimensions.read_dim(spark, root, "DIM_ORDER")


@query("write_stats")
def _(spark, folder):
    """Batches of one writer, one of them retried, and one without a number; then every day is compacted."""
    path = shared_folder(spark, "stats")
    layers = Layers(spark, folder, **HOURLY)
    counted = layers.stored(layers.visitor_stats(), "visitor_stats")
    hour = F.substring("stt", 12, 2).cast("int") % 3
    for batch in (0, 1, 1):
        write_stats(counted.filter(hour == batch), path, batch, "job")
    write_stats(counted.filter(hour == 2), path)
    bounds = counted.agg(F.min("stt"), F.max("stt")).first()
    for stt in filter(None, set(bounds)):
        compact_stats(spark, path, stt[:10])
    return read_stats(spark, path, counted.schema).drop("day")


@query("new_checkpoint")
def _(spark, folder):
    """Quarters of the log under one topic: by two streams with checkpoints of their own, whose batches have the same
    numbers, and by two calls without a number; a first attempt of each stream gets to a null topic only."""
    uri = shared_folder(spark, "restarted")
    pages = D.page_log(spark, folder)
    for quarter in range(4):
        records = text.to_value(pages.filter(F.pmod("ts", F.lit(4)) == quarter)).select(F.lit(S.TOPIC_PAGE).alias("topic"), "value")
        if quarter < 2:
            records.write.parquet(f"{uri}/in{quarter}")
            stream = spark.readStream.schema(records.schema).parquet(f"{uri}/in{quarter}")

            def write(rows: DataFrame, batch_id: int) -> None:
                lost = rows.limit(1).withColumn("topic", F.lit(None).cast("string"))
                for attempt in (lost, rows.unionAll(lost)):
                    topics.write_topic_dynamic(attempt, f"{uri}/topics", batch_id, runs.writer_of(rows, "pages"))

            finish(runs.run_batches(stream, write, f"{uri}/checkpoint{quarter}", runs.NOW))
        else:
            topics.write_topic_dynamic(records, f"{uri}/topics")
    return flat_log(text.parse_json(read_topic(spark, f"{uri}/topics", S.TOPIC_PAGE, stream=False), S.LOG))


# ---- projection, filter, routing ---------------------------------------


@query("parse_json")
def _(spark, folder):
    parsed = text.parse_json(text.to_value(D.base_log(spark, folder)), S.LOG)
    return parsed.select(
        "common.mid", "common.vc", "common.ch", "common.ar", "common.is_new", "page.page_id", "page.during_time",
        "start.loading_time", F.coalesce(F.size("displays"), F.lit(-1)).alias("n_displays"), "ts",
    )


@query("drop_deletes")
def _(spark, folder):
    return flat_changes(routing.drop_deletes(Layers(spark, folder).changes()))


@query("rules_first_wins")
def _(spark, folder):
    return Layers(spark, folder).rules()


@query("route_by_rules")
def _(spark, folder):
    routed = Layers(spark, folder).routed()
    after = F.col("after")
    return routed.select(
        "sink_type", "sink_table", "table", "type", "ts_ms", after["id"].alias("id"), after["user"].alias("user"),
        after["status"].alias("status"), after["note"].alias("note"), F.size("after").alias("n_fields"),
    )


@query("rules_broadcast_join")
def _(spark, folder):
    layers = Layers(spark, folder)
    joined = routing.rules_broadcast_join(routing.drop_deletes(layers.changes()), layers.rules())
    return joined.select("table", "type", "ts_ms", F.col("after")["id"].alias("id"), "sink_table", "sink_type")


@query("prune_columns")
def _(spark, folder):
    pruned = routing.prune_columns(Layers(spark, folder).changes(), F.split(F.lit("id,note, user"), ","))
    after = F.col("after")
    return pruned.select("table", "type", "ts_ms", after["id"].alias("id"), after["note"].alias("note"),
                         after["user"].alias("user"), after["status"].alias("status"))


@query("split_log")
def _(spark, folder):
    parts = logs.split_log(D.base_log(spark, folder))
    none = F.lit(None).cast("string")
    shapes = {
        S.TOPIC_START: ["common.mid", none.alias("page_id"), F.col("start.loading_time").alias("item")],
        S.TOPIC_PAGE: ["common.mid", "page.page_id", "page.item"],
        S.TOPIC_DISPLAY: ["mid", "page_id", "item"],
    }
    return facts.union_all([parts[t].select(F.lit(t).alias("topic"), *cols, "ts") for t, cols in shapes.items()])


@query("log_topics")
def _(spark, folder):
    rows = logs.log_topics(D.base_log(spark, folder))

    def field(*paths):
        return F.coalesce(*[F.get_json_object("value", f"$.{p}") for p in paths])

    return rows.select(
        "topic", field("common.mid", "mid").alias("mid"), field("page.page_id", "page_id").alias("page_id"),
        field("page.item", "item", "start.loading_time").alias("item"), field("ts").cast("bigint").alias("ts"),
    )


@query("log_topics_whole")
def _(spark, folder):
    """Records with fields that no schema here names, and lines that are no JSON at all."""
    rows = logs.log_topics(logs.fix_is_new(logs.parse_log(D.raw_log(spark, folder))))
    paths = {
        "uid": "common.uid", "is_new": "common.is_new", "mid": "common.mid", "shown_mid": "mid", "source_type": "page.source_type",
        "pos_id": "pos_id", "shown": "item", "action": "actions[0].n", "err": "err.code", "entry": "start.entry",
    }
    found = [F.get_json_object("value", f"$.{path}").alias(name) for name, path in paths.items()]
    broken = F.when(F.col("topic") == S.TOPIC_UNREADABLE, F.col("value")).alias("broken")
    return rows.select("topic", *found, broken)


@query("log_topics_odd")
def _(spark, folder):
    """Displays that are no JSON objects: the record and its good display go on, the others where they can be counted."""
    rows = logs.log_topics(logs.parse_log(D.odd_log(spark, folder)))
    broken = F.when(F.col("topic") == S.TOPIC_UNREADABLE, F.col("value")).alias("broken")
    found = {"mid": "common.mid", "shown_mid": "mid", "shown": "item", "ts": "ts"}
    return rows.select("topic", *[F.get_json_object("value", f"$.{path}").alias(name) for name, path in found.items()], broken)


@query("unreadable_lines")
def _(spark, folder):
    """Change, rule, order and payment records with lines among them that break off: what was read, and what was not."""
    orders = D.table(spark, folder, "orders").select("o_orderkey").filter(F.col("o_orderkey") % 97 == 0)
    suppliers = D.table(spark, folder, "supplier").select("s_suppkey").filter(F.col("s_suppkey") % 10 == 0)
    inputs = {
        "captured": (D.change_records(spark, folder), orders, CAPTURED), "rules": (D.rule_records(spark, folder), suppliers, CAPTURED),
        S.TOPIC_ORDER_INFO: (text.to_value(D.order_info(spark, folder)), orders, READERS[S.TOPIC_ORDER_INFO]),
        S.TOPIC_PAYMENT: (text.to_value(D.payment_info(spark, folder)), orders, READERS[S.TOPIC_PAYMENT]),
    }
    out = []
    for topic, (records, keys, how) in inputs.items():
        checked = text.checked_json(D.with_cut_lines(records, keys), how.schema, how.needs, how.flat)
        read = text.readable_rows(checked).agg(F.count(F.lit(1)).alias("n"))
        out.append(read.select(F.lit(topic).alias("topic"), F.lit(None).cast("string").alias("line"), "n"))
        lost = text.unreadable_lines(checked, topic)
        fields = [F.get_json_object("value", f"$.{c}").alias(c) for c in ("topic", "line")]
        out.append(lost.select(*fields, F.lit(1).cast("bigint").alias("n")))
    return facts.union_all(out)


@query("retried_batch")
def _(spark, folder):
    """A batch written twice, with a downstream stream run after each time: every record arrives once."""
    uri = shared_folder(spark, "retried")
    records = text.to_value(D.page_log(spark, folder)).select(F.lit(S.TOPIC_PAGE).alias("topic"), "value")
    for _attempt in range(2):
        topics.write_topic_dynamic(records, uri, 7, "pages")
        finish(runs.passthrough(spark, uri, S.TOPIC_PAGE, "copy", f"{uri}/checkpoint", runs.NOW))
    return flat_log(text.parse_json(spark.read.text(topic_path(uri, "copy")), S.LOG))


@query("display_enrich")
def _(spark, folder):
    return logs.display_records(D.base_log(spark, folder))


@query("display_whole_record")
def _(spark, folder):
    return flat_log(logs.display_records(D.base_log(spark, folder), whole_record=True))


@query("entry_pages")
def _(spark, folder):
    return flat_log(logs.entry_pages(D.page_log(spark, folder)))


@query("search_rows")
def _(spark, folder):
    rows = logs.search_rows(D.page_log(spark, folder))
    return rows.withColumn("rt", F.date_format("rt", "yyyy-MM-dd HH:mm:ss.SSS"))


ORDER_WIDE_OUT = [
    "order_id", "detail_id", "sku_id", "user_id", "province_id", "order_status", "total_amount", "order_price",
    "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount", "source_type", "create_time",
]


@query("order_wide_interval_join")
def _(spark, folder):
    orders = times.with_event_time(D.order_info(spark, folder), "create_time")
    details = times.with_event_time(D.order_detail(spark, folder), "create_time")
    bound = Layers(spark, folder).order_bound_ms
    joined = joins.order_wide_interval_join(orders, details, bound, bound)
    return joined.select(
        "r.order_id", F.col("r.id").alias("detail_id"), F.col("l.create_time").alias("order_time"),
        F.col("r.create_time").alias("detail_time"), "r.split_total_amount",
    )


@query("order_wide_interval_join_ends")
def _(spark, folder):
    """The jobs' own five seconds, with lines placed inside, at and just beyond both ends of the interval."""
    orders = D.order_info(spark, folder)
    near = D.near_orders(D.order_detail(spark, folder), orders, (-5_001, -5_000, 0, 5_000, 5_001))
    joined = joins.order_wide_interval_join(
        times.with_event_time(orders, "create_time"), times.with_event_time(near, "create_time"), 5_000, 5_000
    )
    return joined.select("r.order_id", F.col("r.id").alias("detail_id"), (F.col("r.create_time") - F.col("l.create_time")).alias("apart"))


@query("order_wide_interval_join_5s")
def _(spark, folder):
    return Layers(spark, folder, order_bound_ms=5_000).order_wide().select(ORDER_WIDE_OUT)


@query("order_wide_project")
def _(spark, folder):
    return Layers(spark, folder).order_wide().select(ORDER_WIDE_OUT)


@query("order_wide_dims")
def _(spark, folder):
    return Layers(spark, folder).order_wide_full().select("order_id", "detail_id", "sku_id", "user_id", *S.ORDER_WIDE_DIMS)


@query("payment_wide_interval_join")
def _(spark, folder):
    payments = times.with_event_time(D.payment_info(spark, folder), "create_time")
    wide = times.with_event_time(Layers(spark, folder).order_wide(), "create_time")
    joined = joins.payment_wide_interval_join(payments, wide)
    return joined.select(
        F.col("l.id").alias("payment_id"), "r.order_id", "r.detail_id",
        F.col("l.create_time").alias("payment_time"), F.col("r.create_time").alias("order_time"),
    )


@query("payment_wide_project")
def _(spark, folder):
    return Layers(spark, folder).payment_wide().select(
        "payment_id", "subject", "payment_type", "payment_create_time", "detail_id", "order_id", "sku_id", "user_id",
        "total_amount", "split_total_amount", "order_create_time", "province_name", "user_age", "user_gender", "tm_name",
    )


@query("visitor_facts")
def _(spark, folder):
    layers = Layers(spark, folder)
    return facts.visitor_facts(layers.pages(), layers.unique_visits(), layers.jumps())[0]


@query("visitor_union")
def _(spark, folder):
    return Layers(spark, folder, **HOURLY).visitor_facts()


@query("product_facts")
def _(spark, folder):
    return facts.page_product_rows(D.page_log(spark, folder)).select("sku_id", "click_ct", "display_ct", "ts")


@query("product_union")
def _(spark, folder):
    return Layers(spark, folder).product_facts()


# ---- joins --------------------------------------------------------------


@query("dim_lookup_join")
def _(spark, folder):
    lines = D.order_detail(spark, folder).select("id", "order_id", "sku_id", "split_total_amount")
    found = {"sku_name": "sku_name", "price": "sku_price"}
    return joins.dim_lookup_join(lines, D.dimensions(spark, folder)[S.DIM_SKU], "sku_id", found)


@query("product_dims")
def _(spark, folder):
    skus = D.cart_info(spark, folder).groupBy("sku_id").agg(F.count(F.lit(1)).alias("cart_ct"))
    return joins.product_dims(skus, D.dimensions(spark, folder))


@query("sql_interval_join")
def _(spark, folder):
    a, b = D.behaviours(spark, folder, "click"), D.behaviours(spark, folder, "purchase")
    return behaviour_text(joins.sql_interval_join(a, b))


@query("sql_interval_join_ends")
def _(spark, folder):
    """The jobs' own 20 seconds, the second table being the first, shifted to both ends of the interval and beyond."""
    a = D.behaviours(spark, folder, "click")
    return behaviour_text(joins.sql_interval_join(a, D.shifted(a, (-20_001, -20_000, 0, 20_000, 20_001))))


@query("sql_interval_join_hourly")
def _(spark, folder):
    a, b = D.behaviours(spark, folder, "click"), D.behaviours(spark, folder, "purchase")
    return behaviour_text(joins.sql_interval_join(a, b, seconds=3600))


def behaviour_text(joined: DataFrame) -> DataFrame:
    return joined.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS") for c in ("ts", "ts0")})


@query("window_stats_join")
def _(spark, folder):
    wide = times.with_event_time(Layers(spark, folder).order_wide(), "create_time")
    return stats.window_stats_join(wide, "30 days")


@query("lateral_table_join")
def _(spark, folder):
    rows = tokens.split_words(D.search_log(spark, folder).select("ts", F.col("page.item").alias("full_word")))
    return rows.select("word", "ts")


@query("jump_union")
def _(spark, folder):
    jumps = logs.user_jump(D.page_log(spark, folder), HOURLY["jump_ms"], kind=True)
    return jumps.select("common.mid", "ts", "kind")


# ---- statistics ---------------------------------------------------------


@query("visitor_stats")
def _(spark, folder):
    return Layers(spark, folder).visitor_stats()


@query("visitor_stats_hourly")
def _(spark, folder):
    return Layers(spark, folder, **HOURLY).visitor_stats()


@query("product_stats")
def _(spark, folder):
    return Layers(spark, folder).product_stats()


@query("product_stats_hourly")
def _(spark, folder):
    return Layers(spark, folder, **HOURLY).product_stats()


@query("province_stats")
def _(spark, folder):
    return Layers(spark, folder).province_stats()


@query("province_stats_monthly")
def _(spark, folder):
    return Layers(spark, folder, width="30 days").province_stats()


@query("province_stats_rows")
def _(spark, folder):
    wide = times.with_event_time(Layers(spark, folder).order_wide(), "create_time")
    return stats.province_stats_rows(wide, "30 days")


@query("keyword_stats")
def _(spark, folder):
    return Layers(spark, folder).keyword_stats()


@query("page_area_counts")
def _(spark, folder):
    return stats.page_area_counts(times.with_event_time(D.page_log(spark, folder)))


@query("key_count_2s")
def _(spark, folder):
    events = TB.parse_csv_event(D.csv_events(spark, folder))
    return stats.key_count(times.with_event_time(events))


@query("window_bounds")
def _(spark, folder):
    pages = times.with_event_time(D.page_log(spark, folder))
    return times.window_bounds(pages.select("common.mid", "ts", F.window("rt", "10 seconds").alias("window")))


STORED: dict[tuple, tuple[str, StructType]] = {}


def input_state(spark: SparkSession, folder: str) -> int:
    """A number that changes when a file of the input tables does: their names, sizes and times, not their contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.agg(F.sum(F.xxhash64("path", "length", "modificationTime") % 1_000_000_007)).first()[0]


def stored_stats(
    spark: SparkSession, folder: str, name: str, day: int, count: Callable[[], DataFrame | tuple[DataFrame, bool]]
) -> DataFrame:
    """One day of statistics as the jobs leave them; counted when the first report asks for them, and anew when the input changes.

    ``count`` may say besides whether the rows of a day lie together (see ``write_stats``).
    """
    key = (spark.sparkContext.applicationId, folder, name, input_state(spark, folder))
    if key not in STORED:
        path, counted = shared_folder(spark, name), count()
        counted, together = counted if isinstance(counted, tuple) else (counted, False)
        write_stats(counted, path, together=together)
        STORED[key] = (path, counted.schema)
    path, schema = STORED[key]
    return read_stats(spark, path, schema, reports.day_text(day))


@query("daily_gmv")
def _(spark, folder):
    def count():
        return stats.product_stats(times.with_event_time(Layers(spark, folder).product_facts()), "1 hour")

    return reports.daily_gmv(stored_stats(spark, folder, "product_stats", GMV_DAY, count), GMV_DAY)


@query("keyword_topn")
def _(spark, folder):
    count = Layers(spark, folder).keyword_stats_together
    return reports.keyword_topn(stored_stats(spark, folder, "keyword_stats", SEARCH_DAY, count), SEARCH_DAY)


@query("channel_topn")
def _(spark, folder):
    return reports.channel_topn(stored_stats(spark, folder, "visitor_stats", REPORT_DAY, Layers(spark, folder).visitor_stats), REPORT_DAY)


# ---- remembering devices ------------------------------------------------


@query("fix_is_new")
def _(spark, folder):
    fixed = logs.fix_is_new(D.base_log(spark, folder))
    return fixed.select("common.mid", "common.is_new", "page.page_id", "ts")


@query("unique_visit")
def _(spark, folder):
    return flat_log(Layers(spark, folder).unique_visits())


@query("user_jump")
def _(spark, folder):
    return flat_log(Layers(spark, folder).jumps())


@query("user_jump_hourly")
def _(spark, folder):
    return flat_log(Layers(spark, folder, **HOURLY).jumps())


# ---- the same on streams ------------------------------------------------


def closing_row(df: DataFrame, ms: str = "ts") -> DataFrame:
    """A far-future row of the same shape that lets every window before it close."""
    columns = [
        F.lit(FAR_MS if f.name == ms else None).cast(f.dataType).alias(f.name) for f in df.schema.fields
    ]
    return df.sparkSession.range(1).select(columns)


#: Orders up to which a slice may hold them, all of which a join of streams keeps in its state with their lines.
SLICE_ORDERS = 2_000_000
#: The state of such a join is as large as its input: one store for all of it, without a look-up per row to count its rows,
#: and only the batches that a restart reads.
JOIN_STATE = {
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


class Feed:
    """Tables that arrive as file streams in time slices, with a run of the query after each slice.

    The slices cut the time range of the first table in equal parts: three, or more where that has more than
    ``slice_rows`` rows for each. A run resumes from the checkpoint of the one before, so rows that belong together across
    slices meet in the state alone. ``settings`` hold while the query runs.
    """

    SLICES = 3

    def __init__(self, spark: SparkSession, slice_rows: int | None = None, settings: dict[str, str] | None = None):
        self.spark, self.parts, self.cuts = spark, [], None
        self.slice_rows, self.settings, self.slices = slice_rows, settings or {}, self.SLICES

    def stream(self, df: DataFrame, name: str, ms: str = "ts", close: bool = True) -> DataFrame:
        """Rows as a file stream; ``close`` lets a closing row follow them."""
        path = shared_folder(self.spark, name)
        if self.cuts is None:
            low, high, rows = df.agg(F.min(ms), F.max(ms), F.count(F.lit(1))).first()
            low, high = low or 0, (high or 0) + 1
            if self.slice_rows:
                self.slices = max(self.SLICES, -(-rows // self.slice_rows))
            self.cuts = [low + (high - low) * i // self.slices for i in range(1, self.slices)]
        bounds = [None, *self.cuts, None]
        for i, (start, end) in enumerate(zip(bounds, bounds[1:])):
            part = df if start is None else df.filter(F.col(ms) >= start)
            part = part if end is None else part.filter(F.col(ms) < end)
            self.parts.append((i, part, f"{path}/{i}"))
        if close:
            self.parts.append((self.slices, closing_row(df, ms), f"{path}/{self.slices}"))
        return self.spark.readStream.schema(df.schema).parquet(f"{path}/*")

    def run(self, start: Callable[[], object]) -> None:
        conf = self.spark.conf
        before = {key: conf.get(key, None) for key in self.settings}
        for key, value in self.settings.items():
            conf.set(key, value)
        try:
            for i in range(self.slices + 1):
                now = [(part, path) for k, part, path in self.parts if k == i]
                for part, path in now:
                    part.write.parquet(path)
                if now:
                    finish(start())
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)

    def result(self, df: DataFrame, name: str) -> DataFrame:
        out = shared_folder(self.spark, name)
        self.run(lambda: runs.checkpointed_run(df, f"{out}/data", f"{out}/checkpoint", runs.NOW))
        return self.spark.read.parquet(f"{out}/data")

    def settled(self, run, name: str) -> DataFrame:
        """The batches that runs over ``write`` have written."""
        out = shared_folder(self.spark, name)

        def write(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")

        self.run(lambda: run(write, f"{out}/checkpoint", runs.NOW))
        return self.spark.read.parquet(f"{out}/data").drop("batch")


@query("fix_is_new_stream")
def _(spark, folder):
    feed = Feed(spark)
    stream = feed.stream(D.base_log(spark, folder), "base_log", close=False)
    fixed = feed.settled(partial(stateful.fix_is_new_stream, stream), "fixed")
    return fixed.select("common.mid", "common.is_new", "page.page_id", "ts")


@query("unique_visit_stream")
def _(spark, folder):
    feed = Feed(spark)
    stream = feed.stream(D.page_log(spark, folder), "pages", close=False)
    return flat_log(feed.settled(partial(stateful.unique_visit_stream, stream), "visits"))


@query("user_jump_stream")
def _(spark, folder):
    feed = Feed(spark)
    stream = feed.stream(D.page_log(spark, folder), "pages")
    jumps = stateful.user_jump_stream(stream, HOURLY["jump_ms"], "2 seconds", kind=True)
    result = feed.result(jumps.select("common.mid", "ts", "kind"), "jumps")
    return result.filter(F.col("ts") < FAR_MS)


@query("visitor_stats_stream")
def _(spark, folder):
    rows = Layers(spark, folder, **HOURLY).visitor_facts()
    feed = Feed(spark)
    stream = times.with_event_time(feed.stream(rows, "visitor_rows"), "ts", "12 seconds")
    return feed.result(stats.visitor_stats(stream, "1 hour"), "visitor_stats")


@query("product_stats_stream")
def _(spark, folder):
    rows = Layers(spark, folder).product_facts()
    feed = Feed(spark)
    stream = times.with_event_time(feed.stream(rows, "product_rows"), "ts", "905 seconds")
    counted = feed.result(stats.product_stats(stream, "1 hour"), "product_stats")
    return joins.product_dims(counted, D.dimensions(spark, folder))


@query("order_wide_stream")
def _(spark, folder):
    bound = Layers(spark, folder).order_bound_ms
    feed, sides = Feed(spark, SLICE_ORDERS, JOIN_STATE), []
    for name, rows in (("orders", D.order_info(spark, folder)), ("details", D.order_detail(spark, folder))):
        sides.append(times.with_event_time(feed.stream(rows, name, "create_time"), "create_time", "2 seconds"))
    joined = joins.order_wide_interval_join(*sides, bound, bound)
    return feed.result(joins.order_wide_project(joined).select(ORDER_WIDE_OUT), "order_wide")


@query("key_count_2s_stream")
def _(spark, folder):
    rows = TB.parse_csv_event(D.csv_events(spark, folder))
    feed = Feed(spark)
    stream = times.with_event_time(feed.stream(rows, "csv"), "ts", "0 seconds")
    return feed.result(stats.key_count(stream), "key_count")


@query("bounded_watermark")
def _(spark, folder):
    feed = Feed(spark)
    stream = feed.stream(D.page_log(spark, folder), "pages")
    stamped = times.bounded_watermark(times.with_event_time(stream), "2 seconds")
    return feed.result(stats.page_area_counts(stamped), "areas")


@query("late_drop")
def _(spark, folder):
    """The whole log again, after a far-future row: every repeated row is late and lost."""
    pages = D.page_log(spark, folder)
    path, out = shared_folder(spark, "late"), shared_folder(spark, "late_out")
    stream = spark.readStream.schema(pages.schema).parquet(f"{path}/*")
    counted = stats.page_area_counts(times.with_event_time(stream, "ts", "2 seconds"))
    for i, rows in enumerate([pages, closing_row(pages), pages]):
        rows.write.parquet(f"{path}/{i}")
        finish(runs.checkpointed_run(counted, f"{out}/data", f"{out}/checkpoint", runs.NOW))
    return spark.read.parquet(f"{out}/data")


@query("late_rows")
def _(spark, folder):
    """How many rows a query loses to the watermark: the whole log once more, after a far-future row."""
    pages = D.page_log(spark, folder)
    path, out = shared_folder(spark, "late_rows"), shared_folder(spark, "late_rows_out")
    stream = times.with_event_time(spark.readStream.schema(pages.schema).parquet(f"{path}/*"), "ts", "2 seconds")
    once = stream.select(F.col("common.mid").alias("mid"), "rt").dropDuplicates(["mid", "rt"])
    watched = runs.watch_late(spark)
    try:
        for i, rows in enumerate([pages, closing_row(pages), pages]):
            rows.write.parquet(f"{path}/{i}")
            query = runs.checkpointed_run(once, f"{out}/data", f"{out}/checkpoint", runs.NOW)
            finish(query)
        lost = watched.of(query)
    finally:
        spark.streams.removeListener(watched)
    return spark.createDataFrame([(lost,)], "lost long")


@query("passthrough")
def _(spark, folder):
    uri = topic_of(spark, D.page_log(spark, folder), S.TOPIC_PAGE)
    finish(runs.passthrough(spark, uri, S.TOPIC_PAGE, "copy", f"{uri}/checkpoint", runs.NOW))
    return flat_log(text.parse_json(spark.read.text(topic_path(uri, "copy")), S.LOG))


@query("checkpointed_run")
def _(spark, folder):
    """The log in two halves with a stop in between; every row arrives once."""
    pages = flat_log(D.page_log(spark, folder))
    path, out = shared_folder(spark, "halves"), shared_folder(spark, "resumed")
    stream = spark.readStream.schema(pages.schema).parquet(f"{path}/*")
    for i, half in enumerate([F.col("ts") % 2 == 0, F.col("ts") % 2 == 1]):
        pages.filter(half).write.parquet(f"{path}/{i}")
        finish(runs.checkpointed_run(stream, f"{out}/data", f"{out}/checkpoint", runs.NOW))
    return spark.read.parquet(f"{out}/data")


# ---- functions ----------------------------------------------------------


def event_rows(spark, folder) -> DataFrame:
    return D.table(spark, folder, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "event_type", "props", "user_id"
    )


@query("time_functions")
def _(spark, folder):
    return event_rows(spark, folder).select(
        "event_id", times.ymd("ms").alias("ymd"), times.ymd_hms("ms").alias("ymd_hms"),
        times.utc_text("ms").alias("utc_text"),
        F.date_format(times.event_time("ms"), "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"),
        times.yyyymmdd(times.ymd_hms("ms")).alias("yyyymmdd"),
    )


@query("text_functions")
def _(spark, folder):
    rows = event_rows(spark, folder).withColumn("entries", F.from_json("props", "MAP<STRING, STRING>"))
    rows = rows.withColumn("listed", F.concat_ws(",", "event_type", F.lit(" b"), F.col("entries")["k"]))
    rows = rows.withColumn("money", F.concat(F.col("entries")["k"], F.lit(".50")))
    return rows.select(
        "event_id", F.lower(F.upper("event_type")).alias("lowered"), F.col("entries")["k"].alias("map_value"),
        F.get_json_object("props", "$.k").alias("json_value"), F.size(text.comma_list("listed")).alias("n_parts"),
        F.concat_ws(",", text.comma_list("listed")).alias("joined"),
        F.col("entries")["k"].try_cast("bigint").alias("as_long"), text.as_long("event_type").alias("not_a_number"),
        text.as_money("money").alias("as_money"), text.tuple_text("event_type", "user_id", "event_id").alias("tuple"),
    )


@query("split_words")
def _(spark, folder):
    rows = tokens.split_words(D.table(spark, folder, "documents").select("doc_id", "text"), "text")
    return rows.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def dictionary_counts(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Words of whole texts, counted before the dictionary sees them: one row per word."""
    words = tokens.candidate_words(docs, "text", tokens.Prefixes(dictionary), counts="_n")
    per_text = words.groupBy("doc_id", "_han", "word").agg(F.sum("_n").alias("n"))
    counted = per_text.groupBy("_han", "word").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs"))
    return tokens.in_dictionary(counted, dictionary)


@query("keyword_tokens")
def _(spark, folder):
    """Whole texts against a dictionary: here the words of the benchmark passages."""
    docs = D.table(spark, folder, "documents").select("doc_id", "text")
    passages = D.table(spark, folder, "benchmark").select("text")
    return dictionary_counts(docs, tokens.split_words(passages, "text").distinct())


@query("keyword_tokens_han")
def _(spark, folder):
    """The same with each Latin letter written as a Han character, so that nearly all words are Han runs."""
    docs = D.han_texts(D.table(spark, folder, "documents").select("doc_id", "text"))
    words = tokens.split_words(D.han_texts(D.table(spark, folder, "benchmark").select("text")), "text")
    return dictionary_counts(docs, words.distinct())
