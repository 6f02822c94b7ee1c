"""The warehouse as streaming jobs, one query per step, topics in between.

Every job takes the topic address, a checkpoint folder and a trigger, and
returns its started query. The jobs that write more than one topic or look up
dimensions do so per micro-batch. A retried batch adds what its first attempt
did not get to publish, and nothing twice. A job with a new checkpoint is a new
writer, whose batches count from zero again and are never taken for old ones.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart import schemas as S
from tidemart.functions.text import checked_json, readable_rows, to_value, unreadable_lines
from tidemart.functions.times import with_event_time
from tidemart.operators import facts, joins, logs, routing, stats
from tidemart.sinks import dimensions, topics
from tidemart.sinks.stats import write_stats
from tidemart.sources.changes import cdc_normalize, cdc_snapshot_rules
from tidemart.sources.topics import read_topic
from tidemart.streaming import stateful
from tidemart.streaming.rules import Rules
from tidemart.streaming.runs import run_batches, writer_of

PAGE = [f for f in S.LOG.fieldNames() if f != "start"]


@dataclass(frozen=True)
class Reader:
    """How the lines of a topic are read: their shape, the fields without which a line cannot be used, and whether it is
    flat, so that numbers may come quoted."""

    schema: StructType
    needs: tuple[str, ...] = ()
    flat: bool = False


READERS = {
    S.TOPIC_BASE_DB: Reader(S.CHANGE, ("table",)),
    **dict.fromkeys((S.TOPIC_PAGE, S.TOPIC_UNIQUE_VISIT, S.TOPIC_USER_JUMP), Reader(S.LOG, ("common", "ts"))),
    S.TOPIC_ORDER_INFO: Reader(S.ORDER_INFO, ("id", "create_time"), True),
    S.TOPIC_ORDER_DETAIL: Reader(S.ORDER_DETAIL, ("order_id", "create_time"), True),
    S.TOPIC_PAYMENT: Reader(S.PAYMENT_INFO, ("order_id", "create_time"), True),
    S.TOPIC_ORDER_WIDE: Reader(S.ORDER_WIDE, ("order_id", "create_time"), True),
    S.TOPIC_PAYMENT_WIDE: Reader(S.PAYMENT_WIDE, ("order_id", "order_create_time"), True),
    S.TOPIC_FAVOR: Reader(S.SKU_ACTION, ("sku_id", "create_time"), True),
    S.TOPIC_CART: Reader(S.SKU_ACTION, ("sku_id", "create_time"), True),
    S.TOPIC_REFUND: Reader(S.REFUND, ("sku_id", "create_time"), True),
    S.TOPIC_COMMENT: Reader(S.COMMENT, ("sku_id", "create_time"), True),
}
#: Captured changes and rules, under whatever name their topics have.
CAPTURED = Reader(S.CHANGE_IN)


def _dimension_tables(rules: DataFrame) -> dict[str, tuple[str, str | None]]:
    """Columns and key of every dimension table the rules name: a few rows per rule."""
    named = rules.filter(F.col("sink_type") == S.SINK_DIMENSION).select("sink_table", "sink_columns", "sink_pk")
    tables: dict[str, tuple[str, str | None]] = {}
    for r in named.orderBy("sink_table", "sink_columns").collect():
        columns, pk = tables.get(r.sink_table, ("", r.sink_pk))
        # insert and update rules of a table list its columns together
        merged = dict.fromkeys([c for c in columns.split(",") if c] + r.sink_columns.split(","))
        tables[r.sink_table] = (",".join(merged), pk)
    return tables


@dataclass
class Jobs:
    """Where topics, dimension tables, statistics and checkpoints live."""

    spark: SparkSession
    uri: str
    dims_root: str
    stats_root: str
    checkpoints: str
    trigger: dict | None = None
    files_per_trigger: int | None = None
    compact_every: int = 100
    _made: set[tuple[str, str]] = field(default_factory=set, repr=False)

    def _read(self, topic: str) -> DataFrame:
        return read_topic(self.spark, self.uri, topic, files_per_trigger=self.files_per_trigger)

    def _checked(self, topic: str, reader: Reader | None = None) -> DataFrame:
        how = reader or READERS[topic]
        return checked_json(self._read(topic), how.schema, how.needs, how.flat)

    def _records(self, topic: str) -> DataFrame:
        """The readable records of a topic; ``unreadable`` publishes the others."""
        return readable_rows(self._checked(topic))

    def _pages(self, topic: str = S.TOPIC_PAGE) -> DataFrame:
        return self._records(topic).select(PAGE)

    def _run(self, name: str, df: DataFrame, write):
        return run_batches(df, write, f"{self.checkpoints}/{name}", self.trigger)

    def _writer(self, name: str):
        """Writes a micro-batch as JSON under a topic."""

        def write(rows: DataFrame, batch_id: int) -> None:
            named = to_value(rows).select(F.lit(name).alias("topic"), "value")
            topics.write_topic_dynamic(named, self.uri, batch_id, writer_of(rows, name))

        return write

    def _publish(self, name: str, df: DataFrame):
        return self._run(name, df, self._writer(name))

    def _dims(self, columns: dict[str, list[str]]) -> dict[str, DataFrame]:
        """The dimension tables a lookup names; one that is not there yet is empty."""
        return {n: dimensions.read_dim(self.spark, self.dims_root, n, c, "id") for n, c in columns.items()}

    def unreadable(self, *captured: str):
        """The lines of all topics that the jobs cannot read, to a topic of their own, each with its topic's name.

        ``captured`` names the topics of change records and rules. The jobs themselves leave such lines out; those of
        the raw log are ``split_logs``'s to tell apart. ``unreadable_counts`` counts them.
        """
        readers = {**READERS, **dict.fromkeys(captured, CAPTURED)}
        lines = [unreadable_lines(self._checked(topic, how), topic) for topic, how in readers.items()]

        def write(rows: DataFrame, batch_id: int) -> None:
            named = rows.select(F.lit(S.TOPIC_UNREADABLE_LINES).alias("topic"), "value")
            topics.write_topic_dynamic(named, self.uri, batch_id, writer_of(rows, "unreadable"))

        return self._run("unreadable", reduce(DataFrame.unionAll, lines), write)

    def unreadable_counts(self) -> DataFrame:
        """How many unreadable lines each topic had."""
        lines = read_topic(self.spark, self.uri, S.TOPIC_UNREADABLE_LINES, stream=False)
        return lines.groupBy(F.get_json_object("value", "$.topic").alias("topic")).agg(F.count(F.lit(1)).alias("lines"))

    # ---- change capture and routing

    def changes(self, source_topic: str):
        """Captured change JSON to the change topic."""
        return self._publish(S.TOPIC_BASE_DB, cdc_normalize(self._read(source_topic)))

    def route(self, rules_topic: str, latest: bool = False):
        """The change topic to its target topics and dimension tables, by the rules of the moment.

        A micro-batch brings changes and rules. New rules are added to a small table of those known (see
        ``streaming.rules``), so a batch costs the same however old the rules' topic is.
        """
        kept = Rules(self.spark, f"{self.dims_root}/ROUTING_RULES", latest)
        kept.start(lambda: cdc_snapshot_rules(read_topic(self.spark, self.uri, rules_topic, stream=False)))
        sides = [self._read(t).select(F.lit(t).alias("topic"), "value") for t in (S.TOPIC_BASE_DB, rules_topic)]

        def write(rows: DataFrame, batch_id: int) -> None:
            rows = rows.persist()
            rules = kept.with_new(cdc_snapshot_rules(rows.filter(F.col("topic") == rules_topic))).persist()
            # reading the tables also fills the cache, so the planner knows the rules' true size
            tables = _dimension_tables(rules)
            how = READERS[S.TOPIC_BASE_DB]
            changes = checked_json(rows.filter(F.col("topic") == S.TOPIC_BASE_DB), how.schema, how.needs)
            routed = routing.route_by_rules(readable_rows(changes), rules).persist()
            to_topics = topics.topic_rows(routing.to_topics(routed))
            topics.write_topic_dynamic(to_topics, self.uri, batch_id, writer_of(rows, "route"))
            to_dims = routing.to_dimensions(routed)
            changed = {r.sink_table for r in to_dims.select("sink_table").distinct().collect()}

            def store(name: str) -> None:
                columns, pk = tables[name]
                if (name, columns) not in self._made:
                    dimensions.ensure_dim_table(self.spark, self.dims_root, name, columns, pk)
                    self._made.add((name, columns))
                if name in changed:
                    mine = to_dims.filter(F.col("sink_table") == name)
                    dimensions.upsert_dim(mine, self.dims_root, name, columns, pk)
                if batch_id % self.compact_every == self.compact_every - 1:
                    dimensions.compact_dim(self.spark, self.dims_root, name)

            with ThreadPoolExecutor(8) as pool:  # a small table does not wait for a large one
                list(pool.map(store, tables))
            for cached in (routed, rules, rows):
                cached.unpersist()

        return self._run("route", sides[0].unionAll(sides[1]), write)

    # ---- logs

    def split_logs(self):
        """The raw log to start, page and display topics, records whole, with ``is_new`` put right.

        Lines that are no JSON objects go to a topic of their own.
        """

        def write(rows: DataFrame, batch_id: int) -> None:
            topics.write_topic_dynamic(logs.log_topics(rows), self.uri, batch_id, writer_of(rows, "split_logs"))

        log = logs.parse_log(self._read(S.TOPIC_BASE_LOG))
        return stateful.fix_is_new_stream(log, write, f"{self.checkpoints}/split_logs", self.trigger)

    def unique_visits(self):
        name = S.TOPIC_UNIQUE_VISIT
        return stateful.unique_visit_stream(self._pages(), self._writer(name), f"{self.checkpoints}/{name}", self.trigger)

    def user_jumps(self, within_ms: int = 10_000, delay: str = "2 seconds"):
        return self._publish(S.TOPIC_USER_JUMP, stateful.user_jump_stream(self._pages(), within_ms, delay))

    # ---- orders

    def order_wide(self, before_ms: int = 5_000, after_ms: int = 5_000, delay: str = "2 seconds"):
        orders = with_event_time(self._records(S.TOPIC_ORDER_INFO), "create_time", delay)
        details = with_event_time(self._records(S.TOPIC_ORDER_DETAIL), "create_time", delay)
        wide = joins.order_wide_project(joins.order_wide_interval_join(orders, details, before_ms, after_ms))

        def write(rows: DataFrame, batch_id: int) -> None:
            rows = rows.persist()
            hot = joins.hot_ids(rows, joins.ORDER_IDS)
            full = to_value(joins.order_wide_dims(rows, self._dims(joins.ORDER_DIMS), hot))
            named = full.select(F.lit(S.TOPIC_ORDER_WIDE).alias("topic"), "value")
            topics.write_topic_dynamic(named, self.uri, batch_id, writer_of(rows, S.TOPIC_ORDER_WIDE))
            rows.unpersist()

        return self._run(S.TOPIC_ORDER_WIDE, wide, write)

    def payment_wide(self, delay: str = "2 seconds"):
        payments = with_event_time(self._records(S.TOPIC_PAYMENT), "create_time", delay)
        wide = with_event_time(self._records(S.TOPIC_ORDER_WIDE), "create_time", delay)
        joined = joins.payment_wide_interval_join(payments, wide)
        return self._publish(S.TOPIC_PAYMENT_WIDE, joins.payment_wide_project(joined))

    # ---- statistics

    def _store(self, name: str, df: DataFrame, finish=lambda rows: rows):
        def write(rows: DataFrame, batch_id: int) -> None:
            write_stats(finish(rows), f"{self.stats_root}/{name}", batch_id, writer_of(rows, name))

        return self._run(name, df, write)

    def visitor_stats(self, width: str = stats.WIDTH, delay: str = "12 seconds"):
        rows = facts.visitor_union(
            self._pages(), self._pages(S.TOPIC_UNIQUE_VISIT), self._pages(S.TOPIC_USER_JUMP)
        )
        return self._store("visitor_stats", stats.visitor_stats(with_event_time(rows, "ts", delay), width))

    def product_stats(self, width: str = stats.WIDTH, delay: str = "905 seconds"):
        """Paid rows carry order time, up to 15 minutes back, so the default delay waits for them."""
        rows = facts.product_union(
            self._pages(),
            self._records(S.TOPIC_FAVOR), self._records(S.TOPIC_CART),
            self._records(S.TOPIC_ORDER_WIDE), self._records(S.TOPIC_PAYMENT_WIDE),
            self._records(S.TOPIC_REFUND), self._records(S.TOPIC_COMMENT),
        )
        counted = stats.product_stats(with_event_time(rows, "ts", delay), width)
        return self._store("product_stats", counted, lambda rows: joins.product_dims(rows, self._dims(joins.PRODUCT_DIMS)))

    def province_stats(self, width: str = stats.WIDTH, delay: str = "2 seconds"):
        wide = with_event_time(self._records(S.TOPIC_ORDER_WIDE), "create_time", delay)
        return self._store("province_stats", stats.province_stats(wide, width))

    def keyword_stats(self, width: str = stats.WIDTH, delay: str = "2 seconds", dictionary: DataFrame | None = None):
        searches = logs.search_rows(self._pages()).withWatermark("rt", delay)
        return self._store("keyword_stats", stats.keyword_stats(searches, width, dictionary))
