"""The warehouse layers as batch DataFrames over one folder of input tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import schemas as S
from tidemart.functions.times import with_event_time
from tidemart.operators import facts, joins, logs, routing, stats
from tidemart.session import shared_folder
from tidemart.sources import driver_tables as D
from tidemart.sources.changes import cdc_normalize, cdc_snapshot_rules

DAY_MS = 86_400_000


@dataclass(frozen=True)
class Layers:
    """Lazy layers. ``width`` and ``jump_ms`` default to the streaming jobs' own; orders and lines may be 30 days apart."""

    spark: SparkSession
    folder: str
    width: str = stats.WIDTH
    jump_ms: int = 10_000
    order_bound_ms: int = 30 * DAY_MS

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """A layer as a table in the shared folder."""
        path = shared_folder(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ---- logs
    def pages(self) -> DataFrame:
        return D.page_log(self.spark, self.folder)

    def unique_visits(self) -> DataFrame:
        return logs.unique_visit(self.pages())

    def jumps(self) -> DataFrame:
        return logs.user_jump(self.pages(), self.jump_ms)

    def visitor_facts(self) -> DataFrame:
        """Only the columns that are counted go through the shuffles of visits and jumps."""
        thin = self.pages().select("common", F.struct("page.last_page_id", "page.during_time").alias("page"), "ts")
        return facts.visitor_union(thin, logs.unique_visit(thin), logs.user_jump(thin, self.jump_ms))

    def visitor_stats(self) -> DataFrame:
        return stats.visitor_stats(with_event_time(self.visitor_facts()), self.width)

    # ---- orders
    def dims(self) -> dict[str, DataFrame]:
        return D.dimensions(self.spark, self.folder)

    def order_wide(self) -> DataFrame:
        orders = with_event_time(D.order_info(self.spark, self.folder), "create_time")
        details = with_event_time(D.order_detail(self.spark, self.folder), "create_time")
        bound = self.order_bound_ms
        return joins.order_wide_project(joins.order_wide_interval_join(orders, details, bound, bound))

    def order_wide_full(self) -> DataFrame:
        return joins.order_wide_dims(self.order_wide(), self.dims())

    def payment_wide(self, order_wide: DataFrame | None = None) -> DataFrame:
        wide = with_event_time(order_wide if order_wide is not None else self.order_wide_full(), "create_time")
        payments = with_event_time(D.payment_info(self.spark, self.folder), "create_time")
        return joins.payment_wide_project(joins.payment_wide_interval_join(payments, wide))

    # ---- product, province, keyword
    def product_facts(self) -> DataFrame:
        """Products are looked up after counting, so the order lines go in without dimensions.

        They are counted as orders and again as payments, so they are written
        once instead of being joined twice.
        """
        s, f = self.spark, self.folder
        counted = ["order_id", "sku_id", "sku_num", "split_total_amount", "create_time"]
        wide = self.stored(self.order_wide().select(counted), "order_wide")
        lines = wide.select("*", *[F.lit(None).alias(c.name) for c in S.ORDER_WIDE.fields if c.name not in counted])
        return facts.product_union(
            self.pages(), D.favor_info(s, f), D.cart_info(s, f), wide,
            self.payment_wide(lines), D.refund_info(s, f), D.comment_info(s, f),
        )

    def product_stats(self) -> DataFrame:
        counted = stats.product_stats(with_event_time(self.product_facts()), self.width)
        return joins.product_dims(counted, self.dims())

    def province_stats(self) -> DataFrame:
        return stats.province_stats(with_event_time(self.order_wide(), "create_time"), self.width)

    def searches(self) -> DataFrame:
        return logs.search_rows(D.search_log(self.spark, self.folder))

    def keyword_stats(self) -> DataFrame:
        return stats.keyword_stats(self.searches(), self.width)

    def keyword_stats_together(self) -> tuple[DataFrame, bool]:
        """The same, and whether the rows of a day lie together, as they do where no window has too much text for a task."""
        searches, place = stats.windows_together(self.searches(), self.width)
        return stats.keyword_stats(searches, self.width, place=place), place is not None

    # ---- change records
    def changes(self) -> DataFrame:
        return cdc_normalize(D.change_records(self.spark, self.folder))

    def rules(self) -> DataFrame:
        return routing.rules_first_wins(cdc_snapshot_rules(D.rule_records(self.spark, self.folder)))

    def routed(self) -> DataFrame:
        return routing.route_by_rules(self.changes(), self.rules())
