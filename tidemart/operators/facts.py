"""Rows of one shape from many inputs, ready to be summed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart import schemas as S
from tidemart.functions.text import is_entry


def _visitor_rows(df: DataFrame, **measures) -> DataFrame:
    sums = [F.lit(measures.get(m, 0)).cast("bigint").alias(m) for m in S.VISITOR_MEASURES]
    return df.select(*[F.col(f"common.{k}").alias(k) for k in S.VISITOR_KEYS], *sums, "ts")


def visitor_facts(pages: DataFrame, unique_visits: DataFrame, jumps: DataFrame) -> list[DataFrame]:
    """Page views, unique visits and bounced visits as rows of the visitor measures."""
    views = _visitor_rows(
        pages,
        pv_ct=1,
        sv_ct=F.when(is_entry(), 1).otherwise(0),
        dur_sum=F.coalesce("page.during_time", F.lit(0)),
    )
    return [views, _visitor_rows(unique_visits, uv_ct=1), _visitor_rows(jumps, uj_ct=1)]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def visitor_union(pages: DataFrame, unique_visits: DataFrame, jumps: DataFrame) -> DataFrame:
    return union_all(visitor_facts(pages, unique_visits, jumps))


_PRODUCT_TYPES = {**{c: "bigint" for c in S.PRODUCT_COUNTS}, **{c: "decimal(16,2)" for c in S.PRODUCT_AMOUNTS}}


def _product_rows(
    df: DataFrame, sku: str | Column, ts: str | Column, kind: str | None = None, order_id: str | None = None, **measures
) -> DataFrame:
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    cols = [col(sku).try_cast("bigint").alias("sku_id")]
    cols += [col(measures.get(m, F.lit(0))).cast(t).alias(m) for m, t in _PRODUCT_TYPES.items()]
    cols += [
        F.lit(kind).cast("string").alias("order_kind"),
        (F.col(order_id) if order_id else F.lit(None)).cast("bigint").alias("order_id"),
        col(ts).cast("bigint").alias("ts"),
    ]
    return df.select(cols)


def page_product_rows(pages: DataFrame) -> DataFrame:
    """Clicks on a product page and products shown on any page, in one pass over the log."""
    clicked = (F.col("page.page_id") == S.DETAIL_PAGE) & (F.col("page.item_type") == S.SKU_ITEM)
    hit = F.when(
        clicked, F.array(F.struct(F.col("page.item").alias("item"), F.lit(1).alias("click"), F.lit(0).alias("display")))
    )
    shown = F.transform(
        F.filter("displays", lambda d: d["item_type"] == S.SKU_ITEM),
        lambda d: F.struct(d["item"].alias("item"), F.lit(0).alias("click"), F.lit(1).alias("display")),
    )
    none = F.array().cast("array<struct<item:string,click:int,display:int>>")
    rows = pages.select("ts", F.explode(F.concat(F.coalesce(hit, none), F.coalesce(shown, none))).alias("_i"))
    return _product_rows(rows, "_i.item", "ts", click_ct="_i.click", display_ct="_i.display")


def product_facts(
    pages: DataFrame, favors: DataFrame, carts: DataFrame, order_wide: DataFrame,
    payment_wide: DataFrame, refunds: DataFrame, comments: DataFrame,
) -> list[DataFrame]:
    """Seven inputs as rows of the product measures.

    Rows about orders name the order and its kind (``order``, ``paid`` or
    ``refund``); a paid row counts at the time its order was made.
    """
    one = F.lit(1)
    good = F.when(F.col("appraise") == S.GOOD_APPRAISE, 1).otherwise(0)
    return [
        page_product_rows(pages),
        _product_rows(favors, "sku_id", "create_time", favor_ct=one),
        _product_rows(carts, "sku_id", "create_time", cart_ct=one),
        _product_rows(
            order_wide, "sku_id", "create_time", "order", "order_id",
            order_sku_num="sku_num", order_amount="split_total_amount",
        ),
        _product_rows(
            payment_wide, "sku_id", "order_create_time", "paid", "order_id",
            payment_amount="split_total_amount",
        ),
        _product_rows(refunds, "sku_id", "create_time", "refund", "order_id", refund_amount="refund_amount"),
        _product_rows(comments, "sku_id", "create_time", comment_ct=one, good_comment_ct=good),
    ]


def product_union(*inputs: DataFrame) -> DataFrame:
    return union_all(product_facts(*inputs))
