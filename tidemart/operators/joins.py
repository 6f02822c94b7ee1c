"""Interval joins and dimension lookups."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart import schemas as S


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    lower_ms: int,
    upper_ms: int,
    slot_ms: int | None = None,
    rt: str = "rt",
) -> DataFrame:
    """Inner join where ``right.rt`` lies in ``[left.rt + lower, left.rt + upper]``.

    Works on tables and on streams whose ``rt`` has a watermark. Besides the
    keys, both sides meet on a time slot: a right row has one slot, a left row
    one per slot its interval touches, so each pair meets once and the rows of a
    hot key spread over time. Longer slots copy the left side less; shorter ones
    spread a hot key more. Give the side with fewer rows as ``left``. Columns are
    then found as ``l.<name>`` and ``r.<name>``.
    """
    slot_ms = slot_ms or max(upper_ms - lower_ms, 1)

    def slot(shift_ms: int) -> Column:
        ms = F.unix_millis(rt) + F.lit(shift_ms)
        return ms - F.pmod(ms, F.lit(slot_ms))

    slots = F.sequence(slot(lower_ms), slot(upper_ms), F.lit(slot_ms).cast("bigint"))
    spread = left.withColumn("_slot", F.explode(slots))
    placed = right.withColumn("_slot", slot(0))
    cond = F.col("l._slot") == F.col("r._slot")
    for a, b in on:
        cond = cond & (F.col(f"l.{a}") == F.col(f"r.{b}"))
    low, high = F.lit(timedelta(milliseconds=lower_ms)), F.lit(timedelta(milliseconds=upper_ms))
    cond = cond & (F.col(f"r.{rt}") >= F.col(f"l.{rt}") + low) & (F.col(f"r.{rt}") <= F.col(f"l.{rt}") + high)
    return spread.alias("l").join(placed.alias("r"), cond)


def order_wide_interval_join(
    orders: DataFrame, details: DataFrame, before_ms: int = 5_000, after_ms: int = 5_000
) -> DataFrame:
    """Orders with their lines, where line time is within the bounds of order time.

    Both inputs carry ``rt``. There are fewer orders than lines, so orders are
    the copied side, and four interval widths per slot keep the copies at 1.25.
    """
    slot = 4 * (before_ms + after_ms)
    return interval_join(orders, details, [("id", "order_id")], -before_ms, after_ms, slot)


def order_wide_project(joined: DataFrame, keep_rt: bool = False) -> DataFrame:
    """The order-line columns of a joined order and detail; time is the order's."""
    cols = [F.col(f"l.{c}") for c in S.ORDER_WIDE_FROM_ORDER]
    cols += [F.col("r.id").alias("detail_id"), F.col("r.order_id")]
    cols += [F.col(f"r.{c}") for c in S.ORDER_WIDE_FROM_DETAIL]
    cols += [F.col("l.create_time")]
    return joined.select(*cols, *([F.col("l.rt")] if keep_rt else []))


def payment_wide_interval_join(
    payments: DataFrame, order_wide: DataFrame, before_ms: int = 900_000, after_ms: int = 5_000
) -> DataFrame:
    """Payments with the order lines made up to ``before_ms`` earlier; inputs carry ``rt``."""
    slot = 4 * (before_ms + after_ms)
    return interval_join(payments, order_wide, [("order_id", "order_id")], -before_ms, after_ms, slot)


def payment_wide_project(joined: DataFrame) -> DataFrame:
    """Payment columns, then order-line columns; the order line wins on shared names."""
    own = {
        "payment_id": "l.id", "subject": "l.subject", "payment_type": "l.payment_type",
        "payment_create_time": "l.create_time", "callback_time": "l.callback_time",
        "order_create_time": "r.create_time",
    }
    known = {f.name for f in S.ORDER_WIDE.fields}
    cols = []
    for field in S.PAYMENT_WIDE.fields:
        if field.name in own:
            source = F.col(own[field.name])
        elif field.name in known:
            source = F.col(f"r.{field.name}")
        else:  # split_feight_fee, province_name and user_age have no source
            source = F.lit(None)
        cols.append(source.cast(field.dataType).alias(field.name))
    return joined.select(cols)


def hot_ids(df: DataFrame, columns: list[str], share: float | None = None) -> dict[str, list]:
    """The ids that hold more than ``share`` of the rows, by column: at most 1 / share of each.

    By default half of an even shuffle partition. One aggregate over all columns; give it rows that are kept.
    """
    share = share or 0.5 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("id")) for c in columns])
    counted = df.select(F.inline(ids)).groupBy("name", "id").agg(F.count(F.lit(1)).alias("n"))
    out: dict[str, list] = {c: [] for c in columns}
    for r in counted.filter(F.col("n") > df.count() * share).collect():
        out[r.name].append(r.id)
    return out


def dim_lookup_join(
    df: DataFrame, dim: DataFrame, id_col: str, fields: dict[str, str], dim_id: str = "id",
    hot: dict[str, list] | None = None, salts: int = 32,
) -> DataFrame:
    """Copy dimension columns by id: ``fields`` maps dimension column to new column.

    Left join; a row without a match gets nulls. Dimension ids are text and
    unique. No hint is given: the planner broadcasts a dimension whose size is
    under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where
    adaptive execution splits a hot id. Where it is off, as in the micro-batches
    of stateful streams, ``hot`` (see ``hot_ids``) names the ids to split: their
    rows are dealt out over ``salts`` numbers, and only their dimension rows are
    copied as often. Rows without an id match nothing and are dealt out too.
    """
    side = dim.select(
        F.col(dim_id).cast("string").alias("_dim_id"), *[F.col(src).alias(dst) for src, dst in fields.items()]
    )
    bare = df.drop(*fields.values())
    same = bare[id_col].cast("string") == side["_dim_id"]
    if not (hot and hot.get(id_col)):
        return bare.join(side, same, "left").drop("_dim_id")
    ids = [i for i in hot[id_col] if i is not None]
    dealt = bare[id_col].isNull() | bare[id_col].cast("string").isin(ids)
    salt = F.when(dealt, F.pmod(F.xxhash64(*bare.columns), F.lit(salts))).otherwise(0).cast("int")
    copies = F.when(side["_dim_id"].isin(ids), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left, right = bare.withColumn("_salt", salt), side.withColumn("_copy", F.explode(copies))
    met = left.join(right, (left[id_col].cast("string") == right["_dim_id"]) & (left["_salt"] == right["_copy"]), "left")
    return met.drop("_dim_id", "_salt", "_copy")


#: The columns that the lookups below read of each dimension table.
PRODUCT_DIMS = {
    S.DIM_SKU: ["id", "sku_name", "price", "spu_id", "tm_id", "category3_id"], S.DIM_SPU: ["id", "spu_name"],
    S.DIM_TRADEMARK: ["id", "tm_name"], S.DIM_CATEGORY3: ["id", "name"],
}
ORDER_DIMS = {**PRODUCT_DIMS, S.DIM_USER: ["id", "gender"], S.DIM_PROVINCE: ["id", "area_code", "iso_code", "iso_3166_2"]}
ORDER_IDS = ["user_id", "sku_id", "province_id"]


def product_dimension(dims: dict[str, DataFrame]) -> DataFrame:
    """The product table with the names its spu, trademark and category ids stand for: a row per product."""
    out = dims[S.DIM_SKU].select(*PRODUCT_DIMS[S.DIM_SKU])
    out = dim_lookup_join(out, dims[S.DIM_SPU], "spu_id", {"spu_name": "spu_name"})
    out = dim_lookup_join(out, dims[S.DIM_TRADEMARK], "tm_id", {"tm_name": "tm_name"})
    return dim_lookup_join(out, dims[S.DIM_CATEGORY3], "category3_id", {"name": "category3_name"})


def sku_lookups(
    df: DataFrame, dims: dict[str, DataFrame], fields: dict[str, str], hot: dict[str, list] | None = None
) -> DataFrame:
    """Product columns by ``sku_id``, names included.

    The small tables are joined to the product table, so the facts are looked up, and at worst shuffled, once.
    """
    found = ["spu_id", "tm_id", "category3_id"]
    names = {c: c for c in [*found, "spu_name", "tm_name", "category3_name"]}
    out = dim_lookup_join(df, product_dimension(dims), "sku_id", {**fields, **names}, hot=hot)
    return out.withColumns({c: F.col(c).try_cast("bigint") for c in found})


def order_wide_dims(df: DataFrame, dims: dict[str, DataFrame], hot: dict[str, list] | None = None) -> DataFrame:
    """Order lines with user, product and province columns; ``hot`` as in ``dim_lookup_join``."""
    out = dim_lookup_join(df, dims[S.DIM_USER], "user_id", {"gender": "user_gender"}, hot=hot)
    out = sku_lookups(out, dims, {}, hot)
    return dim_lookup_join(
        out, dims[S.DIM_PROVINCE], "province_id",
        {
            "area_code": "province_area_code", "iso_code": "province_iso_code",
            "iso_3166_2": "province_3166_2_code",
        },
        hot=hot,
    )


def product_dims(stats: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Product statistics with product, spu, trademark and category columns."""
    out = sku_lookups(stats, dims, {"sku_name": "sku_name", "price": "sku_price"})
    return out.withColumn("sku_price", F.col("sku_price").try_cast(S.MONEY))


def sql_interval_join(a: DataFrame, b: DataFrame, seconds: int = 20) -> DataFrame:
    """Two behaviour tables on ``user_id`` with ``a.ts`` within ``b.ts ± seconds``.

    Columns of ``a`` keep their names, those of ``b`` get the suffix ``0``. On
    streams declare watermarks on ``ts`` first.
    """
    bound = seconds * 1000
    joined = interval_join(b, a, [("user_id", "user_id")], -bound, bound, rt="ts")
    return joined.select(
        *[F.col(f"r.{c}") for c in a.columns], *[F.col(f"l.{c}").alias(f"{c}0") for c in b.columns]
    )
