"""The warehouse's input shapes, derived from plain order, event and text tables.

Every view reads whole tables under a folder of ``<name>.parquet`` files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import schemas as S

TEXT_DAY_MS = 1_704_067_200_000  # 2024-01-01, the time of document 0


# stated, so that opening a table needs no job to read file footers
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
        "o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "benchmark": "item_id BIGINT, text STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _ms(c: str) -> Column:
    return F.unix_millis(F.col(c).cast("timestamp"))


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(16,2)")


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _quoted(c) -> Column:
    return F.concat(F.lit('"'), c if isinstance(c, Column) else F.col(c), F.lit('"'))


def _json(**parts: Column) -> Column:
    """JSON object text from parts that are JSON text already."""
    out = [F.lit("{")]
    for i, (name, part) in enumerate(parts.items()):
        out += [F.lit(f'{"," if i else ""}"{name}":'), part]
    return F.concat(*out, F.lit("}"))


def _fit(df: DataFrame, schema, **columns) -> DataFrame:
    """Columns of a schema; those not given are null."""
    return df.select(
        [columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _k() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0).cast("bigint")


def base_log(spark: SparkSession, folder: str) -> DataFrame:
    """App log: error events open the app, all others are pages."""
    e = table(spark, folder, "events").select("user_id", "event_type", "value", _ms("ts").alias("ts"), _k().alias("k"))
    kind, user = F.col("event_type"), F.col("user_id")
    start = kind == "error"
    common = F.struct(
        F.concat(F.lit("mid_"), _text("user_id")).alias("mid"),
        _text(user % 3).alias("vc"), _text(user % 5).alias("ch"), _text(user % 34).alias("ar"),
        F.when(kind == "signup", "1").otherwise("0").alias("is_new"), _text(user % 7).alias("area_code"),
    )
    page = F.struct(
        F.when(kind == "purchase", S.DETAIL_PAGE).otherwise(kind).alias("page_id"),
        F.when(kind == "click", S.SEARCH_PAGE).when(kind != "view", "home").alias("last_page_id"),
        _text(F.col("k") + 1).alias("item"), F.lit(S.SKU_ITEM).alias("item_type"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("during_time"),
    )
    displays = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < F.col("k") % 4),
        lambda i: F.struct(
            _text(F.col("k") + 1 + i).alias("item"),
            F.when(i % 2 == 0, S.SKU_ITEM).otherwise("activity_id").alias("item_type"),
        ),
    )
    return e.select(
        common.alias("common"),
        F.when(~start, page).alias("page"),
        F.when(start, F.struct(F.lit("icon").alias("entry"), _text("k").alias("loading_time"))).alias("start"),
        F.when(~start, displays).alias("displays"),
        "ts",
    )


def raw_log(spark: SparkSession, folder: str) -> DataFrame:
    """The app log as lines of text, with more fields than ``schemas.LOG`` has, and some lines that are cut off."""
    log = base_log(spark, folder)
    user = F.regexp_extract("common.mid", "[0-9]+", 0)
    displays = F.transform("displays", lambda d: d.withField("pos_id", F.length(d["item"])))
    line = F.to_json(F.struct(
        F.col("common").withField("uid", user).alias("common"),
        F.col("page").withField("source_type", F.concat(F.lit("from "), F.col("page.page_id"))).alias("page"), "start",
        displays.alias("displays"), F.array(F.struct((F.col("ts") % 1000).alias("n"))).alias("actions"),
        F.when(F.col("ts") % 5 == 0, F.struct((F.col("ts") % 7).alias("code"))).alias("err"), "ts",
    ))
    return log.select(F.when(F.col("ts") % 97 == 0, F.concat(F.lit('{"cut":'), _text("ts"))).otherwise(line).alias("value"))


def odd_log(spark: SparkSession, folder: str) -> DataFrame:
    """Page lines whose displays are, besides one good one, a text, a number, a null and an array."""
    pages = page_log(spark, folder)
    shown = F.concat(F.lit('["a",7,null,{"item":"'), F.col("page.item"), F.lit('"},[1]]'))
    line = _json(
        common=F.to_json("common"), page=F.to_json("page"), displays=shown, ts=_text("ts"),
    )
    return pages.select(line.alias("value"))


def with_cut_lines(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """JSON lines, and among them a line that breaks off for every key."""
    cut = keys.toDF("_key").select(F.concat(F.lit('{"cut":'), _text("_key")).alias("value"))
    return rows.select("value").unionAll(cut)


def page_log(spark: SparkSession, folder: str) -> DataFrame:
    return base_log(spark, folder).filter(F.col("start").isNull()).drop("start")


def search_log(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as search result pages; a document's text is what was searched."""
    d = table(spark, folder, "documents")
    none = F.lit(None).cast("string")
    return d.select(
        F.struct(F.concat(F.lit("mid_"), _text("doc_id")).alias("mid")).alias("common"),
        F.struct(
            F.lit("good_list").alias("page_id"), F.lit(S.SEARCH_PAGE).alias("last_page_id"),
            F.col("text").alias("item"), none.alias("item_type"),
        ).alias("page"),
        (F.lit(TEXT_DAY_MS) + F.col("doc_id") * 1000).alias("ts"),
    )


def sku_actions(spark: SparkSession, folder: str, event_type: str) -> DataFrame:
    e = table(spark, folder, "events").filter(F.col("event_type") == event_type)
    return _fit(e, S.SKU_ACTION, sku_id=_k() + 1, create_time=_ms("ts"))


def favor_info(spark, folder):
    return sku_actions(spark, folder, "click")


def cart_info(spark, folder):
    return sku_actions(spark, folder, "purchase")


def comment_info(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").filter(F.col("event_type") == "signup")
    good = F.when(_k() % 3 == 0, S.GOOD_APPRAISE).otherwise("1204")
    return _fit(e, S.COMMENT, sku_id=_k() + 1, appraise=good, create_time=_ms("ts"))


def _order_ms() -> Column:
    return _ms("o_orderdate") + (F.col("o_orderkey") % 86400) * 1000


def order_info(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return _fit(
        joined, S.ORDER_INFO,
        id=F.col("o_orderkey"), consignee=F.col("c_name"), total_amount=_money("o_totalprice"),
        order_status=F.col("o_orderstatus"), user_id=F.col("o_custkey"), payment_way=F.col("o_orderpriority"),
        create_time=_order_ms(), province_id=F.col("c_nationkey"), original_total_amount=_money("o_totalprice"),
    )


def order_detail(spark: SparkSession, folder: str) -> DataFrame:
    return _fit(
        table(spark, folder, "lineitem"), S.ORDER_DETAIL,
        id=F.col("l_orderkey") * 10 + F.col("l_linenumber"), order_id=F.col("l_orderkey"),
        sku_id=F.col("l_partkey"), order_price=_money("l_extendedprice"), sku_num=F.col("l_quantity"),
        create_time=_ms("l_shipdate"), source_type=F.col("l_returnflag"), source_id=F.col("l_suppkey"),
        split_activity_amount=_money("l_discount"), split_coupon_amount=_money("l_tax"),
        split_total_amount=_money("l_extendedprice"),
    )


def payment_info(spark: SparkSession, folder: str) -> DataFrame:
    paid = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F")
    return _fit(
        paid, S.PAYMENT_INFO,
        id=F.col("o_orderkey") + 1_000_000, order_id=F.col("o_orderkey"), user_id=F.col("o_custkey"),
        payment_type=F.col("o_orderpriority"), total_amount=_money("o_totalprice"),
        subject=F.concat(F.lit("order "), _text("o_orderkey")), payment_status=F.lit("paid"),
        create_time=_order_ms() + (F.col("o_orderkey") % 1200) * 1000,
    )


def refund_info(spark: SparkSession, folder: str) -> DataFrame:
    back = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    return _fit(
        back, S.REFUND, order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
        refund_amount=_money("l_extendedprice"), create_time=_ms("l_shipdate"),
    )


def _spu_id() -> Column:
    return F.conv(F.substring(F.md5(F.col("p_name").cast("binary")), 1, 12), 16, 10)


def _category_id() -> Column:
    return _text(F.ascii("p_type") * 100 + F.length("p_type"))


def dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six dimensions, all columns text. Every tenth user and product is missing on purpose."""
    part, nation = table(spark, folder, "part"), table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    brand = F.regexp_extract("p_brand", "[0-9]+", 0)
    return {
        S.DIM_USER: customer.filter("c_custkey % 10 <> 0").select(
            _text("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender")
        ),
        S.DIM_SKU: part.filter("p_partkey % 10 <> 0").select(
            _text("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
            _text(_money("p_retailprice")).alias("price"), _spu_id().alias("spu_id"),
            brand.alias("tm_id"), _category_id().alias("category3_id"),
        ),
        S.DIM_SPU: part.select(_spu_id().alias("id"), F.col("p_name").alias("spu_name")).distinct(),
        S.DIM_TRADEMARK: part.select(brand.alias("id"), F.col("p_brand").alias("tm_name")).distinct(),
        S.DIM_CATEGORY3: part.select(_category_id().alias("id"), F.col("p_type").alias("name")).distinct(),
        S.DIM_PROVINCE: nation.select(
            _text("n_nationkey").alias("id"), _text("n_regionkey").alias("area_code"),
            F.col("n_name").alias("iso_code"), F.concat(F.lit("N-"), _text("n_nationkey")).alias("iso_3166_2"),
        ),
    }


def change_records(spark: SparkSession, folder: str) -> DataFrame:
    """Change JSON over ten order tables: all orders made, some updated, some deleted.

    An update names no ``status``; its note is null for even orders.
    """
    o = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", _ms("o_orderdate").alias("ms"),
        F.explode(
            F.concat(
                F.array(F.lit("c")),
                F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("u"))).otherwise(F.array().cast("array<string>")),
                F.when(F.col("o_orderkey") % 11 == 0, F.array(F.lit("d"))).otherwise(F.array().cast("array<string>")),
                F.when(F.col("o_orderkey") % 13 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")),
            )
        ).alias("op"),
    )
    key, user = _text("o_orderkey"), _text("o_custkey")
    made = _json(id=key, user=user, status=_quoted("o_orderstatus"), note=_quoted("o_orderpriority"))
    note = F.when(F.col("o_orderkey") % 2 == 0, "null").otherwise('"changed"')
    updated = _json(id=key, user=user, note=note)
    after = F.when(F.col("op") == "u", updated).when(F.col("op") == "d", "null").otherwise(made)
    before = F.when(F.col("op") == "c", "null").otherwise(made)
    step = F.when(F.col("op") == "c", 0).when(F.col("op") == "u", 1).otherwise(2)
    name = F.concat(F.lit("table_"), _text(F.col("o_custkey") % 10))
    source = _json(db=F.lit('"shop"'), table=_quoted(name))
    value = _json(source=source, before=before, after=after, op=_quoted("op"), ts_ms=_quoted(_text(F.col("ms") + step)))
    return o.select(value.alias("value"))


def rule_records(spark: SparkSession, folder: str) -> DataFrame:
    """Change JSON of a rules table, several per source table and operation."""
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("n"))
    sink = F.when(F.col("k") % 5 == 0, "other").when(F.col("k") % 2 == 0, S.SINK_DIMENSION).otherwise(S.SINK_TOPIC)
    columns = F.when(F.col("k") % 3 == 0, "id,user,note").otherwise("id,status,note, user")
    rule = _json(
        source_table=_quoted(F.concat(F.lit("table_"), _text(F.col("n") % 8))),
        operate_type=_quoted(F.when(F.col("k") % 4 < 2, "insert").otherwise("update")),
        sink_type=_quoted(sink), sink_table=_quoted(F.concat(F.lit("sink_"), _text("k"))),
        sink_columns=_quoted(columns), sink_pk=F.lit("null"), sink_extend=F.lit("null"),
    )
    gone = F.col("k") % 17 == 0
    op = F.when(gone, "d").when(F.col("k") % 7 == 0, "c").otherwise("r")
    value = _json(
        source=_json(db=F.lit('"config"'), table=F.lit('"table_process"')),
        before=F.when(gone, rule).otherwise("null"), after=F.when(gone, "null").otherwise(rule),
        op=_quoted(op), ts_ms=_quoted(_text(F.col("k") + TEXT_DAY_MS)),
    )
    return s.select(value.alias("value"))


def csv_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as ``key,epoch_ms`` text."""
    e = table(spark, folder, "events")
    return e.select(F.concat_ws(",", "event_type", _text(_ms("ts"))).alias("value"))


def behaviours(spark: SparkSession, folder: str, event_type: str) -> DataFrame:
    e = table(spark, folder, "events").filter(F.col("event_type") == event_type)
    return e.select(
        "user_id", (_k() + 1).alias("item_id"), F.col("event_type").alias("behavior"),
        F.timestamp_millis(_ms("ts")).alias("ts"),
    )


def near_orders(details: DataFrame, orders: DataFrame, apart_ms: tuple[int, ...]) -> DataFrame:
    """Order lines whose time is that of their order plus one of some distances, by id."""
    apart = F.element_at(F.array(*[F.lit(x) for x in apart_ms]), (F.col("id") % len(apart_ms) + 1).cast("int"))
    of = orders.select(F.col("id").alias("order_id"), F.col("create_time").alias("_time"))
    moved = details.drop("create_time").join(of, "order_id").withColumn("create_time", F.col("_time") + apart)
    return moved.select(details.columns)


def shifted(rows: DataFrame, apart_ms: tuple[int, ...]) -> DataFrame:
    """Behaviours moved in time by one of some distances, by the item."""
    apart = F.element_at(F.array(*[F.lit(x) for x in apart_ms]), (F.col("item_id") % len(apart_ms) + 1).cast("int"))
    return rows.withColumn("ts", F.timestamp_millis(F.unix_millis("ts") + apart))


# ---- fixed values: a Han character for each letter
LATIN = "abcdefghijklmnopqrstuvwxyz"
HAN = "的一是在不了有和人这中大为上个国我以要他时来用们生到"
# ---------------------------------------------------


def han_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """Texts with their Latin letters written as Han characters."""
    return df.withColumn(text, F.translate(F.lower(text), LATIN, HAN))
