"""Row shapes shared by every layer, and the values that must match the data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)

# ---- fixed values -------------------------------------------------------
# change operations -> record type
CHANGE_TYPES = {"r": "insert", "c": "insert", "u": "update", "d": "delete"}
# rule sink types
SINK_DIMENSION = "hbase"
SINK_TOPIC = "kafka"
# log values
DETAIL_PAGE = "good_detail"
SEARCH_PAGE = "search"
SKU_ITEM = "sku_id"
GOOD_APPRAISE = "1201"
KEYWORD_SOURCE = "search"
# topics
TOPIC_BASE_LOG = "ods_base_log"
TOPIC_BASE_DB = "ods_base_db"
TOPIC_START = "dwd_start_log"
TOPIC_PAGE = "dwd_page_log"
TOPIC_DISPLAY = "dwd_display_log"
TOPIC_ORDER_INFO = "dwd_order_info"
TOPIC_ORDER_DETAIL = "dwd_order_detail"
TOPIC_PAYMENT = "dwd_payment_info"
TOPIC_FAVOR = "dwd_favor_info"
TOPIC_CART = "dwd_cart_info"
TOPIC_REFUND = "dwd_order_refund_info"
TOPIC_COMMENT = "dwd_comment_info"
TOPIC_UNIQUE_VISIT = "dwm_unique_visit"
TOPIC_USER_JUMP = "dwm_user_jump_detail"
TOPIC_ORDER_WIDE = "dwm_order_wide"
TOPIC_PAYMENT_WIDE = "dwm_payment_wide"
# dimension tables
DIM_USER = "DIM_USER_INFO"
DIM_SKU = "DIM_SKU_INFO"
DIM_SPU = "DIM_SPU_INFO"
DIM_TRADEMARK = "DIM_BASE_TRADEMARK"
DIM_CATEGORY3 = "DIM_BASE_CATEGORY3"
DIM_PROVINCE = "DIM_BASE_PROVINCE"
# --------------------------------------------------------------------------

#: Lines of the log that are no JSON objects; the original has no such topic.
TOPIC_UNREADABLE = "dwd_unreadable_log"
#: Lines of any other topic that no job can read, with the topic's name.
TOPIC_UNREADABLE_LINES = "unreadable_lines"


def _strings(names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_TYPES = {"STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(), "MONEY": MONEY}


def _shape(columns: str) -> T.StructType:
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def log_schema(
    common=("mid", "vc", "ch", "ar", "is_new", "area_code"),
    page=("page_id", "last_page_id", "item", "item_type"),
    start=("entry", "loading_time"),
    display=("item", "item_type"),
) -> T.StructType:
    """Schema of one app log record. Pass longer tuples to carry more fields."""
    page_type = _strings(page).add("during_time", T.LongType())
    return T.StructType(
        [
            T.StructField("common", _strings(common)),
            T.StructField("page", page_type),
            T.StructField("start", _strings(start)),
            T.StructField("displays", T.ArrayType(_strings(display))),
            T.StructField("ts", T.LongType()),
        ]
    )


LOG = log_schema()

# ---- fixed values: the shapes of the records ------------------------------
_ENTRIES = T.MapType(T.StringType(), T.StringType())

CHANGE_IN = T.StructType(
    [
        T.StructField("source", _strings(["db", "table"])),
        T.StructField("before", _ENTRIES),
        T.StructField("after", _ENTRIES),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.StringType()),
    ]
)

CHANGE = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("before", _ENTRIES),
        T.StructField("after", _ENTRIES),
        T.StructField("type", T.StringType()),
        T.StructField("ts_ms", T.StringType()),
    ]
)

RULE = _strings(
    ["source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend"]
)

ORDER_INFO = _shape(
    "id BIGINT, consignee STRING, consignee_tel STRING, total_amount MONEY, "
    "order_status STRING, user_id BIGINT, payment_way STRING, delivery_address STRING, "
    "order_comment STRING, out_trade_no STRING, trade_body STRING, create_time BIGINT, "
    "operate_time STRING, expire_time STRING, process_status STRING, tracking_no STRING, "
    "parent_order_id BIGINT, img_url STRING, province_id BIGINT, "
    "activity_reduce_amount MONEY, coupon_reduce_amount MONEY, "
    "original_total_amount MONEY, feight_fee MONEY, "
    "feight_fee_reduce MONEY, refundable_time STRING"
)

ORDER_DETAIL = _shape(
    "id BIGINT, order_id BIGINT, sku_id BIGINT, sku_name STRING, order_price MONEY, "
    "sku_num BIGINT, create_time BIGINT, source_type STRING, source_id BIGINT, "
    "split_activity_amount MONEY, split_coupon_amount MONEY, "
    "split_total_amount MONEY"
)

PAYMENT_INFO = _shape(
    "id BIGINT, out_trade_no STRING, order_id BIGINT, user_id BIGINT, payment_type STRING, "
    "trade_no STRING, total_amount MONEY, subject STRING, payment_status STRING, "
    "create_time BIGINT, callback_time STRING, callback_content STRING"
)

SKU_ACTION = _shape("sku_id BIGINT, create_time BIGINT")

REFUND = _shape(
    "order_id BIGINT, sku_id BIGINT, refund_amount MONEY, create_time BIGINT"
)

COMMENT = _shape("sku_id BIGINT, appraise STRING, create_time BIGINT")

# columns an order line takes from its order, in output order
ORDER_WIDE_FROM_ORDER = [
    f.name for f in ORDER_INFO.fields if f.name not in ("id", "create_time")
]
# columns an order line takes from its detail record (id and order_id are renamed or shared)
ORDER_WIDE_FROM_DETAIL = [
    f.name for f in ORDER_DETAIL.fields if f.name not in ("id", "order_id", "create_time")
]
ORDER_WIDE_DIMS = [
    "province_area_code", "province_iso_code", "province_3166_2_code", "user_gender",
    "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
]

_ORDER_TYPES = {f.name: f.dataType for f in ORDER_INFO.fields + ORDER_DETAIL.fields}
_DIM_TYPES = {"spu_id": T.LongType(), "tm_id": T.LongType(), "category3_id": T.LongType()}
ORDER_WIDE = T.StructType(
    [T.StructField(n, _ORDER_TYPES[n]) for n in ORDER_WIDE_FROM_ORDER]
    + [T.StructField("detail_id", T.LongType()), T.StructField("order_id", T.LongType())]
    + [T.StructField(n, _ORDER_TYPES[n]) for n in ORDER_WIDE_FROM_DETAIL]
    + [T.StructField("create_time", T.LongType())]
    + [T.StructField(n, _DIM_TYPES.get(n, T.StringType())) for n in ORDER_WIDE_DIMS]
)

PAYMENT_WIDE = _shape(
    "payment_id BIGINT, subject STRING, payment_type STRING, payment_create_time BIGINT, "
    "callback_time STRING, detail_id BIGINT, order_id BIGINT, sku_id BIGINT, "
    "order_price MONEY, sku_num BIGINT, sku_name STRING, province_id BIGINT, "
    "order_status STRING, user_id BIGINT, total_amount MONEY, "
    "activity_reduce_amount MONEY, coupon_reduce_amount MONEY, "
    "original_total_amount MONEY, feight_fee MONEY, "
    "split_feight_fee MONEY, split_activity_amount MONEY, "
    "split_coupon_amount MONEY, split_total_amount MONEY, "
    "order_create_time BIGINT, province_name STRING, province_area_code STRING, "
    "province_iso_code STRING, province_3166_2_code STRING, user_age INT, user_gender STRING, "
    "spu_id BIGINT, tm_id BIGINT, category3_id BIGINT, spu_name STRING, tm_name STRING, "
    "category3_name STRING"
)

VISITOR_KEYS = ["ar", "ch", "is_new", "vc"]
VISITOR_MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]

PRODUCT_COUNTS = [
    "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct",
]
PRODUCT_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]

VISITOR_STATS = _shape(
    "stt STRING, edt STRING, vc STRING, ch STRING, ar STRING, is_new STRING, uv_ct BIGINT, "
    "pv_ct BIGINT, sv_ct BIGINT, uj_ct BIGINT, dur_sum BIGINT, ts BIGINT"
)

KEYWORD_STATS = _shape(
    "keyword STRING, ct BIGINT, source STRING, stt STRING, edt STRING, ts BIGINT"
)
# --------------------------------------------------------------------------
