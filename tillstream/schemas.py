"""Record schemas and code lists."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_L, _I, _S = T.LongType(), T.IntegerType(), T.StringType()

ADS_CLICK = _schema(user_id=_L, ad_id=_L, province=_S, city=_S, ts=_L)
LOGIN = _schema(user_id=_L, ip=_S, event_type=_S, ts=_L)
ORDER_EVENT = _schema(order_id=_L, event_type=_S, tx_id=_S, ts=_L)
ACCESS_LOG = _schema(id=_S, ts=T.TimestampType(), method=_S, url=_S)
SENSOR = _schema(id=_S, ts=_L, vc=_I)

APP_LOG = _schema(
    common=_schema(mid=_S, vc=_S, ch=_S, ar=_S, is_new=_S),
    start=T.MapType(_S, _S),
    page=_schema(page_id=_S, last_page_id=_S, item=_S, item_type=_S, during_time=_L),
    displays=T.ArrayType(_schema(item=_S, item_type=_S)),
    ts=_L,
)

# The raw change record, and the envelope it is normalised to.
CHANGE_RECORD = _schema(before=T.MapType(_S, _S), after=T.MapType(_S, _S), op=_S)
CHANGE = T.StructType(
    [
        T.StructField("database", _S),
        T.StructField("table", _S),
        T.StructField("data", T.MapType(_S, _S)),
        T.StructField("before-data", T.MapType(_S, _S)),
        T.StructField("type", _S),
    ]
)
ROUTE = _schema(
    source_table=_S, operate_type=_S, sink_type=_S, sink_table=_S,
    sink_columns=_S, sink_pk=_S, sink_extend=_S,
)

ORDER_INFO = _schema(
    id=_L, province_id=_L, order_status=_S, user_id=_L, total_amount=MONEY,
    activity_reduce_amount=MONEY, coupon_reduce_amount=MONEY,
    original_total_amount=MONEY, feight_fee=MONEY, expire_time=_S,
    create_time=_S, operate_time=_S,
)
ORDER_DETAIL = _schema(
    id=_L, order_id=_L, sku_id=_L, order_price=MONEY, sku_num=_L, sku_name=_S,
    create_time=_S, split_total_amount=MONEY, split_activity_amount=MONEY,
    split_coupon_amount=MONEY,
)
PAYMENT_INFO = _schema(
    id=_L, order_id=_L, user_id=_L, total_amount=MONEY, subject=_S,
    payment_type=_S, create_time=_S, callback_time=_S,
)

# Column order of the wide rows and statistics tables: fixed values.
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
    "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "expire_time", "create_time",
    "operate_time", "create_date", "create_hour", "province_name",
    "province_area_code", "province_iso_code", "province_3166_2_code",
    "user_age", "user_gender", "spu_id", "tm_id", "category3_id", "spu_name",
    "tm_name", "category3_name",
]
PAYMENT_WIDE_COLUMNS = [
    "payment_id", "subject", "payment_type", "payment_create_time",
    "callback_time", "detail_id", "order_id", "sku_id", "order_price", "sku_num",
    "sku_name", "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "order_create_time",
    "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code", "user_age", "user_gender", "spu_id", "tm_id",
    "category3_id", "spu_name", "tm_name", "category3_name",
]
VISITOR_STATS_COLUMNS = [
    "stt", "edt", "vc", "ch", "ar", "is_new",
    "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum",
]
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name",
    "tm_id", "tm_name", "category3_id", "category3_name", "click_ct",
    "display_ct", "favor_ct", "cart_ct", "order_sku_num", "order_amount",
    "order_ct", "payment_amount", "paid_order_ct", "refund_order_ct",
    "refund_amount", "comment_ct", "good_comment_ct",
]

# Codes of appraisals: fixed values.
APPRAISE = {"good": "1201", "soso": "1202", "bad": "1203", "auto": "1204"}
