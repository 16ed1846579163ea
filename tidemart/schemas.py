"""Row shapes of the warehouse tables, declared once."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
LONG = T.LongType()
MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# `start` stays raw text: real logs carry an object there.
APP_LOG = struct(
    common=struct(mid=TEXT, uid=TEXT, ar=TEXT, ch=TEXT, vc=TEXT),
    start=TEXT,
    ts=LONG,
)

# `data` stays raw text; its shape depends on the table.
CHANGE_RECORD = struct(table=TEXT, type=TEXT, data=TEXT)

DAU_INFO = struct(
    mid=TEXT, uid=TEXT, ar=TEXT, ch=TEXT, vc=TEXT, dt=TEXT, hr=TEXT, mi=TEXT, ts=LONG
)

ORDER_INFO = struct(
    id=LONG,
    province_id=LONG,
    order_status=TEXT,
    user_id=LONG,
    final_total_amount=MONEY,
    benefit_reduce_amount=MONEY,
    original_total_amount=MONEY,
    feight_fee=MONEY,
    expire_time=TEXT,
    create_time=TEXT,
    operate_time=TEXT,
)

ORDER_DETAIL = struct(
    id=LONG,
    order_id=LONG,
    sku_id=LONG,
    order_price=MONEY,
    sku_num=LONG,
    sku_name=TEXT,
    create_time=TEXT,
)

PROVINCE = struct(id=TEXT, name=TEXT, area_code=TEXT, iso_code=TEXT, iso_3166_2=TEXT)

USER_INFO = struct(id=TEXT, name=TEXT, birthday=TEXT, gender=TEXT)

SKU_INFO = struct(
    id=LONG,
    spu_id=LONG,
    price=MONEY,
    sku_name=TEXT,
    sku_desc=TEXT,
    weight=T.DoubleType(),
    tm_id=LONG,
    category3_id=LONG,
    sku_default_img=TEXT,
    create_time=T.TimestampType(),
)

SPU_INFO = struct(id=TEXT, spu_name=TEXT, tm_id=LONG, category3_id=LONG)

TRADEMARK = struct(tm_id=TEXT, tm_name=TEXT)

CATEGORY3 = struct(id=TEXT, name=TEXT)

USER_STATE = struct(user_id=TEXT, if_consumed=TEXT)

# The wide row: numbers default to zero and text to null when a side is missing.
ORDER_WIDE = struct(
    order_detail_id=LONG,
    order_id=LONG,
    order_status=TEXT,
    create_time=TEXT,
    user_id=LONG,
    sku_id=LONG,
    sku_price=MONEY,
    sku_num=LONG,
    sku_name=TEXT,
    benefit_reduce_amount=MONEY,
    original_total_amount=MONEY,
    feight_fee=MONEY,
    final_total_amount=MONEY,
    final_detail_amount=MONEY,
    if_first_order=TEXT,
    province_name=TEXT,
    province_area_code=TEXT,
    user_age_group=TEXT,
    user_gender=TEXT,
    dt=TEXT,
    spu_id=LONG,
    tm_id=LONG,
    category3_id=LONG,
    spu_name=TEXT,
    tm_name=TEXT,
    category3_name=TEXT,
)

# A record of a topic kept in files; the topic is the folder.
TOPIC_RECORD = struct(key=TEXT, value=TEXT)

FIRST_ORDER_FLAG = struct(id=LONG, user_id=LONG, create_time=TEXT, if_first_order=TEXT)

# The state of the order job: who has ordered, and the order that was the first.
USER_FIRST_ORDER = struct(user_id=TEXT, if_consumed=TEXT, order_id=LONG)
