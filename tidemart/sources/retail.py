"""Business tables of the warehouse, derived from the star-schema input tables.

Each function takes DataFrames, batch or streaming, and only projects: no sort,
no counter and no shuffle is spent on giving rows their ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.money import money
from tidemart.functions.text import json_text, stable_id
from tidemart.functions.times import second_text

# The record types of the two change-capture formats, by order status.
OBJECT_TYPES = {"F": "insert", "O": "update", "P": "delete"}
ARRAY_TYPES = {"F": "INSERT", "O": "UPDATE", "P": "DELETE"}


def app_logs(events: DataFrame) -> DataFrame:
    """One typed log row per event, with its event time as a Spark timestamp."""
    at = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").alias("log_id"),
        F.col("user_id").cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        (F.col("user_id") % 34).cast("string").alias("ar"),
        (F.col("event_id") % 5).cast("string").alias("ch"),
        (F.col("event_id") % 3).cast("string").alias("vc"),
        F.when(F.col("event_type") == "signup", F.col("event_type")).alias("start"),
        F.unix_millis(at).alias("ts"),
        at.alias("event_time"),
    )


def app_log_lines(logs: DataFrame) -> DataFrame:
    """The logs as the JSON text an application sends."""
    common = F.struct("mid", "uid", "ar", "ch", "vc").alias("common")
    return logs.select("log_id", "event_time", json_text(common, "start", "ts").alias("value"))


def purchase_orders(events: DataFrame) -> DataFrame:
    """Orders with a time of day: one order per purchase event."""
    amount = money(F.col("value"))
    at = F.col("ts").cast("timestamp")
    return events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("id"),
        (F.col("user_id") % 25).alias("province_id"),
        F.lit("PAID").alias("order_status"),
        F.col("user_id"),
        amount.alias("final_total_amount"),
        money(F.lit(0)).alias("benefit_reduce_amount"),
        amount.alias("original_total_amount"),
        money(F.lit(0)).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        second_text(at).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
        at.alias("order_ts"),
    )


def orders(orders: DataFrame, customer: DataFrame | None = None) -> DataFrame:
    """Orders that have lines. The province needs the customer table."""
    if customer is None:
        located, province = orders, F.lit(None)
    else:
        home = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        located, province = orders.join(home, "o_custkey", "left"), F.col("c_nationkey")
    amount = money(F.col("o_totalprice"))
    at = F.col("o_orderdate").cast("timestamp")
    return located.select(
        F.col("o_orderkey").alias("id"),
        province.cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        amount.alias("final_total_amount"),
        money(F.lit(0)).alias("benefit_reduce_amount"),
        amount.alias("original_total_amount"),
        money(F.lit(0)).alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        second_text(at).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
        at.alias("order_ts"),
    )


def line_id() -> Column:
    """The id of an order line: whole lines are unique, so their values name them."""
    return stable_id(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        F.col("l_quantity").cast("bigint"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
    )


def order_details(lineitem: DataFrame) -> DataFrame:
    """Order lines; `order_price` is the amount of the line."""
    return lineitem.select(
        line_id().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        money(F.col("l_extendedprice")).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        F.col("l_linenumber").alias("line_no"),
    )


def timed_details(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with an event time: five seconds per line after their order."""
    placed = orders.select(F.col("o_orderkey").alias("order_id"), "o_orderdate")
    offset = F.make_interval(secs=F.col("line_no") * 5)
    return (
        order_details(lineitem)
        .join(placed, "order_id")
        .withColumn("detail_ts", F.col("o_orderdate").cast("timestamp") + offset)
        .drop("o_orderdate")
    )


def provinces(nation: DataFrame, region: DataFrame) -> DataFrame:
    area = region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("area_code"))
    code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    return nation.join(area, "n_regionkey", "left").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        "area_code",
        code.alias("iso_code"),
        F.concat(F.lit("N-"), code).alias("iso_3166_2"),
    )


def _birthday(k: Column) -> Column:
    part = lambda base, size: (base + k % size).cast("int")
    return F.make_date(part(1950, 60), part(1, 12), part(1, 28)).cast("string")


def _gender(k: Column) -> Column:
    return F.when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F"))


def users(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.cast("string").alias("id"),
        F.col("c_name").alias("name"),
        _birthday(key).alias("birthday"),
        _gender(key).alias("gender"),
    )


def skus(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("id"),
        stable_id(F.col("p_name")).alias("spu_id"),
        money(F.col("p_retailprice")).alias("price"),
        F.col("p_name").alias("sku_name"),
        F.lit(None).cast("string").alias("sku_desc"),
        F.col("p_size").cast("double").alias("weight"),
        stable_id(F.col("p_brand")).alias("tm_id"),
        stable_id(F.col("p_type")).alias("category3_id"),
        F.lit(None).cast("string").alias("sku_default_img"),
        F.lit(None).cast("timestamp").alias("create_time"),
    )


def spus(part: DataFrame) -> DataFrame:
    """One row per product name; brand and type are those of its lowest part key."""
    first = F.min(F.struct("p_partkey", "p_brand", "p_type")).alias("first")
    return part.groupBy("p_name").agg(first).select(
        stable_id(F.col("p_name")).cast("string").alias("id"),
        F.col("p_name").alias("spu_name"),
        stable_id(F.col("first.p_brand")).alias("tm_id"),
        stable_id(F.col("first.p_type")).alias("category3_id"),
    )


def trademarks(part: DataFrame) -> DataFrame:
    return part.select("p_brand").distinct().select(
        stable_id(F.col("p_brand")).cast("string").alias("tm_id"),
        F.col("p_brand").alias("tm_name"),
    )


def categories(part: DataFrame) -> DataFrame:
    return part.select("p_type").distinct().select(
        stable_id(F.col("p_type")).cast("string").alias("id"),
        F.col("p_type").alias("name"),
    )


def _by_status(status: Column, names: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.create_map(*pairs)[status]


def order_json(status: Column | None = None) -> Column:
    """An order row as the change capture writes it."""
    return json_text(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_orderstatus") if status is None else status).alias("order_status"),
        money(F.col("o_totalprice")).alias("final_total_amount"),
        second_text(F.col("o_orderdate").cast("timestamp")).alias("create_time"),
    )


def object_change_records(
    orders: DataFrame, nation: DataFrame, customer: DataFrame
) -> DataFrame:
    """Change records with one object as payload: orders, provinces, users, and
    one table (`cart_info`) that no rule lets through."""
    order_rows = orders.select(
        F.lit("order_info").alias("table"),
        _by_status(F.col("o_orderstatus"), OBJECT_TYPES).alias("type"),
        order_json().alias("data"),
    )
    province_rows = nation.select(
        F.lit("base_province").alias("table"),
        F.lit("delete").alias("type"),
        json_text(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")).alias("data"),
    )
    user_rows = customer.select(
        F.when(F.col("c_custkey") % 10 == 0, "cart_info").otherwise("user_info").alias("table"),
        F.lit("update").alias("type"),
        F.when(F.col("c_custkey") % 7 == 0, "{}")
        .otherwise(json_text(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")))
        .alias("data"),
    )
    return order_rows.unionByName(province_rows).unionByName(user_rows)


def array_change_records(orders: DataFrame) -> DataFrame:
    """Change records with an array as payload: the order, then the order as shipped."""
    first, second = order_json(), order_json(F.lit("S"))
    return orders.select(
        F.lit("order_info").alias("table"),
        _by_status(F.col("o_orderstatus"), ARRAY_TYPES).alias("type"),
        F.concat(F.lit("["), first, F.lit(","), second, F.lit("]")).alias("data"),
    )


def change_lines(records: DataFrame) -> DataFrame:
    """Change records as the JSON text the capture sends."""
    quoted = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    parts = ['{"table":', quoted("table"), ',"type":', quoted("type"), ',"ts":0,"data":', F.col("data"), "}"]
    return records.select(
        F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("value")
    )
