"""One named query per operator, over the input tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from tidemart import schemas
from tidemart.functions.money import money
from tidemart.functions.text import json_text, mask_cols, parse_json, stable_id, to_json_rows
from tidemart.functions.times import age_group, order_time_parts, second_text
from tidemart.operators import devices, first_order, metrics, routing, search, wide
from tidemart.operators.dimensions import enrich_province, upsert_latest
from tidemart.operators.pages import ranged_page, store_ranges
from tidemart.plans.warehouse import Warehouse, with_user
from tidemart.session import backlog_session, state_session, tune, work_dir
from tidemart.sources import offsets, retail, sinks
from tidemart.sources.keyed import KeyedTable
from tidemart.sources.rollup import RollUp
from tidemart.sources.tables import read_day, sql_to_json_rows, stored_bytes, stream_table
from tidemart.sources.topics import topic_source
from tidemart.streaming import devices as device_streams
from tidemart.streaming import orders as order_streams
from tidemart.streaming.dedupe import dedupe_renewed, dedupe_stream
from tidemart.streaming.jobs import each_batch, each_parsed, run_available, start, table_writer
from tidemart.streaming.late import split_late
from tidemart.streaming.shares import split_amount_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a query under its function's name, without a trailing underscore."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Warehouse(tune(spark, input_bytes=stored_bytes(spark, folder)), folder))

    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


# Devices ------------------------------------------------------------------------


@query
def dau_info(w: Warehouse) -> DataFrame:
    return devices.dau_info(w.logs())


@query
def dau_first_log(w: Warehouse) -> DataFrame:
    return devices.first_log_per_day(w.logs())


@query
def dau_total(w: Warehouse) -> DataFrame:
    return devices.dau_total(devices.device_days(w.logs()))


@query
def dau_hour_count(w: Warehouse) -> DataFrame:
    return devices.dau_hour_count(devices.device_days(w.logs()))


@query
def new_mid_total(w: Warehouse) -> DataFrame:
    return devices.new_mid_total(devices.device_days(w.logs()))


def _dau_hours(w: Warehouse) -> DataFrame:
    return devices.dau_hour_count(devices.device_days(w.logs()))


@query
def dau_hour_compare(w: Warehouse) -> DataFrame:
    return metrics.hour_compare(_dau_hours(w), "n")


@query
def hour_axis_zero_fill(w: Warehouse) -> DataFrame:
    filled = metrics.hour_compare(metrics.order_hour_amount(w.purchase_wide()), "order_amount")
    return filled.select("dt", "hr", F.col("today").alias("order_amount"))


@query
def hour_map(w: Warehouse) -> DataFrame:
    maps = metrics.hour_map(_dau_hours(w), "n")
    pairs = F.transform(
        F.map_entries("hours"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return maps.select("dt", F.array_join(pairs, ",").alias("hours"))


@query
def sliding_window_counts(w: Warehouse) -> DataFrame:
    counts = metrics.sliding_counts(w.logs(), "event_time")
    return counts.select(
        second_text(F.col("window_start")).alias("window_start"),
        second_text(F.col("window_end")).alias("window_end"),
        "n",
    )


# Orders and the wide row ----------------------------------------------------------


@query
def order_time_parts_(w: Warehouse) -> DataFrame:
    return order_time_parts(w.purchases()).select("id", "create_time", "create_date", "create_hour")



@query
def first_order_flag(w: Warehouse) -> DataFrame:
    flagged = first_order.first_order_flag(w.purchases())
    return flagged.select("id", "user_id", "create_time", "if_first_order")


@query
def user_state(w: Warehouse) -> DataFrame:
    return first_order.user_state(w.orders())


@query
def orders_with_state(w: Warehouse) -> DataFrame:
    """All orders against the state left by finished ones."""
    finished = w.orders().where(F.col("order_status") == "F")
    joined = first_order.with_user_state(w.orders(), first_order.user_state(finished))
    return joined.select("id", "user_id", "if_consumed")


@query
def order_wide(w: Warehouse) -> DataFrame:
    return w.order_wide()


@query
def order_wide_defaults(w: Warehouse) -> DataFrame:
    return wide.widen(order_time_parts(w.orders()), w.details(), how="full")


@query
def detail_amount_split(w: Warehouse) -> DataFrame:
    return w.amounts().select(
        "order_id", "order_detail_id", "sku_price", "final_total_amount", "final_detail_amount"
    )


@query
def orders_without_detail(w: Warehouse) -> DataFrame:
    return wide.orders_without_detail(w.orders(), w.details()).select("id", "user_id", "final_total_amount")


@query
def details_per_order(w: Warehouse) -> DataFrame:
    lines = wide.collect_details(w.details(), ["id", "sku_id", "sku_num"])
    return lines.groupBy("order_id").agg(
        F.count("*").alias("n_details"), F.sum("detail.sku_num").alias("sku_num")
    )


@query
def enrich_order_province(w: Warehouse) -> DataFrame:
    rich = enrich_province(w.orders(located=True), w.provinces())
    return rich.select("id", "province_id", "province_name", "province_area_code", "province_iso_3166_2")


@query
def enrich_order_user(w: Warehouse) -> DataFrame:
    rich = with_user(order_time_parts(w.orders()), w.users())
    return rich.select("id", "user_id", "create_date", "user_gender", "user_age_group")


@query
def enrich_detail_sku(w: Warehouse) -> DataFrame:
    return w.with_sku(w.details()).drop("line_no", "order_price", "sku_num")


# Dashboard -----------------------------------------------------------------------


@query
def order_total_amount(w: Warehouse) -> DataFrame:
    return metrics.order_total_amount(w.order_totals())


@query
def order_hour_amount(w: Warehouse) -> DataFrame:
    return metrics.order_hour_amount(w.purchase_wide())


@query
def order_hour_compare(w: Warehouse) -> DataFrame:
    hourly = metrics.order_hour_amount(w.purchase_wide())
    return metrics.hour_compare(hourly, "order_amount")


@query
def realtime_total(w: Warehouse) -> DataFrame:
    return metrics.realtime_total(devices.device_days(w.logs()), w.purchase_wide())


def _buyers(w: Warehouse) -> DataFrame:
    """The distinct users who ordered, by gender and by age on their last order's day."""
    last = order_time_parts(w.orders()).groupBy("user_id").agg(F.max("create_date").alias("create_date"))
    return with_user(last, w.users())


@query
def gender_ratio(w: Warehouse) -> DataFrame:
    return metrics.share_by(_buyers(w), "user_gender")


@query
def age_ratio(w: Warehouse) -> DataFrame:
    return metrics.share_by(_buyers(w), "user_age_group")


def _province_sales(w: Warehouse) -> DataFrame:
    located = enrich_province(w.orders(located=True), w.provinces())
    return metrics.sales_by(located, "province_name", "final_total_amount")


@query
def province_sales(w: Warehouse) -> DataFrame:
    return _province_sales(w)


@query
def province_sales_bins(w: Warehouse) -> DataFrame:
    """Provinces per bin of 100 orders."""
    return metrics.bin_sales(_province_sales(w), "n")


@query
def sales_by_name(w: Warehouse) -> DataFrame:
    return metrics.sales_by(w.with_sku(w.details()), "sku_name", "sku_num")


@query
def search_page(w: Warehouse) -> DataFrame:
    """The cheapest skus from a price on, with a keyword that only marks."""
    page = search.search_page(
        retail.skus(w.table("part")),
        filters=F.col("price") >= 905,
        keyword="ring",
        keyword_col="sku_name",
        order_by=("price", "id"),
        limit=20,
    )
    return page.select("id", "price", "sku_name", "highlighted", "matched", "total")


@query
def sale_detail_page(w: Warehouse) -> DataFrame:
    lines = wide.widen(order_time_parts(w.orders()), w.with_sku(w.details()))
    page = search.sale_detail_page(lines, None, "ring", offset=20, limit=20)
    return page.select("dt", "order_id", "order_detail_id", "sku_name", "highlighted", "total")


# Users -----------------------------------------------------------------------------


@query
def masked_users(w: Warehouse) -> DataFrame:
    return mask_cols(w.users(), ["name", "birthday"])


@query
def user_age_group(w: Warehouse) -> DataFrame:
    return age_group(w.users(), "birthday", "2001-08-01").select("id", "birthday", "age_group")


# JSON, routing, topics ----------------------------------------------------------------


@query
def parse_orders(w: Warehouse) -> DataFrame:
    lines = w.table("orders").select(retail.order_json().alias("value"))
    good, _ = parse_json(lines, schemas.ORDER_INFO)
    return good.select("id", "province_id", "user_id", "order_status", "final_total_amount", "create_time")


@query
def parse_app_log(w: Warehouse) -> DataFrame:
    good, _ = parse_json(retail.app_log_lines(w.logs()), schemas.APP_LOG)
    return good.select("common.*", "start", "ts")


@query
def orders_to_json(w: Warehouse) -> DataFrame:
    return to_json_rows(w.purchases(), ["id", "user_id", "final_total_amount", "expire_time", "create_time"])


@query
def route_app_log(w: Warehouse) -> DataFrame:
    return routing.route_app_log(retail.app_log_lines(w.logs()))


def _object_routes(w: Warehouse) -> DataFrame:
    records = retail.object_change_records(w.table("orders"), w.table("nation"), w.table("customer"))
    return routing.route_cdc(routing.change_records(retail.change_lines(records)), "object")


@query
def route_cdc_object(w: Warehouse) -> DataFrame:
    return _object_routes(w)


@query
def route_cdc_array(w: Warehouse) -> DataFrame:
    lines = retail.change_lines(retail.array_change_records(w.table("orders")))
    return routing.route_cdc(routing.change_records(lines), "array")


@query
def topic_sink(w: Warehouse) -> DataFrame:
    path = work_dir(w.spark, "topics")
    sinks.topic_sink(sinks.topic_rows(_object_routes(w), "topic"), path)
    return w.spark.read.parquet(path).select("topic", "value")


@query
def topic_sink_keyed(w: Warehouse) -> DataFrame:
    """Flagged orders to a topic, keyed by order id."""
    path = work_dir(w.spark, "topics")
    flagged = first_order.first_order_flag(w.purchases())
    fields = ("id", "user_id", "create_time", "if_first_order")
    rows = sinks.topic_rows(flagged, F.lit("DWD_ORDER_INFO"), json_text(*fields), "id")
    sinks.topic_sink(rows, path)
    return w.spark.read.parquet(path).select("topic", "key", "value")


@query
def topic_source_(w: Warehouse) -> DataFrame:
    """Log lines through both log topics and a stream that reads the start topic."""
    spark = state_session(w.spark)
    path, out = work_dir(spark, "topics"), work_dir(spark, "out")
    routed = routing.route_app_log(retail.app_log_lines(w.logs()))
    sinks.topic_sink(sinks.topic_rows(routed, "topic"), path)
    source = topic_source(spark, routing.START_TOPIC, path=path)
    run_available(table_writer(source, out), work_dir(spark, "checkpoint"))
    good, _ = parse_json(w.spark.read.parquet(out), schemas.APP_LOG)
    return good.select("common.mid", "start", "ts")



@query
def sql_to_json_rows_(w: Warehouse) -> DataFrame:
    w.table("customer").createOrReplaceTempView("tidemart_customer")
    return sql_to_json_rows(
        w.spark,
        "SELECT c_custkey, c_name, nullif(c_mktsegment, 'MACHINERY') AS segment FROM tidemart_customer",
    )



# Dimension upserts -------------------------------------------------------------------


def _kind(col: str) -> F.Column:
    return (
        F.when(F.col(col) % 3 == 0, "insert").when(F.col(col) % 3 == 1, "update").otherwise("delete")
    ).alias("type")


@query
def dim_upsert_base_province(w: Warehouse) -> DataFrame:
    """Each customer is one change of their province's name."""
    changes = w.table("customer").select(
        F.col("c_nationkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.lit("area").alias("area_code"),
        F.lit("iso").alias("iso_code"),
        F.lit("iso2").alias("iso_3166_2"),
        F.col("c_custkey").alias("version"),
        _kind("c_custkey"),
    )
    return upsert_latest(w.provinces(), changes, ["id"], ["version"])


@query
def dim_upsert_user_info(w: Warehouse) -> DataFrame:
    """Each order is one change of its user, as JSON of the user topic."""
    value = json_text(
        F.col("o_custkey").cast("string").alias("id"),
        F.concat(F.lit("user of order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderstatus").alias("gender"),
        second_text(F.col("o_orderdate").cast("timestamp")).alias("changed"),
        F.col("o_orderkey").alias("version"),
    )
    lines = w.table("orders").select(value.alias("value"))
    record = StructType(
        [*schemas.USER_INFO.fields, *schemas.struct(changed=schemas.TEXT, version=schemas.LONG).fields]
    )
    changes, _ = parse_json(lines, record)
    return upsert_latest(w.users(), changes, ["id"], ["changed", "version"])


@query
def dim_upsert_sku_info(w: Warehouse) -> DataFrame:
    """Each order line is one price change of its sku, newest ship date first."""
    snapshot = retail.skus(w.table("part")).select("id", "sku_name", "price", "weight")
    changes = w.table("lineitem").select(
        F.col("l_partkey").alias("id"),
        F.lit(None).cast("string").alias("sku_name"),
        money(F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").alias("weight"),
        F.unix_date(F.to_date("l_shipdate")).alias("shipped"),
        retail.line_id().alias("version"),
    )
    return upsert_latest(snapshot, changes, ["id"], ["shipped", "version"])


@query
def dim_upsert_spu_info(w: Warehouse) -> DataFrame:
    part = w.table("part")
    changes = part.select(
        stable_id(F.col("p_name")).cast("string").alias("id"),
        F.upper("p_name").alias("spu_name"),
        stable_id(F.col("p_brand")).alias("tm_id"),
        stable_id(F.col("p_type")).alias("category3_id"),
        F.col("p_partkey").alias("version"),
    )
    return upsert_latest(retail.spus(part), changes, ["id"], ["version"])


@query
def dim_upsert_base_trademark(w: Warehouse) -> DataFrame:
    """Deletes are rows like any other: the newest change wins whatever its type."""
    part = w.table("part")
    changes = part.select(
        stable_id(F.col("p_brand")).cast("string").alias("tm_id"),
        F.concat_ws("/", "p_brand", "p_name").alias("tm_name"),
        F.col("p_partkey").alias("version"),
        _kind("p_partkey"),
    )
    return upsert_latest(retail.trademarks(part), changes, ["tm_id"], ["version"])


@query
def dim_upsert_base_category3(w: Warehouse) -> DataFrame:
    """Here a newest change of type delete removes the row."""
    part = w.table("part")
    changes = part.select(
        stable_id(F.col("p_type")).cast("string").alias("id"),
        F.concat_ws("/", "p_type", "p_name").alias("name"),
        F.col("p_partkey").alias("version"),
        _kind("p_partkey"),
    )
    return upsert_latest(retail.categories(part), changes, ["id"], ["version"], deletes="remove")


# Tables kept by id ---------------------------------------------------------------------


def _two_batches(rows: DataFrame, by: Column) -> list[tuple[int, DataFrame]]:
    """The rows in two parts that share their days, and the second part once more."""
    parts = [rows.where(F.pmod(by, F.lit(2)) == k) for k in (0, 1)]
    return [(0, parts[0]), (1, parts[1]), (1, parts[1])]


@query
def daily_index_dau(w: Warehouse) -> DataFrame:
    """Every day is saved in two batches, the second one twice."""
    path = work_dir(w.spark, "dau")
    for batch, rows in _two_batches(devices.dau_info(w.logs()), F.col("ts")):
        sinks.save_by_id(rows, path, ["mid"], oldest=["ts"], batch_id=batch)
    return sinks.read_grown(w.spark, path, ["dt", "mid"], oldest=["ts"])


@query
def daily_index_orders(w: Warehouse) -> DataFrame:
    """Every day is saved in two batches, the second one twice."""
    path = work_dir(w.spark, "orders")
    flagged = order_time_parts(first_order.first_order_flag(w.purchases()))
    rows = flagged.select(
        "id", "user_id", "final_total_amount", "if_first_order", F.col("create_date").alias("dt")
    )
    for batch, part in _two_batches(rows, F.col("id")):
        sinks.save_by_id(part, path, ["id"], batch_id=batch)
    return sinks.read_grown(w.spark, path, ["dt", "id"])


@query
def replay_idempotent(w: Warehouse) -> DataFrame:
    """The same batch saved twice under its batch id leaves every row once."""
    path = work_dir(w.spark, "replay")
    rows = devices.dau_info(w.logs())
    for _ in range(2):
        sinks.append_batch(rows, 0, path)
    grown = _read_days(w.spark, path)
    return grown.groupBy("dt").agg(F.count("*").alias("n"), F.sum("ts").alias("ts_sum"))


@query
def raw_log_archive(w: Warehouse) -> DataFrame:
    """Every day is archived in two batches, the second one twice."""
    path = work_dir(w.spark, "archive")
    lines = retail.app_log_lines(w.logs()).withColumn("dt", F.to_date("event_time").cast("string"))
    for batch, part in _two_batches(lines, F.xxhash64("value")):
        sinks.archive_lines(part, path, batch_id=batch)
    return w.spark.read.schema("value string, dt string, batch_id bigint").text(path).drop("batch_id")


@query
def order_wide_store(w: Warehouse) -> DataFrame:
    """Wide rows stored by day and read back for the amount queries."""
    path = work_dir(w.spark, "wide")
    sinks.store_order_wide(w.amounts(), path)
    stored = _read_days(w.spark, path)
    return stored.groupBy("dt").agg(
        F.count("*").alias("n"),
        F.sum("final_detail_amount").cast(schemas.MONEY_SUM).alias("final_detail_amount"),
    )


def _read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("dt", F.col("dt").cast("string"))


# Streams -------------------------------------------------------------------------------


@query
def dau_stream(w: Warehouse) -> DataFrame:
    spark = state_session(w.spark)
    path = work_dir(spark, "dau")
    logs = retail.app_logs(stream_table(spark, w.folder, "events"))
    firsts = device_streams.dau_stream(logs)
    writer = each_batch(firsts, device_streams.save_dau(path), "update")
    run_available(writer, work_dir(spark, "checkpoint"))
    return sinks.read_grown(w.spark, path, device_streams.DAU_KEYS, oldest=["ts"])


@query
def dau_stream_dedupe(w: Warehouse) -> DataFrame:
    spark = state_session(w.spark)
    path = work_dir(spark, "dau")
    logs = retail.app_logs(stream_table(spark, w.folder, "events"))
    firsts = device_streams.first_log_dedupe(logs)
    run_available(table_writer(firsts, path), work_dir(spark, "checkpoint"))
    return w.spark.read.parquet(path).select("dt", "mid")


@query
def first_order_stream(w: Warehouse) -> DataFrame:
    spark = state_session(w.spark)
    path = work_dir(spark, "flags")
    orders = retail.purchase_orders(stream_table(spark, w.folder, "events"))
    flags = order_streams.first_order_stream(orders)
    run_available(table_writer(flags, path), work_dir(spark, "checkpoint"))
    return w.spark.read.parquet(path)


@query
def first_order_job(w: Warehouse) -> DataFrame:
    spark = state_session(w.spark)
    path, state = work_dir(spark, "flags"), work_dir(spark, "state")
    orders = retail.purchase_orders(stream_table(spark, w.folder, "events"))
    writer = each_batch(orders, order_streams.save_first_orders(path, state))
    run_available(writer, work_dir(spark, "checkpoint"))
    return w.spark.read.parquet(path).select("id", "user_id", "create_time", "if_first_order")


def _order_topics(w: Warehouse, job: Callable[[DataFrame, DataFrame], DataStreamWriter]) -> None:
    """Run a job over orders and lines as two topics, each with its event time.

    The topics arrive in two parts, by day, and the job is stopped in between: it goes on
    from its checkpoint. The second part ends with an order and a line of a far later day
    that do not belong together, so that the watermark passes all others.
    """
    spark = backlog_session(w.spark, stored_bytes(w.spark, w.folder))
    w = Warehouse(spark, w.folder)
    order_topic, detail_topic = work_dir(spark, "orders"), work_dir(spark, "details")
    checkpoint = work_dir(spark, "checkpoint")
    orders = order_time_parts(w.orders())
    details = retail.timed_details(w.table("lineitem"), w.table("orders"))
    days = w.table("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    middle = F.lit(days["a"] + (days["b"] - days["a"]) / 2).cast("date").cast("timestamp")
    # The lines of a day follow its orders by seconds, so both topics part at midnight.
    far = F.lit(days["b"]).cast("timestamp") + F.make_interval(years=F.lit(1))
    last_order = w.spark.range(1).select(F.lit(-1).cast("bigint").alias("id"), far.alias("order_ts"))
    last_detail = w.spark.range(1).select(
        F.lit(-2).cast("bigint").alias("id"), F.lit(-2).cast("bigint").alias("order_id"), far.alias("detail_ts")
    )
    for later in (False, True):
        for rows, ts, path, end in (
            (orders, "order_ts", order_topic, last_order),
            (details, "detail_ts", detail_topic, last_detail),
        ):
            part = rows.where((F.col(ts) >= middle) == F.lit(later))
            if later:
                part = part.unionByName(end, allowMissingColumns=True)
            part.write.mode("append").parquet(path)
        sides = (
            spark.readStream.schema(orders.schema).parquet(order_topic),
            spark.readStream.schema(details.schema).parquet(detail_topic),
        )
        run_available(job(*sides), checkpoint)


def _joined_stream(w: Warehouse, tolerance: str) -> DataFrame:
    path = work_dir(w.spark, "wide")
    _order_topics(
        w, lambda orders, details: table_writer(order_streams.join_order_detail(orders, details, tolerance), path)
    )
    return w.spark.read.parquet(path).select(
        "order_id",
        "order_detail_id",
        "user_id",
        "sku_id",
        "sku_price",
        "sku_num",
        "final_total_amount",
        "create_time",
        "dt",
    )


@query
def order_wide_stream(w: Warehouse) -> DataFrame:
    return _joined_stream(w, order_streams.SHORT_TOLERANCE)


@query
def order_wide_buffered(w: Warehouse) -> DataFrame:
    return _joined_stream(w, order_streams.LONG_TOLERANCE)


@query
def order_wide_outer_stream(w: Warehouse) -> DataFrame:
    """Pairs within 15 seconds, and the orders and lines that found no partner."""
    pairs, alone = work_dir(w.spark, "wide"), work_dir(w.spark, "unmatched")
    save = order_streams.save_sides(pairs, alone)
    _order_topics(
        w, lambda orders, details: each_batch(order_streams.outer_join_order_detail(orders, details), save)
    )
    columns = ["order_id", "order_detail_id", "sku_price", "final_total_amount"]
    matched = w.spark.read.parquet(pairs).select(F.lit(order_streams.BOTH).alias("side"), *columns)
    return matched.unionByName(w.spark.read.parquet(alone).select("side", *columns))


def _streamed_shares(w: Warehouse) -> str:
    """The folder of the streamed wide table, by day, with line shares."""
    path = work_dir(w.spark, "wide")

    def job(orders: DataFrame, details: DataFrame) -> DataStreamWriter:
        joined = order_streams.join_order_detail(orders, details, order_streams.LONG_TOLERANCE)
        return sinks.store_order_wide(split_amount_stream(joined, wait=order_streams.LONG_TOLERANCE), path)

    _order_topics(w, job)
    return path


@query
def detail_amount_stream(w: Warehouse) -> DataFrame:
    """The streamed wide table: every line with its share of its order's amount."""
    return w.spark.read.parquet(_streamed_shares(w)).select(
        "order_id", "order_detail_id", "sku_price", "final_total_amount", "final_detail_amount"
    )


@query
def pair_dedupe_renewed(w: Warehouse) -> DataFrame:
    """Order lines sent three times: again after 500 seconds, and after 500 or 700 more.
    The life of an order's set is renewed by each sighting, so the lines of odd orders
    never pass again and those of even ones do."""
    spark = state_session(w.spark)
    topic, path, checkpoint = work_dir(spark, "lines"), work_dir(spark, "pairs"), work_dir(spark, "checkpoint")
    lines = retail.timed_details(w.table("lineitem"), w.table("orders")).select("order_id", "id", "detail_ts")
    third = F.when(F.col("order_id") % 2 == 0, F.lit(1200)).otherwise(F.lit(1000))
    sent = lines.withColumn("_after", F.explode(F.array(F.lit(0), F.lit(500), third))).select(
        "order_id", "id", (F.col("detail_ts") + F.make_interval(secs=F.col("_after"))).alias("seen_at")
    )
    days = w.table("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    # The run is stopped in the middle of a day, between two sightings of its lines.
    middle = F.lit(days["a"] + (days["b"] - days["a"]) / 2).cast("date").cast("timestamp") + F.make_interval(secs=F.lit(300))
    for later in (False, True):
        sent.where((F.col("seen_at") >= middle) == F.lit(later)).write.mode("append").parquet(topic)
        stream = spark.readStream.schema(sent.schema).parquet(topic)
        run_available(table_writer(dedupe_renewed(stream, "order_id", "id", "seen_at"), path), checkpoint)
    return w.spark.read.parquet(path).select(
        "order_id", F.col("id").alias("order_detail_id"), second_text(F.col("seen_at")).alias("seen_at")
    )


@query
def pair_dedupe_stream(w: Warehouse) -> DataFrame:
    """Order lines sent twice pass once per (order, line)."""
    spark = state_session(w.spark)
    path = work_dir(spark, "pairs")
    lines = retail.order_details(stream_table(spark, w.folder, "lineitem"))
    twice = lines.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    timed = twice.withColumn("seen_at", F.timestamp_seconds(F.col("line_no") * 5))
    unique = dedupe_stream(timed, ["order_id", "id"], "seen_at", order_streams.LONG_TOLERANCE)
    run_available(table_writer(unique, path), work_dir(spark, "checkpoint"))
    return w.spark.read.parquet(path).select("order_id", F.col("id").alias("order_detail_id"))


@query
def resume_from_checkpoint(w: Warehouse) -> DataFrame:
    """Two runs over one topic, the second after more files arrived: all rows, once."""
    spark = state_session(w.spark)
    topic, out, checkpoint = work_dir(spark, "topic"), work_dir(spark, "out"), work_dir(spark, "checkpoint")
    logs = retail.app_log_lines(w.logs())
    half = F.lit("2024-01-16").cast("timestamp")
    for part in (logs.where(F.col("event_time") < half), logs.where(F.col("event_time") >= half)):
        sinks.topic_sink(sinks.topic_rows(part, F.lit("LOG"), "value", "log_id"), topic)
        source = topic_source(spark, "LOG", path=topic)
        run_available(table_writer(source, out), checkpoint)
    return w.spark.read.parquet(out).select("key", "value")


@query
def stored_offsets(w: Warehouse) -> DataFrame:
    """What two runs over one topic have read, from their own reports."""
    spark = state_session(w.spark)
    topic, out, checkpoint = work_dir(spark, "topic"), work_dir(spark, "out"), work_dir(spark, "checkpoint")
    table = work_dir(spark, "offsets")
    logs = retail.app_log_lines(w.logs())
    half = F.lit("2024-01-16").cast("timestamp")
    for part in (logs.where(F.col("event_time") < half), logs.where(F.col("event_time") >= half)):
        sinks.topic_sink(sinks.topic_rows(part, F.lit("LOG"), "value", "log_id"), topic)
        run = start(table_writer(topic_source(spark, "LOG", path=topic), out), checkpoint, available_now=True)
        run.awaitTermination()
        offsets.save_query_offsets(spark, run, "warehouse", table)
    return offsets.read_offsets(w.spark, table)


@query
def topic_rejects(w: Warehouse) -> DataFrame:
    """Order records of which every seventh is cut off, in two runs: the typed orders, and
    the records that could not be read."""
    spark = state_session(w.spark)
    topics, good, bad = work_dir(spark, "topics"), work_dir(spark, "orders"), work_dir(spark, "rejects")
    checkpoint = work_dir(spark, "checkpoint")
    text = retail.order_json()
    cut = F.when(F.col("o_orderkey") % 7 == 0, F.substring(text, 1, 25)).otherwise(text)
    lines = w.table("orders").select("o_orderkey", cut.alias("value"))
    for later in (0, 1):
        part = lines.where(F.col("o_orderkey") % 2 == later)
        sinks.topic_sink(sinks.topic_rows(part, F.lit("ODS_ORDER_INFO"), "value"), topics)
        source = topic_source(spark, "ODS_ORDER_INFO", path=topics)

        def save(rows: DataFrame, batch_id: int) -> None:
            sinks.append_batch(rows, batch_id, good, ())

        run_available(each_parsed(source, schemas.ORDER_INFO, save, bad), checkpoint)
    orders = w.spark.read.parquet(good).select("topic", "id", F.lit(None).cast("string").alias("value"))
    broken = w.spark.read.parquet(bad).select("topic", F.lit(None).cast("bigint").alias("id"), "value")
    return orders.unionByName(broken)


@query
def late_rows(w: Warehouse) -> DataFrame:
    """Logs in three runs of ten days each, of which every fiftieth comes a run late: the
    rows on time, and those the watermark had passed, with the seconds it had."""
    spark = state_session(w.spark)
    topic, checkpoint = work_dir(spark, "logs"), work_dir(spark, "checkpoint")
    on_time, late, clock = (work_dir(spark, name) for name in ("on_time", "late", "clock"))

    def save(rows: DataFrame, batch_id: int) -> None:
        sinks.append_batch(rows, batch_id, on_time, ())

    day = F.dayofmonth("event_time")
    turn = F.least(F.floor((day - 1) / 10), F.lit(2)) + F.when(F.col("log_id") % 50 == 0, 1).otherwise(0)
    logs = w.logs().select("log_id", "mid", "event_time", turn.cast("int").alias("turn"))
    for number in range(4):
        logs.where(F.col("turn") == number).drop("turn").write.mode("append").parquet(topic)
        stream = spark.readStream.schema("log_id bigint, mid string, event_time timestamp").parquet(topic)
        writer = each_batch(stream, split_late(save, late, clock, "event_time", "1 day"))
        run_available(writer, checkpoint)
    passed = w.spark.read.parquet(on_time).select("log_id", "mid", F.lit(None).cast("double").alias("late_by"))
    return passed.unionByName(w.spark.read.parquet(late).select("log_id", "mid", "late_by"))


@query
def dimension_job(w: Warehouse) -> DataFrame:
    """Each order is one change of its user; two batches, the second one twice."""
    changes = w.table("orders").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.concat(F.lit("user of order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.lit(None).cast("string").alias("birthday"),
        F.col("o_orderstatus").alias("gender"),
        second_text(F.col("o_orderdate").cast("timestamp")).alias("changed"),
        F.col("o_orderkey").alias("version"),
    )
    shape = StructType([*schemas.USER_INFO.fields, *schemas.struct(changed=schemas.TEXT, version=schemas.LONG).fields])
    kept = KeyedTable(work_dir(w.spark, "users"), shape, ["id"], newest=["changed", "version"], buckets=16)
    for batch, rows in _two_batches(changes, F.col("version")):
        kept.save(rows, batch)
    return kept.read(w.spark).select("id", "name", "gender", "changed", "version")


# Stored tables, a day at a time ----------------------------------------------------------


DAY = "2024-01-10"
ORDER_DAY = "1998-06-15"


@query
def dau_total_day(w: Warehouse) -> DataFrame:
    """Devices of a day and of the day before, from the folders of those days."""
    path = work_dir(w.spark, "dau")
    sinks.save_by_id(devices.dau_info(w.logs()), path, ["mid"], oldest=["ts"])
    stored = read_day(w.spark, path, DAY, prev_days=1).withColumn("dt", F.col("dt").cast("string"))
    return devices.dau_total(stored)


def _stored_wide(w: Warehouse, wide_rows: DataFrame) -> str:
    path = work_dir(w.spark, "wide")
    sinks.store_order_wide(wide_rows, path)
    return path


@query
def order_total_day(w: Warehouse) -> DataFrame:
    """The amount of one day, summed over the shares of the stored wide table."""
    path = _stored_wide(w, w.amounts())
    return metrics.order_total_amount(read_day(w.spark, path, ORDER_DAY), ORDER_DAY)


@query
def order_hour_day(w: Warehouse) -> DataFrame:
    """Amounts per hour of one day and of the day before, hours 00 to 23."""
    path = _stored_wide(w, w.purchase_wide())
    hourly = metrics.order_hour_amount(read_day(w.spark, path, DAY, prev_days=1))
    return metrics.hour_compare(hourly, "order_amount", DAY)


@query
def sale_detail_day(w: Warehouse) -> DataFrame:
    """Lines of one day whose sku name holds a keyword, from the stored wide table."""
    lines = wide.widen(order_time_parts(w.orders()), w.with_sku(w.details()))
    path = _stored_wide(w, lines)
    page = search.sale_detail_page(read_day(w.spark, path, ORDER_DAY), ORDER_DAY, "ring", limit=20)
    return page.select("dt", "order_id", "order_detail_id", "sku_name", "highlighted", "total")


# Kept up to date ---------------------------------------------------------------------------


@query
def dau_rollup(w: Warehouse) -> DataFrame:
    """Hourly active devices after two batches, the later logs first: the earlier ones move
    devices to another hour. The second batch comes twice."""
    kept = RollUp(work_dir(w.spark, "dau"), ["mid", "dt"], schemas.LONG, oldest="ts", buckets=16)
    logs = devices.dau_info(w.logs()).withColumn("amount", F.lit(1))
    noon = F.col("hr") < "12"
    for batch, rows in ((0, logs.where(~noon)), (1, logs.where(noon)), (1, logs.where(noon))):
        kept.save(rows, batch)
    return kept.read(w.spark).select("dt", "hr", "n")


@query
def order_rollup(w: Warehouse) -> DataFrame:
    """Hourly amounts after a correction: in the first batch every third order was booked for
    another amount, an hour of another day."""
    kept = RollUp(work_dir(w.spark, "amounts"), ["id"], schemas.MONEY, newest="version", buckets=16)
    orders = order_time_parts(w.purchases()).select(
        "id",
        F.col("create_date").alias("dt"),
        F.col("create_hour").alias("hr"),
        F.col("final_total_amount").alias("amount"),
        F.lit(1).alias("version"),
    )
    wrong = F.col("id") % 3 == 0
    booked = orders.withColumns(
        {
            "dt": F.when(wrong, "2024-02-01").otherwise(F.col("dt")),
            "amount": F.when(wrong, F.col("amount") + 1).otherwise(F.col("amount")),
            "version": F.lit(0),
        }
    )
    for batch, rows in ((0, booked), (1, orders.where(wrong)), (1, orders.where(wrong))):
        kept.save(rows, batch)
    return kept.read(w.spark).select("dt", "hr", F.col("amount").alias("order_amount"))


@query
def search_deep_page(w: Warehouse) -> DataFrame:
    """Twenty order lines from the 5000th on, dearest first, from the range that holds them."""
    path = work_dir(w.spark, "ranges")
    order = [F.desc("order_price"), "id"]
    store_ranges(w.details().select("id", "order_id", "order_price"), path, order, ranges=16)
    return ranged_page(w.spark, path, order, 5000, 20)
