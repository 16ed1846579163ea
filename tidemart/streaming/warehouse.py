"""The jobs of the real-time warehouse, from topic to topic to table.

Each function returns a writer for `jobs.start`. Tables that a job looks up are read
again in every micro-batch, so changed dimensions count from the next batch on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemart import schemas
from tidemart.functions.text import json_text
from tidemart.functions.times import age_group, order_time_parts
from tidemart.operators.dimensions import enrich, enrich_province, enrich_sku
from tidemart.operators.routing import START_TOPIC, change_records, route_app_log, route_cdc
from tidemart.sources.keyed import KeyedTable
from tidemart.sources.sinks import append_batch, store_order_wide, topic_rows, topic_sink
from tidemart.sources.tables import ensure_folder
from tidemart.sources.topics import topic_source
from tidemart.streaming.devices import dau_stream, save_dau
from tidemart.streaming.jobs import RECORD, each_batch, each_parsed
from tidemart.streaming.orders import (
    BOTH,
    SHORT_TOLERANCE,
    join_order_detail,
    outer_join_order_detail,
    save_first_orders,
    without_partner,
)
from tidemart.streaming.shares import split_amount_stream

# Topics of the enriched orders and lines.
ORDER_TOPIC = "DWD_ORDER_INFO"
DETAIL_TOPIC = "DWD_ORDER_DETAIL"

# The dimension tables: schema and key.
DIMENSIONS = {
    "base_province": (schemas.PROVINCE, "id"),
    "user_info": (schemas.USER_INFO, "id"),
    "sku_info": (schemas.SKU_INFO, "id"),
    "spu_info": (schemas.SPU_INFO, "id"),
    "base_trademark": (schemas.TRADEMARK, "tm_id"),
    "base_category3": (schemas.CATEGORY3, "id"),
}

_ARRIVAL = ("arrived", "position")
_TEXT = schemas.TEXT
RICH_ORDER = schemas.T.StructType(
    [
        *schemas.ORDER_INFO.fields,
        *schemas.struct(
            create_date=_TEXT,
            create_hour=_TEXT,
            if_first_order=_TEXT,
            province_name=_TEXT,
            province_area_code=_TEXT,
            province_iso_3166_2=_TEXT,
            user_age_group=_TEXT,
            user_gender=_TEXT,
        ).fields,
    ]
)
RICH_DETAIL = schemas.T.StructType(
    [
        *schemas.ORDER_DETAIL.fields,
        *schemas.struct(
            spu_id=schemas.LONG,
            tm_id=schemas.LONG,
            category3_id=schemas.LONG,
            spu_name=_TEXT,
            tm_name=_TEXT,
            category3_name=_TEXT,
        ).fields,
    ]
)


def table_topic_name(table: str) -> str:
    return f"ODS_{table.upper()}"


@dataclass(frozen=True)
class Layout:
    """Where topics and tables live: a Kafka cluster or a folder, and a folder."""

    tables: str
    topics: str | None = None
    servers: str | None = None

    @property
    def fmt(self) -> str:
        return "kafka" if self.servers else "parquet"

    def source(self, spark: SparkSession, topic: str) -> DataFrame:
        return topic_source(spark, topic, fmt=self.fmt, path=self.topics, servers=self.servers)

    def sink(self, records: DataFrame, writer: str, batch_id: int = 0) -> DataStreamWriter | None:
        return topic_sink(
            records, self.topics, fmt=self.fmt, servers=self.servers, writer=writer, batch_id=batch_id
        )

    def table(self, name: str) -> str:
        return f"{self.tables}/{name}"


def route_logs(lines: DataFrame, layout: Layout) -> DataStreamWriter:
    """Log lines to the start and event topics."""
    return layout.sink(topic_rows(route_app_log(lines), "topic"), "route_logs")


def route_changes(lines: DataFrame, layout: Layout, payload: str = "object") -> DataStreamWriter:
    """Change records to one topic per table."""
    routed = route_cdc(change_records(lines), payload)
    return layout.sink(topic_rows(routed, "topic"), f"route_changes_{payload}")


def rejects(layout: Layout) -> str:
    """The table of records that no job could read: topic, arrived, position, value, batch_id."""
    return layout.table("rejects")


def _timed(schema: schemas.T.StructType) -> F.Column | None:
    """Orders and lines need a time: without one they would wait in the join for ever."""
    return F.col("create_time").try_cast("timestamp").isNotNull() if "create_time" in schema.names else None


# Topics that stateful jobs read: their records are parsed by a job of its own.
STAGED = {START_TOPIC: schemas.APP_LOG, ORDER_TOPIC: RICH_ORDER, DETAIL_TOPIC: RICH_DETAIL}


def stage(spark: SparkSession, layout: Layout, topic: str) -> DataStreamWriter:
    """The records of a topic as typed rows, for the stateful jobs; the others to `rejects`."""
    schema = STAGED[topic]
    path = layout.table(f"staged/{topic}")

    def save(rows: DataFrame, batch_id: int) -> None:
        append_batch(rows, batch_id, path, ())

    return each_parsed(layout.source(spark, topic), schema, save, rejects(layout), _timed(schema))


def staged(spark: SparkSession, layout: Layout, topic: str) -> DataFrame:
    """The typed rows of a topic as a stream."""
    record = schemas.struct(topic=_TEXT, arrived=schemas.T.TimestampType(), position=schemas.LONG)
    schema = schemas.T.StructType([*STAGED[topic].fields, *record.fields])
    path = ensure_folder(spark, layout.table(f"staged/{topic}"))
    return spark.readStream.schema(schema).parquet(path)


def daily_devices(spark: SparkSession, layout: Layout) -> DataStreamWriter:
    """Staged start logs to the table of daily devices (`dau`)."""
    logs = staged(spark, layout, START_TOPIC).select(
        "common.*", "ts", F.col("position").alias("log_id"), F.timestamp_millis("ts").alias("event_time")
    )
    return each_batch(dau_stream(logs), save_dau(layout.table("dau")), "update")


def dimension_table(layout: Layout, table: str) -> KeyedTable:
    schema, key = DIMENSIONS[table]
    arrival = schemas.struct(arrived=schemas.T.TimestampType(), position=schemas.LONG)
    full = schemas.T.StructType([*schema.fields, *arrival.fields])
    return KeyedTable(layout.table(table), full, [key], newest=["batch_id", *_ARRIVAL])


def dimension(spark: SparkSession, layout: Layout, table: str) -> DataStreamWriter:
    """Changes of one dimension table, the last to arrive wins. A batch reads and writes only
    the buckets of its keys."""
    schema, _ = DIMENSIONS[table]
    kept = dimension_table(layout, table)
    return each_parsed(layout.source(spark, table_topic_name(table)), schema, kept.save, rejects(layout))


def read_dimension(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """The newest row per key; no rows before the first change."""
    schema, _ = DIMENSIONS[table]
    return dimension_table(layout, table).read(spark).select(*schema.names)


def order_info(spark: SparkSession, layout: Layout) -> DataStreamWriter:
    """Orders with first-order flag, province and user; to a table by day, to the
    user state, and to the topic of enriched orders, keyed by order id."""

    def prepare(flagged: DataFrame) -> DataFrame:
        session = flagged.sparkSession
        placed = enrich_province(flagged, read_dimension(session, layout, "base_province"))
        users = read_dimension(session, layout, "user_info")
        rich = enrich(placed, users, {"user_id": "id"}, {"gender": "user_gender", "birthday": "_born"})
        aged = age_group(rich, "_born", F.col("create_date"), "user_age_group").drop("_born")
        return aged.withColumn("dt", F.col("create_date"))

    def emit(orders: DataFrame, batch_id: int) -> None:
        records = topic_rows(orders, F.lit(ORDER_TOPIC), json_text(*RICH_ORDER.names), "id")
        layout.sink(records, "order_info", batch_id)

    save = save_first_orders(
        layout.table("order_info"), layout.table("user_state"), ("dt",), prepare, emit
    )
    records = layout.source(spark, table_topic_name("order_info"))
    return each_parsed(
        records,
        schemas.ORDER_INFO,
        lambda rows, batch_id: save(order_time_parts(rows.drop(*RECORD)), batch_id),
        rejects(layout),
    )


def order_detail(spark: SparkSession, layout: Layout) -> DataStreamWriter:
    """Order lines with sku, spu, trademark and category, to the topic of enriched lines."""

    def save(batch: DataFrame, batch_id: int) -> None:
        names = ("sku_info", "spu_info", "base_trademark", "base_category3")
        dims = [read_dimension(batch.sparkSession, layout, name) for name in names]
        rich = enrich_sku(batch.drop(*RECORD), *dims)
        records = topic_rows(rich, F.lit(DETAIL_TOPIC), json_text(*RICH_DETAIL.names))
        layout.sink(records, "order_detail", batch_id)

    records = layout.source(spark, table_topic_name("order_detail"))
    return each_parsed(records, schemas.ORDER_DETAIL, save, rejects(layout))


def _sides(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    at = F.col("create_time").try_cast("timestamp")
    orders = staged(spark, layout, ORDER_TOPIC).drop(*RECORD).withColumn("order_ts", at)
    return orders, staged(spark, layout, DETAIL_TOPIC).drop(*RECORD).withColumn("detail_ts", at)


def order_wide(spark: SparkSession, layout: Layout, tolerance: str = SHORT_TOLERANCE) -> DataStreamWriter:
    """Staged orders and lines to wide rows, each line with its share of the amount. The rows
    of an order leave when no line of it can come any more."""
    joined = join_order_detail(*_sides(spark, layout), tolerance)
    return store_order_wide(split_amount_stream(joined, wait=tolerance), layout.table("order_wide"))


def order_unmatched(spark: SparkSession, layout: Layout, tolerance: str = SHORT_TOLERANCE) -> DataStreamWriter:
    """Staged orders and lines to the table of those that found no partner, by side."""
    sides = outer_join_order_detail(*_sides(spark, layout), tolerance)
    alone = sides.where(F.col("side") != BOTH)
    path = layout.table("order_unmatched")
    return each_batch(alone, lambda batch, n: append_batch(without_partner(batch), n, path, ("side",)))
