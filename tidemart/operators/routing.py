"""Which topic a log line or a change record belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.text import computed_once, raw_elements, raw_member
from tidemart.schemas import CHANGE_RECORD

# Topics of the log lines.
START_TOPIC = "START_LOG"
EVENT_TOPIC = "EVENT_LOG"

# Order tables pass on insert only, dimension tables on any type.
ORDER_TABLES = ("order_info", "order_detail")
DIMENSION_TABLES = (
    "base_province",
    "user_info",
    "sku_info",
    "base_trademark",
    "base_category3",
    "spu_info",
)

# A payload of up to three characters ("{}", "[]") holds no row.
MIN_PAYLOAD = 3


def table_topic(table: Column) -> Column:
    return F.concat(F.lit("ODS_"), F.upper(table))


def route_app_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Log lines with a non-empty `start` go to the start topic, others to the event topic."""
    start = F.get_json_object(F.col(value_col), "$.start")
    topic = F.when(F.length(start) > 0, F.lit(START_TOPIC)).otherwise(F.lit(EVENT_TOPIC))
    return lines.select(topic.alias("topic"), F.col(value_col).alias("value"))


def change_records(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Change-capture JSON as (table, type, data); `data` is the payload's own text."""
    envelopes = computed_once(lines, F.from_json(value_col, CHANGE_RECORD), value_col)
    data = raw_member(F.col(value_col), "data", F.col("data"))
    return envelopes.select("table", "type", data.alias("data"))


def route_cdc(records: DataFrame, payload: str = "object") -> DataFrame:
    """Change records (table, type, data) to (topic, value); what no rule names is dropped.

    `object`: one row per record, lower-case types, dimension tables included.
    `array`: one output per array element, upper-case types, order tables only.
    """
    table, kind = F.col("table"), F.col("type")
    if payload == "object":
        rule = (table.isin(*ORDER_TABLES) & (kind == "insert")) | table.isin(*DIMENSION_TABLES)
    elif payload == "array":
        rule = table.isin(*ORDER_TABLES) & (kind == "INSERT")
    else:
        raise ValueError(f"unknown payload: {payload}")
    # Payloads are looked at after the rules on table and type, and once.
    kept = computed_once(
        records.where(rule), F.struct(table_topic(table).alias("topic"), F.col("data").alias("value"))
    )
    if payload == "array":
        return kept.select("topic", F.explode(raw_elements(F.col("value"))).alias("value"))
    return kept.where(F.length("value") > MIN_PAYLOAD)
