"""The whole real-time warehouse at the smallest scale, from change records to amounts."""

import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from tidemart.functions.text import json_text
from tidemart.operators.metrics import order_total_amount
from tidemart.plans.oracles import ORACLES
from tidemart.plans.warehouse import Warehouse
from tidemart.schemas import USER_FIRST_ORDER
from tidemart.session import state_session, work_dir
from tidemart.sources import retail
from tidemart.sources.keyed import KeyedTable
from tidemart.sources.sinks import topic_rows, topic_sink
from tidemart.sources.topics import topic_source
from tidemart.streaming import warehouse as jobs
from tidemart.streaming.devices import DAU_KEYS
from tidemart.sources.sinks import read_grown
from tidemart.streaming.jobs import run_available

FOLDER = "/root/testdata/sf0.001"


def change_rows(w):
    """Every business table as insert records of the change capture."""
    part = w.table("part")
    details = retail.timed_details(w.table("lineitem"), w.table("orders")).withColumn(
        "create_time", F.col("detail_ts").cast("string")
    ).drop("detail_ts", "line_no")
    tables = {
        "order_info": w.orders(located=True).drop("order_ts"),
        "order_detail": details,
        "base_province": w.provinces(),
        "user_info": w.users(),
        "sku_info": retail.skus(part),
        "spu_info": retail.spus(part),
        "base_trademark": retail.trademarks(part),
        "base_category3": retail.categories(part),
    }
    out = None
    for name, df in tables.items():
        rows = df.select(F.lit(name).alias("table"), F.lit("insert").alias("type"), json_text().alias("data"))
        out = rows if out is None else out.unionAll(rows)
    return retail.change_lines(out)


@pytest.fixture(scope="module")
def built(spark):
    """Run all jobs once and give the folder layout."""
    session = state_session(spark, 4)
    w = Warehouse(spark, FOLDER)
    layout = jobs.Layout(tables=work_dir(spark, "tables"), topics=work_dir(spark, "topics"))
    topic_sink(topic_rows(change_rows(w), F.lit("CHANGES"), "value"), layout.topics)
    topic_sink(topic_rows(retail.app_log_lines(w.logs()), F.lit("LOGS"), "value"), layout.topics)

    def run(writer):
        run_available(writer, work_dir(spark, "checkpoint"))

    run(jobs.route_changes(topic_source(session, "CHANGES", path=layout.topics), layout))
    run(jobs.route_logs(topic_source(session, "LOGS", path=layout.topics), layout))
    for table in jobs.DIMENSIONS:
        run(jobs.dimension(session, layout, table))
    run(jobs.order_info(session, layout))
    run(jobs.order_detail(session, layout))
    # An order and a line of a later year, which let the watermark pass all others, and
    # records that cannot be read, or have no time.
    for topic, closing in (
        (jobs.ORDER_TOPIC, '{"id":-1,"create_time":"2030-01-01 00:00:00"}'),
        (jobs.DETAIL_TOPIC, '{"id":-2,"order_id":-2,"create_time":"2030-01-01 00:00:00"}'),
    ):
        lines = [(closing,), ('{"id":-3,"create_time":"soon"}',), ("{broken",), (None,)]
        topic_sink(topic_rows(spark.createDataFrame(lines, "value string"), F.lit(topic)), layout.topics)
    for topic in jobs.STAGED:
        run(jobs.stage(session, layout, topic))
    run(jobs.order_wide(session, layout, "600 seconds"))
    run(jobs.order_unmatched(session, layout, "600 seconds"))
    run(jobs.daily_devices(session, layout))
    return layout


def test_wide_rows_equal_the_batch(spark, built):
    """The streamed wide rows, with the shares of their lines, are the rows of the SQL definition."""
    wide = spark.read.parquet(built.table("order_wide")).drop("month")
    assert differences(wide, connect(FOLDER), ORACLES["order_wide"]) == ""


def test_amounts_of_the_streamed_table_add_up_by_day(spark, built):
    wide = spark.read.parquet(built.table("order_wide"))
    assert differences(order_total_amount(wide), connect(FOLDER), ORACLES["order_total_amount"]) == ""


def test_orders_without_lines_are_reported(spark, built):
    alone = spark.read.parquet(built.table("order_unmatched")).where("order_id > 0")
    assert alone.where("side = 'detail'").count() == 0
    orders = alone.select(F.col("order_id").alias("id"), "user_id", "final_total_amount")
    assert differences(orders, connect(FOLDER), ORACLES["orders_without_detail"]) == ""


def test_unreadable_records_are_kept_once(spark, built):
    rows = spark.read.parquet(jobs.rejects(built)).collect()
    found = sorted((r["topic"], r["value"] or "") for r in rows)
    bad = ["", '{"id":-3,"create_time":"soon"}', "{broken"]
    assert found == [(t, v) for t in sorted((jobs.ORDER_TOPIC, jobs.DETAIL_TOPIC)) for v in bad]
    assert all(r["arrived"] is not None and r["position"] is not None for r in rows)


def test_orders_are_kept_by_day_with_their_flags(spark, built):
    orders = read_grown(spark, built.table("order_info"), ["id"])
    first = orders.where("if_first_order = '1'")
    assert orders.count() == 1500
    assert first.count() == first.select("user_id").distinct().count() == orders.select("user_id").distinct().count()
    state = KeyedTable(built.table("user_state"), USER_FIRST_ORDER, ["user_id"], oldest=["batch_id"]).read(spark)
    assert state.count() == first.count() and state.where("if_consumed <> '1'").count() == 0


def test_start_logs_become_daily_devices(spark, built):
    dau = read_grown(spark, built.table("dau"), DAU_KEYS, oldest=["ts"])
    expected = connect(FOLDER).execute(
        "SELECT count(DISTINCT (user_id, CAST(ts AS DATE))) FROM events WHERE event_type = 'signup'"
    ).fetchone()[0]
    assert dau.count() == expected


def test_dimension_reads_before_the_first_change(spark, folder):
    layout = jobs.Layout(tables=folder("tables"), topics=folder("topics"))
    assert jobs.read_dimension(spark, layout, "user_info").count() == 0


def test_kafka_layout_is_chosen_by_servers():
    assert jobs.Layout("t", servers="h:1").fmt == "kafka"
    assert jobs.Layout("t", topics="p").fmt == "parquet"
