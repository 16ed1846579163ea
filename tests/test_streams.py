"""Streams in several batches against their batch twins."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.operators.devices import first_log_per_day
from tidemart.operators.first_order import first_order_flag
from tidemart.operators.metrics import sliding_counts
from tidemart.session import state_session
from tidemart.sources.sinks import read_grown
from tidemart.streaming.dedupe import dedupe_stream
from tidemart.streaming.devices import DAU_KEYS, dau_stream, first_log_dedupe, save_dau
from tidemart.streaming.jobs import console_writer, each_batch, run_available, start, table_writer
from tidemart.streaming.orders import first_order_stream, join_order_detail, save_first_orders, save_upserts


@pytest.fixture(scope="module")
def stateful(spark):
    return state_session(spark, 4)


def feed(session, path, batches):
    """Write each batch as one more file of a topic and return the stream over them."""
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    return session.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def log_batches(spark, batches=3, size=40):
    rng = random.Random(3)
    out, log_id = [], 0
    for b in range(batches):
        rows = []
        for _ in range(size):
            # A third of all logs come from one device; times are not in order.
            mid = "hot" if rng.random() < 0.34 else f"m{rng.randint(0, 9)}"
            ts = 1_704_067_200_000 + rng.randint(0, 40 * 3600) * 1000
            rows.append((log_id, mid, f"u{log_id}", "1", "2", "3", ts))
            log_id += 1
        out.append(
            spark.createDataFrame(
                rows, "log_id bigint, mid string, uid string, ar string, ch string, vc string, ts bigint"
            ).withColumn("event_time", F.timestamp_millis("ts"))
        )
    return out


def test_dau_stream_equals_batch(spark, stateful, folder):
    batches = log_batches(spark)
    logs = feed(stateful, folder("logs"), batches)
    out = folder("dau")
    run_available(each_batch(dau_stream(logs, delay="3 days"), save_dau(out), "update"), folder("cp"))
    streamed = read_grown(spark, out, DAU_KEYS, oldest=["ts"])
    whole = batches[0].unionAll(batches[1]).unionAll(batches[2])
    assert same(streamed.select("mid", "uid", "dt", "hr", "ts"), first_log_per_day(whole).select("mid", "uid", "dt", "hr", "ts"))


@pytest.mark.parametrize("salts", [1, 3])
def test_device_dedupe_passes_each_device_once_a_day(spark, stateful, folder, salts):
    batches = log_batches(spark)
    out = folder("dau")
    firsts = first_log_dedupe(feed(stateful, folder("logs"), batches), delay="3 days", salts=salts)
    run_available(table_writer(firsts, out), folder("cp"))
    whole = batches[0].unionAll(batches[1]).unionAll(batches[2])
    assert same(spark.read.parquet(out).select("mid", "dt"), first_log_per_day(whole).select("mid", "dt"))


def order_rows(spark, *rows):
    return spark.createDataFrame(
        [(i, 9, Decimal("5.00"), t) for i, t in rows],
        "id bigint, user_id bigint, final_total_amount decimal(18,2), t string",
    ).select("id", "user_id", "final_total_amount", F.col("t").cast("timestamp").alias("order_ts"))


def detail_rows(spark, *rows):
    return spark.createDataFrame(
        [(i, o, Decimal("1.00"), t) for i, o, t in rows],
        "id bigint, order_id bigint, order_price decimal(18,2), t string",
    ).select("id", "order_id", "order_price", F.col("t").cast("timestamp").alias("detail_ts"))


NOON = "2024-01-01 12:00:00"
NEAR = [
    (1, 1, "2024-01-01 11:59:50"),
    (2, 1, "2024-01-01 12:00:14"),
    (3, 1, "2024-01-01 12:00:20"),
    (4, 1, "2024-01-01 12:10:01"),
    (5, 1, "2024-01-01 12:00:15"),
    (6, 1, "2024-01-01 12:10:00"),
]


@pytest.mark.parametrize("tolerance, expected", [("15 seconds", {1, 2, 5}), ("600 seconds", {1, 2, 3, 5, 6})])
def test_tolerance_bounds(spark, tolerance, expected):
    joined = join_order_detail(order_rows(spark, (1, NOON)), detail_rows(spark, *NEAR), tolerance)
    assert {r.order_detail_id for r in joined.collect()} == expected


def test_pairs_once_in_both_arrival_orders_with_repeated_records(spark, stateful, folder):
    """Lines before, with and after their order; records sent again; one order with most lines."""
    early, late = "2024-01-01 11:59:55", "2024-01-01 12:00:10"
    order_batches = [
        order_rows(spark, (1, NOON)),
        order_rows(spark, (2, NOON), (1, NOON)),
        order_rows(spark, (3, NOON), (2, NOON)),
    ]
    detail_batches = [
        detail_rows(spark, (20, 2, early), (30, 3, early), *[(100 + i, 1, early) for i in range(20)]),
        detail_rows(spark, (10, 1, late), (20, 2, early), (21, 2, late)),
        detail_rows(spark, (10, 1, late), (31, 3, late), (40, 4, late), (100, 1, early)),
    ]
    orders = feed(stateful, folder("orders"), order_batches)
    details = feed(stateful, folder("details"), detail_batches)
    out = folder("wide")
    run_available(table_writer(join_order_detail(orders, details, "600 seconds"), out), folder("cp"))
    got = sorted((r.order_id, r.order_detail_id) for r in spark.read.parquet(out).collect())
    assert got == sorted(
        [(1, 10), (2, 20), (2, 21), (3, 30), (3, 31)] + [(1, 100 + i) for i in range(20)]
    )
    batch = join_order_detail(
        order_batches[0].unionAll(order_batches[1]).unionAll(order_batches[2]),
        detail_batches[0].unionAll(detail_batches[1]).unionAll(detail_batches[2]),
        "600 seconds",
    )
    assert sorted((r.order_id, r.order_detail_id) for r in batch.collect()) == got


def first_batches(spark):
    rng = random.Random(11)
    schema = "id bigint, user_id bigint, create_time string"
    out, next_id = [], 1
    for b in range(3):
        rows = []
        for _ in range(40):
            user = 0 if rng.random() < 0.34 else rng.randint(1, 25)
            rows.append((next_id, user, f"2024-01-0{b + 1} {rng.randint(0, 23):02d}:00:00"))
            next_id += 1
        rng.shuffle(rows)
        out.append(spark.createDataFrame(rows, schema))
    return out


def test_first_order_stream_equals_batch(spark, stateful, folder):
    batches = first_batches(spark)
    out = folder("flags")
    flags = first_order_stream(feed(stateful, folder("orders"), batches), lanes=4)
    run_available(table_writer(flags, out), folder("cp"))
    whole = batches[0].unionAll(batches[1]).unionAll(batches[2])
    columns = ["id", "user_id", "create_time", "if_first_order"]
    assert same(spark.read.parquet(out).select(columns), first_order_flag(whole).select(columns))


def test_order_job_equals_batch_and_survives_a_replay(spark, folder):
    batches = first_batches(spark)
    orders, state = folder("orders"), folder("state")
    save = save_first_orders(orders, state)
    for i, batch in enumerate(batches):
        save(batch, i)
    columns = ["id", "user_id", "create_time", "if_first_order"]
    whole = batches[0].unionAll(batches[1]).unionAll(batches[2])
    expected = first_order_flag(whole).select(columns)
    assert same(spark.read.parquet(orders).select(columns), expected)
    # A batch that is run again, even after later ones, changes nothing.
    save(batches[1], 1)
    assert same(spark.read.parquet(orders).select(columns), expected)


def test_arrival_decides_across_batches(spark, stateful, folder):
    schema = "id bigint, user_id bigint, create_time string"
    batches = [
        spark.createDataFrame([(5, 1, "2024-01-02 00:00:00"), (2**60 + 1, 2**60 + 1, "2024-01-02 00:00:00"), (3, None, "x")], schema),
        spark.createDataFrame([(4, 1, "2024-01-01 00:00:00"), (9, 2, "2024-01-01 00:00:00"), (8, 2, "2024-01-01 00:00:00"), (7, 3, "2024-01-01 00:00:00"), (6, 3, None)], schema),
    ]
    out = folder("flags")
    run_available(table_writer(first_order_stream(feed(stateful, folder("o"), batches)), out), folder("cp"))
    assert {r.id: r.if_first_order for r in spark.read.parquet(out).collect()} == {
        5: "1", 4: "0", 8: "1", 9: "0", 6: "1", 7: "0", 2**60 + 1: "1", 3: "1",
    }


def test_dimension_job_keeps_the_newest_version(spark, stateful, folder):
    schema = "id string, name string, version bigint"
    batches = [
        spark.createDataFrame([("a", "a2", 2), ("a", "a1", 1), ("b", "b1", 1)], schema),
        spark.createDataFrame([("a", "a0", 0), ("b", "b2", 2)], schema),
    ]
    out = folder("dim")
    run_available(each_batch(feed(stateful, folder("changes"), batches), save_upserts(out)), folder("cp"))
    rows = read_grown(spark, out, ["id"], newest=["version", "batch_id"]).collect()
    assert {r.id: r.name for r in rows} == {"a": "a2", "b": "b2"}


def test_closed_windows_of_the_stream_equal_the_batch(spark, stateful, folder):
    batches = log_batches(spark, 2, 30)
    last = spark.createDataFrame([("2030-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("event_time"))
    data = [b.select("event_time") for b in batches]
    stream = feed(stateful, folder("logs"), [*data, last]).withWatermark("event_time", "3 days")
    out = folder("windows")
    run_available(table_writer(sliding_counts(stream, "event_time"), out), folder("cp"))
    assert same(spark.read.parquet(out), sliding_counts(data[0].unionAll(data[1]), "event_time"))


def test_copies_of_one_record_pass_once(spark, stateful, folder):
    rows = [(1, NOON)] * 200 + [(i, NOON) for i in range(2, 50)]
    out = folder("once")
    unique = dedupe_stream(feed(stateful, folder("o"), [order_rows(spark, *rows), order_rows(spark, *rows)]), ["id"], "order_ts", "600 seconds", salts=4)
    run_available(table_writer(unique, out), folder("cp"))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(1, 50))


def test_triggered_start_and_console(spark, stateful, folder):
    stream = feed(stateful, folder("o"), [order_rows(spark, (1, NOON))])
    query = start(console_writer(stream.select("id")), folder("cp"))
    query.processAllAvailable()
    query.stop()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
