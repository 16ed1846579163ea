"""Stateful processors serve many orders with one call to their state."""

import random
from decimal import Decimal
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.operators.wide import wide_columns
from tidemart.plans.queries import QUERIES
from tidemart.session import PARTITION_BYTES, state_session, tune
from tidemart.streaming import dedupe, interval, shares
from tidemart.streaming.jobs import each_batch, start, table_writer
from tidemart.streaming.orders import join_order_detail, outer_join_order_detail, save_sides
from tidemart.streaming.packed import pack_table, unpack

NOON, FAR = "2024-01-01 12:00:00", "2024-01-03 12:00:00"


@pytest.fixture(scope="module")
def stateful(spark):
    return state_session(spark, 2)


def updated(query):
    """Rows of state that the processor of a finished run has written."""
    return sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress)


def test_orders_of_one_time_share_their_state(spark, stateful, folder):
    topic, out = folder("t"), folder("o")
    # 300 orders of three lines; amounts that do not divide, one of them negative.
    lines = spark.range(900).select(
        (F.col("id") % 300).alias("order_id"),
        F.col("id").alias("order_detail_id"),
        F.lit("1.00").cast("decimal(18,2)").alias("sku_price"),
        F.when(F.col("id") % 300 == 7, "-10.00").otherwise("10.00").cast("decimal(18,2)").alias("final_total_amount"),
        F.lit(NOON).cast("timestamp").alias("order_ts"),
        F.lit(NOON).cast("timestamp").alias("detail_ts"),
    )
    far = [F.lit(-1).alias("order_id"), F.lit(FAR).cast("timestamp").alias("order_ts")]
    last = lines.limit(1).select(*far, *[c for c in lines.columns if c not in ("order_id", "order_ts")])
    lines = wide_columns(lines.unionByName(last), ["order_ts", "detail_ts"])
    lines.coalesce(1).write.parquet(topic)
    stream = stateful.readStream.schema(lines.schema).parquet(topic).withWatermark("order_ts", "1 minute")
    query = start(table_writer(shares.split_amount_stream(stream), out), folder("cp"), available_now=True)
    query.awaitTermination()
    rows = spark.read.parquet(out).groupBy("order_id").agg(F.sort_array(F.collect_list("final_detail_amount")).alias("a"))
    found = {r["order_id"]: r["a"] for r in rows.collect()}
    thirds = {i: ["3.33", "3.33", "3.34"] for i in range(300)} | {7: ["-3.34", "-3.34", "-3.32"]}
    found.pop(-1, None)
    assert found == {i: [Decimal(x) for x in a] for i, a in thirds.items()}
    assert updated(query) < 100


def test_sets_of_a_lane_share_their_state(spark, stateful, folder):
    topic, out = folder("t"), folder("o")
    sent = spark.range(1200).select(
        (F.col("id") % 300).alias("order_id"), (F.col("id") % 600).alias("id"), F.lit(NOON).cast("timestamp").alias("at")
    )
    sent.coalesce(1).write.parquet(topic)
    stream = stateful.readStream.schema(sent.schema).parquet(topic)
    unique = dedupe.dedupe_renewed(stream, "order_id", "id", "at", lanes=4)
    query = start(table_writer(unique, out), folder("cp"), available_now=True)
    query.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(600))
    assert updated(query) < 100


@pytest.mark.parametrize("outer", [False, True])
def test_orders_and_lines_of_a_lane_share_their_state(spark, stateful, folder, monkeypatch, outer):
    monkeypatch.setattr(interval, "LANES", 2)
    topics, out = (folder("o"), folder("d")), folder("w")
    at = lambda name: F.lit(NOON).cast("timestamp").alias(name)
    spark.range(400).select("id", at("order_ts")).coalesce(1).write.parquet(topics[0])
    spark.range(900).select("id", (F.col("id") % 300).alias("order_id"), at("detail_ts")).coalesce(1).write.parquet(topics[1])
    orders, details = (stateful.readStream.schema(spark.read.parquet(t).schema).parquet(t) for t in topics)
    if outer:
        writer = each_batch(outer_join_order_detail(orders, details), save_sides(out, folder("u")))
    else:
        writer = table_writer(join_order_detail(orders, details), out)
    query = start(writer, folder("cp"), available_now=True)
    query.awaitTermination()
    pairs = spark.read.parquet(out).select("order_id", "order_detail_id").collect()
    assert sorted(pairs) == sorted((i % 300, i) for i in range(900))
    assert updated(query) < 100


class Kept:
    """A list or value state, and the timers, of one lane."""

    def __init__(self):
        self.rows = []

    def get(self):
        return iter(self.rows) if not self.rows or isinstance(self.rows, list) else self.rows

    def put(self, rows):
        self.rows = list(rows)

    def appendValue(self, row):  # noqa: N802
        self.rows.append(row)

    def update(self, row):
        self.rows = row

    def exists(self):
        return bool(self.rows)

    def clear(self):
        self.rows = []


@pytest.mark.parametrize("outer", [False, True])
@pytest.mark.parametrize("size", [3, 1000])
def test_a_lane_joins_chunk_by_chunk_over_many_batches(monkeypatch, outer, size):
    """Rows in random batches, records sent again, a hot key, null keys: each pair once, and
    with `outer` each row that has none once, when the watermark passes."""
    monkeypatch.setattr(interval, "CHUNK", size)
    monkeypatch.setattr(interval, "PAIRS", size)
    second, rng = 1_000_000, random.Random(size)
    lines = [(i, rng.choice([0, 0, rng.randint(0, 40), None]), rng.randint(0, 900) * second) for i in range(300)]
    orders = [(i, rng.randint(0, 900) * second) for i in range(40)]
    rule = interval._Rule((("id", "order"), ("oid",)), ("order", "oid"), (("order", "id"), ("oid",)), 15 * second, 600 * second, True, outer)
    states, timers = [], set()

    def state(*_):
        states.append(Kept())
        return states[-1]

    handle = SimpleNamespace(getListState=state, getValueState=state, registerTimer=timers.add, deleteTimer=timers.remove)
    lane = interval._Lanes(rule)
    lane.init(handle)
    pairs, alone = [], []

    def take(frames):
        for frame in frames:
            for pack in frame["pairs"]:
                for row in unpack(pack).to_pylist():
                    (pairs if len(row) == 3 else alone).append((row.get("oid"), row.get("id")))

    def batch(some_lines, some_orders, watermark):
        tables = [
            pa.table({"id": [r[0] for r in some_lines], "order": pa.array([r[1] for r in some_lines], pa.int64()), "_at": [r[2] for r in some_lines]}),
            pa.table({"oid": [r[0] for r in some_orders], "_at": [r[1] for r in some_orders]}),
        ]
        frame = pd.DataFrame([(side, pack_table(t.slice(i, 5))) for side, t in enumerate(tables) for i in range(0, t.num_rows, 5)], columns=["side", "pack"])
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        take(lane.handleInputRows(("x",), iter([frame]), now))
        expired = [t for t in timers if t < watermark]
        for timer in expired:
            take(lane.handleExpiredTimer(("x",), now, None))
            timers.discard(timer)

    everything = sorted([(r[-1], r) for r in lines + orders] + rng.sample([(r[-1], r) for r in lines + orders], 60), key=lambda e: e[0])
    for start_at in range(0, len(everything), 40):
        part = [r for _, r in everything[start_at : start_at + 40]]
        passed = max((t for t, _ in everything[:start_at]), default=0) - 600 * second
        batch([r for r in part if len(r) == 3], [r for r in part if len(r) == 2], max(passed // 1000, 0))
    batch([(-1, -1, 9000 * second)], [(-2, 9000 * second)], 300_000)
    batch([(-3, -3, 9000 * second)], [(-4, 9000 * second)], 8_400_000)
    at = dict(orders)
    expected = [(o, i) for i, o, t in lines if o in at and abs(at[o] - t) <= 15 * second]
    assert sorted(pairs) == sorted(expected)
    met = ({o for o, _ in expected}, {i for _, i in expected})
    left_out = [(None, i) for i, _, _ in lines if i not in met[1]] + [(o, None) for o in at if o not in met[0]]
    assert sorted(alone, key=str) == sorted(left_out if outer else [], key=str)
    # What has left is not kept.
    assert sum(unpack(pack).num_rows for kept in states[:2] for (pack,) in kept.rows) == 4


def test_sets_are_renewed_and_start_anew():
    def seen(*rows):
        marks = pd.DataFrame(rows, columns=["set_key", "member_key", "seen_ms"])
        return marks.assign(until_ms=marks["seen_ms"] + 600)

    empty = pd.DataFrame({"set_key": [], "member_key": [], "until_ms": []})
    passed, sets = dedupe.renew(seen(("a", "1", 0), ("b", "1", 0), ("a", "1", 600), ("b", "1", 601), ("a", "2", 1200)), empty)
    assert passed.tolist() == [True, True, False, True, True]
    assert sorted(sets.itertuples(index=False, name=None)) == [("a", "1", 1800), ("a", "2", 1800), ("b", "1", 1201)]
    # A late sighting neither ends a life nor shortens it; a null member is one of its own.
    passed, sets = dedupe.renew(seen(("a", "1", 1000), ("b", "", 1200), ("b", "", 1300), ("a", "1", 1801)), sets)
    assert passed.tolist() == [False, True, False, True]
    assert sorted(sets.itertuples(index=False, name=None)) == [("a", "1", 2401), ("b", "", 1900), ("b", "1", 1900)]


def test_shuffles_start_from_more_partitions_where_tables_are_large(spark, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = int(spark.conf.get(key))
    try:
        tune(spark, input_bytes=1000 * PARTITION_BYTES)
        assert int(spark.conf.get(key)) == 1000
        monkeypatch.setattr("tidemart.session.PARTITION_BYTES", 100)
        QUERIES["detail_amount_split"](spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(key)) > 1000
    finally:
        tune(spark)
    assert int(spark.conf.get(key)) == before
