"""Streams that settle: rows without partner, line shares, renewed sets, late rows, rejects,
offsets, and tables kept by key."""

import itertools
import json
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_streams import NOON, detail_rows, feed, order_rows, same
from tidemart import schemas
from tidemart.functions.text import parse_marked
from tidemart.operators.pages import ranged_page, store_ranges
from tidemart.operators.wide import split_amount
from tidemart.session import state_session
from tidemart.sources import offsets, sinks
from tidemart.sources.keyed import KeyedTable
from tidemart.sources.tables import read_day
from tidemart.sources.topics import kafka_options, topic_source
from tidemart.sources.rollup import RollUp
from tidemart.streaming import shares
from tidemart.streaming.dedupe import dedupe_renewed
from tidemart.streaming.jobs import each_batch, each_parsed, run_available, start, table_writer
from tidemart.streaming.late import split_late
from tidemart.streaming.orders import (
    join_order_detail,
    outer_join_order_detail,
    save_first_orders,
    save_sides,
    without_partner,
)

FAR = "2030-01-01 00:00:00"


@pytest.fixture(scope="module")
def stateful(spark):
    return state_session(spark, 2)


def at(seconds):
    return str(pd.Timestamp(NOON) + pd.Timedelta(seconds=seconds))


def order_topics(spark):
    """Three batches: early and late partners, records sent again, a hot order, rows alone."""
    orders = [
        order_rows(spark, (1, NOON), (5, NOON)),
        order_rows(spark, (2, NOON), (1, NOON), (6, at(30))),
        order_rows(spark, (-1, FAR)),
    ]
    details = [
        detail_rows(spark, (20, 2, at(-5)), (90, 9, NOON), *[(100 + i, 1, at(1)) for i in range(20)]),
        detail_rows(spark, (10, 1, at(10)), (20, 2, at(-5)), (11, 1, at(20)), (60, 6, at(10))),
        detail_rows(spark, (-2, -2, FAR)),
    ]
    return orders, details


def whole(batches):
    out = batches[0]
    for b in batches[1:]:
        out = out.unionAll(b)
    return out


def sides_of(rows):
    return sorted((r["side"], r["order_id"], r["order_detail_id"]) for r in rows.select("side", "order_id", "order_detail_id").collect())


@pytest.mark.parametrize("salts", [1, 4])
def test_rows_without_partner_leave_with_the_watermark(spark, stateful, folder, salts):
    orders, details = order_topics(spark)
    topics, pairs, alone, checkpoint = (folder("o"), folder("d")), folder("w"), folder("u"), folder("cp")
    for a, b in zip(orders, details):  # a restart before each batch
        sides = outer_join_order_detail(feed(stateful, topics[0], [a]), feed(stateful, topics[1], [b]), salts=salts)
        run_available(each_batch(sides, save_sides(pairs, alone)), checkpoint)
    batch = outer_join_order_detail(whole(orders[:2]), whole(details[:2]))
    expected = sides_of(batch)
    assert [r for r in expected if r[0] != "both"] == [("detail", 1, 11), ("detail", 6, 60), ("detail", 9, 90), ("order", 5, 0), ("order", 6, 0)]
    streamed = spark.read.parquet(pairs).withColumn("side", F.lit("both"))
    assert sorted(sides_of(streamed) + sides_of(spark.read.parquet(alone))) == expected
    assert sides_of(without_partner(batch)) == [r for r in expected if r[0] != "both"]


@pytest.mark.parametrize("chunk", [3, 10_000])
def test_streamed_shares_equal_the_batch(spark, stateful, folder, monkeypatch, chunk):
    monkeypatch.setattr(shares, "CHUNK", chunk)
    rng = random.Random(5)
    amounts = {1: "100.01", 2: "-7.00", 3: "0.05", 4: "9.99"}
    orders = spark.createDataFrame([(i, 9, Decimal(a), NOON) for i, a in amounts.items()], "id bigint, user_id bigint, final_total_amount decimal(18,2), t string")
    orders = orders.select("id", "user_id", "final_total_amount", F.col("t").cast("timestamp").alias("order_ts"))
    prices = [(i, 1 + i % 3, Decimal(rng.randint(1, 9999)) / 100, at(i % 7)) for i in range(60)]
    prices += [(100, 4, Decimal("0.00"), at(1)), (101, 4, Decimal("0.00"), at(2))]
    lines = spark.createDataFrame(prices, "id bigint, order_id bigint, order_price decimal(18,2), t string")
    lines = lines.select("id", "order_id", "order_price", F.col("t").cast("timestamp").alias("detail_ts"))
    far_order, far_line = order_rows(spark, (-1, FAR)), detail_rows(spark, (-2, -2, FAR))
    order_parts = [orders.where("id < 3"), orders.where("id >= 3"), far_order]
    line_parts = [lines.where("id % 2 = 0"), lines.where("id % 2 = 1"), far_line]
    topics, out, checkpoint = (folder("o"), folder("d")), folder("w"), folder("cp")
    for a, b in zip(order_parts, line_parts):
        joined = join_order_detail(feed(stateful, topics[0], [a]), feed(stateful, topics[1], [b]))
        run_available(sinks.store_order_wide(shares.split_amount_stream(joined), out), checkpoint)
    batch = join_order_detail(orders, lines)
    expected = split_amount(batch, "final_total_amount", "sku_price", "order_id", ["detail_ts", "order_detail_id"])
    columns = ["order_id", "order_detail_id", "sku_price", "final_total_amount", "final_detail_amount"]
    streamed = spark.read.parquet(out)
    assert same(streamed.select(columns), expected.select(columns))
    sums = streamed.groupBy("order_id").agg(F.sum("final_detail_amount").alias("s")).collect()
    assert {r["order_id"]: r["s"] for r in sums} == {i: Decimal(a) for i, a in amounts.items()}


def test_every_sighting_renews_the_life_of_a_set(spark, stateful, folder):
    """Seen every 500 seconds: suppressed. Silent for 601: passes again. Other orders and
    members of the set count as the set's rule says."""
    topic, out, checkpoint = folder("t"), folder("o"), folder("cp")
    batches = [
        [(1, 1, 0), (7, 2, 0), (1, 1, 0), (7, 2, 600)],
        [(1, 1, 500), (2, 1, 900)],
        [(1, 1, 1000), (1, 1, 1500), (7, 2, 1201)],
        [(1, 1, 2101), (2, 1, 2101), (3, 1, 2101), (7, 2, 1900)],
    ]
    for rows in batches:
        part = detail_rows(spark, *[(i, o, at(s)) for i, o, s in rows])
        unique = dedupe_renewed(feed(stateful, topic, [part]), "order_id", "id", "detail_ts", delay="2 hours")
        run_available(table_writer(unique, out), checkpoint)
    got = spark.read.parquet(out).collect()
    seen = sorted((r["id"], r["order_id"], (r["detail_ts"] - pd.Timestamp(NOON)).seconds) for r in got)
    # 7: silent from 600 to 1201, 601 seconds; and from 1201 to 1900.
    assert seen == sorted([(1, 1, 0), (2, 1, 900), (1, 1, 2101), (2, 1, 2101), (3, 1, 2101), (7, 2, 0), (7, 2, 1201), (7, 2, 1900)])


def test_the_state_of_a_silent_set_is_dropped(spark, stateful, folder):
    topic, out, checkpoint = folder("t"), folder("o"), folder("cp")
    for rows in ([(1, 1, NOON), (2, 1, NOON)], [(9, 9, FAR)], [(1, 1, FAR)]):
        unique = dedupe_renewed(feed(stateful, topic, [detail_rows(spark, *rows)]), "order_id", "id", "detail_ts")
        query = start(table_writer(unique, out), checkpoint, available_now=True)
        query.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 1, 2, 9]


def test_on_time_and_late_are_all_rows(spark, stateful, folder):
    topic, on_time, late, clock, checkpoint = (folder(n) for n in ("t", "on", "late", "clock", "cp"))
    batches = [
        [(1, 0, at(0)), (2, 0, at(-9000))],  # no watermark yet
        [(3, 0, at(-600)), (4, 0, at(-599)), (5, 0, at(9000))],
        [(6, 0, at(8400)), (7, 0, at(8401)), (8, 0, at(100)), (9, 0, None)],
    ]
    save = split_late(lambda rows, n: sinks.append_batch(rows, n, on_time, ()), late, clock, "detail_ts", "600 seconds")
    parts = [detail_rows(spark, *rows) for rows in batches]
    for part in parts:
        run_available(each_batch(feed(stateful, topic, [part]), save), checkpoint)

    def found():
        return (
            sorted(r["id"] for r in spark.read.parquet(on_time).collect()),
            {r["id"]: r["late_by"] for r in spark.read.parquet(late).collect()},
        )

    expected = ([1, 2, 4, 5, 7], {3: 0.0, 6: 0.0, 8: 8300.0, 9: None})
    assert found() == expected
    save(parts[1], 1)  # repeated after later batches
    assert found() == expected


def test_rejects_are_kept_once_also_after_a_replay(spark, stateful, folder):
    topics, good, bad, checkpoint = (folder(n) for n in ("t", "good", "bad", "cp"))
    lines = [['{"id":1,"user_id":2}', "{", None], ['{"id":3}', "[1", '{"id":"x"}', ""]]
    shape = schemas.struct(id=schemas.LONG, user_id=schemas.LONG)
    batches = []

    def save(rows, batch_id):
        sinks.append_batch(rows, batch_id, good, ())

    for part in lines:
        rows = spark.createDataFrame([(v,) for v in part], "value string")
        sinks.topic_sink(sinks.topic_rows(rows, F.lit("T")), topics)
        source = topic_source(stateful, "T", path=topics)
        run_available(each_parsed(source, shape, save, bad), checkpoint)
        batches.append(rows)

    def found():
        return (
            sorted(r["id"] for r in spark.read.parquet(good).collect()),
            sorted((r["batch_id"], r["value"] or "") for r in spark.read.parquet(bad).collect()),
        )

    first = found()
    assert first[0] == [1, 3]
    assert first[1] == [(0, ""), (0, "{"), (1, ""), (1, "[1"), (1, '{"id":"x"}')]
    # The second batch once more: the job is given its own records again.
    record = topic_source(spark, "T", path=topics, stream=False)
    again = record.where(F.col("value").isin(lines[1]))
    marked = parse_marked(again, shape, keep=("topic", "arrived", "position"))
    sinks.append_batch(marked.where("rejected").select("topic", "arrived", "position", "value"), 1, bad, ("topic",))
    assert found()[1] == first[1]


def test_offsets_are_those_the_query_reports(spark, stateful, folder):
    topics, out, table, checkpoint = (folder(n) for n in ("t", "o", "off", "cp"))
    assert offsets.stored_offsets(spark, table, "T", "g") == {}
    reported = []
    for n in (3, 5):
        rows = spark.range(n).select(F.col("id").cast("string").alias("value"))
        sinks.topic_sink(sinks.topic_rows(rows, F.lit("T")), topics)
        query = start(table_writer(topic_source(stateful, "T", path=topics), out), checkpoint, available_now=True)
        query.awaitTermination()
        offsets.save_query_offsets(spark, query, "g", table)
        offsets.save_query_offsets(spark, query, "g", table)  # reported twice, stored once
        for report in (json.loads(p.json) for p in query.recentProgress):
            source = report["sources"][0]
            reported.append((report["batchId"], source["endOffset"]["logOffset"], source["numInputRows"]))
    stored = sorted((r["batch_id"], r["offset"], r["n_rows"]) for r in offsets.read_offsets(spark, table).collect())
    assert stored == sorted(reported) and [n for _, _, n in stored] == [3, 5]
    assert offsets.stored_offsets(spark, table, "T", "g") == {0: stored[-1][1]}


def test_a_kafka_job_starts_where_its_group_ended(spark, folder):
    table = folder("off")
    report = lambda batch, ends: {
        "batchId": batch,
        "sources": [{"description": "KafkaV2[Subscribe[ORDERS]]", "endOffset": ends, "numInputRows": 7}],
    }
    for batch, ends in ((0, {"ORDERS": {"0": 5, "1": 2}}), (1, '{"ORDERS": {"0": 9, "1": 2}}')):
        offsets.save_offsets(spark, offsets.progress_offsets(report(batch, ends), "g"), table)
    start_at = offsets.stored_offsets(spark, table, "ORDERS", "g")
    assert kafka_options("ORDERS", "h:1", start_at)["startingOffsets"] == '{"ORDERS": {"0": 9, "1": 2}}'
    assert offsets.stored_offsets(spark, table, "ORDERS", "other") == {}


# Tables by key ---------------------------------------------------------------------------

SHAPE = schemas.struct(id=schemas.TEXT, name=schemas.TEXT, version=schemas.LONG)


def keyed_rows(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def content(table, spark):
    return sorted((r["id"], r["name"], r["version"]) for r in table.read(spark).collect())


def test_keyed_table_keeps_the_newest_and_survives_replays_and_restarts(spark, folder):
    path = folder("k")
    table = KeyedTable(path, SHAPE, ["id"], newest=["version"], buckets=8)
    assert content(table, spark) == []
    batches = [[("a", "a1", 1), ("b", "b3", 3)], [("a", "a2", 2), ("b", "b1", 1), ("c", None, None)], []]
    for number, rows in enumerate(batches):
        table.save(keyed_rows(spark, rows), number)
    expected = [("a", "a2", 2), ("b", "b3", 3), ("c", None, None)]
    assert content(table, spark) == expected
    table.save(keyed_rows(spark, batches[0]), 0)
    again = KeyedTable(path, SHAPE, ["id"], newest=["version"], buckets=8)
    again.save(keyed_rows(spark, batches[1]), 1)
    assert content(again, spark) == expected


def test_buckets_lost_while_they_were_replaced_come_back(spark, folder):
    path = folder("k")
    table = KeyedTable(path, SHAPE, ["id"], newest=["version"], buckets=2)
    table.save(keyed_rows(spark, [(f"k{i}", "x", i) for i in range(20)]), 0)
    table.save(keyed_rows(spark, [("k1", "y", 100)]), 1)
    expected = content(table, spark)
    # The folder of the key is gone, as if the driver had ended between removing and renaming.
    bucket = spark.read.parquet(f"{path}/rows").where("id = 'k1'").first()["bucket"]
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows/bucket={bucket}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    KeyedTable(path, SHAPE, ["id"], newest=["version"], buckets=2).save(keyed_rows(spark, [("k1", "y", 100)]), 1)
    assert content(table, spark) == expected


def bytes_read(spark, df):
    """Bytes of the files of the partitions that the plan reads."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    return df.select(F.input_file_name().alias("f")).distinct().count()


def test_a_batch_reads_the_buckets_of_its_keys(spark, folder):
    path = folder("k")
    table = KeyedTable(path, SHAPE, ["id"], newest=["version"], buckets=32)
    table.save(keyed_rows(spark, [(f"k{i}", "x", i) for i in range(500)]), 0)
    files = [bytes_read(spark, table.read_for(keyed_rows(spark, [(f"k{i}", None, 0) for i in range(n)]))) for n in (1, 4, 500)]
    assert files[0] == 1 and files[0] < files[1] <= 4 < files[2] == 32
    found = table.read_for(keyed_rows(spark, [("k7", None, 0)])).where("id = 'k7'").collect()
    assert [(r["name"], r["version"], r["batch_id"]) for r in found] == [("x", 7, 0)]


def test_an_untouched_bucket_is_not_written_again(spark, folder):
    path = folder("k")
    table = KeyedTable(path, SHAPE, ["id"], newest=["version"], buckets=32)
    table.save(keyed_rows(spark, [(f"k{i}", "x", i) for i in range(500)]), 0)
    files = lambda: {r["f"] for r in spark.read.parquet(f"{path}/rows").select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    table.save(keyed_rows(spark, [("k1", "y", 1000), ("k2", "y", 1000)]), 1)
    assert len(before & files()) >= 30


def test_first_orders_read_the_state_of_their_users_only(spark, folder):
    orders, state = folder("o"), folder("s")
    schema = "id bigint, user_id bigint, create_time string"
    save = save_first_orders(orders, state)
    save(spark.createDataFrame([(i, i, "2024-01-01 00:00:00") for i in range(300)], schema), 0)
    kept = KeyedTable(state, schemas.USER_FIRST_ORDER, ["user_id"], oldest=["batch_id"])
    users = spark.createDataFrame([("5",), ("6",)], "user_id string")
    assert bytes_read(spark, kept.read_for(users)) <= 2
    save(spark.createDataFrame([(900, 5, "2024-01-02 00:00:00"), (901, 999, "2024-01-02 00:00:00")], schema), 1)
    rows = spark.read.parquet(orders).where("id >= 900").collect()
    assert {r["id"]: r["if_first_order"] for r in rows} == {900: "0", 901: "1"}


def test_days_of_the_wide_table_are_read_from_their_month(spark, folder):
    path = folder("w")
    days = [f"1998-{m:02d}-{d:02d}" for m, d in itertools.product(range(1, 13), (1, 15, 28))]
    rows = spark.createDataFrame([(d, i, Decimal(i)) for i, d in enumerate(days)], "dt string, order_id bigint, final_detail_amount decimal(18,2)")
    sinks.store_order_wide(rows, path)
    sinks.store_order_wide(rows, path)  # the same batch again
    found = read_day(spark, path, "1998-03-01", prev_days=1)
    assert sorted(r["dt"] for r in found.collect()) == ["1998-02-28", "1998-03-01"]
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in filters and "1998-03" in filters
    assert spark.read.parquet(path).count() == len(days)


# Roll-ups and pages ------------------------------------------------------------------------


def rolled(table, spark):
    rows = table.read(spark).collect()
    return {(r["dt"], r["hr"]): (r["n"], r["amount"]) for r in rows}


def test_roll_up_of_first_sightings_follows_late_and_repeated_batches(spark, folder):
    schema = "mid string, dt string, hr string, ts bigint"
    table = RollUp(folder("r"), ["mid", "dt"], schemas.LONG, oldest="ts")
    rng = random.Random(2)
    batches = [[(f"m{rng.randint(0, 9)}", f"d{rng.randint(1, 3)}", f"{(t := rng.randint(0, 23)):02d}", t) for _ in range(40)] for _ in range(4)]
    parts = [spark.createDataFrame(rows, schema).withColumn("amount", F.lit(1)) for rows in batches]
    for number, part in enumerate(parts):
        table.save(part, number)
        table.save(part, number)  # every batch twice
        first = {}
        for mid, dt, _, ts in sum(batches[: number + 1], []):
            first[mid, dt] = min(ts, first.get((mid, dt), ts))
        expected = {}
        for (_, dt), ts in first.items():
            n = expected.get((dt, f"{ts:02d}"), (0, 0))[0] + 1
            expected[dt, f"{ts:02d}"] = (n, n)
        assert rolled(table, spark) == expected


def test_roll_up_retracts_what_a_correction_replaces(spark, folder):
    schema = "id bigint, dt string, hr string, version bigint, amount decimal(18,2)"
    table = RollUp(folder("r"), ["id"], schemas.MONEY, newest="version")
    rows = lambda *r: spark.createDataFrame([(i, d, h, v, Decimal(a)) for i, d, h, v, a in r], schema)
    table.save(rows((1, "d1", "00", 1, "5.00"), (2, "d1", "00", 1, "7.50"), (2, "d1", "00", 0, "1.00")), 0)
    assert rolled(table, spark) == {("d1", "00"): (2, Decimal("12.50"))}
    correction = rows((1, "d2", "03", 2, "6.00"), (3, "d1", "00", 1, "1.00"), (2, "d1", "00", 0, "99.00"))
    for _ in range(2):
        table.save(correction, 1)
        assert rolled(table, spark) == {("d1", "00"): (2, Decimal("8.50")), ("d2", "03"): (1, Decimal("6.00"))}
    table.save(rows((2, "d3", "00", 5, "0.00"), (3, "d3", "00", 5, "0.00")), 2)
    assert rolled(table, spark) == {("d2", "03"): (1, Decimal("6.00")), ("d3", "00"): (2, Decimal("0.00"))}


@pytest.mark.parametrize("n", [0, 1, 257])
def test_deep_pages_open_the_ranges_they_need(spark, folder, n):
    rng = random.Random(n)
    rows = [(i, "hot" if rng.random() < 0.4 else f"n{rng.randint(0, 50)}") for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, name string")
    path = folder("p")
    store_ranges(df, path, [F.desc("name"), "id"], ranges=8)
    ordered = sorted(rows, key=lambda r: (r[1], -r[0]), reverse=True)
    for offset, limit in ((0, 20), (100, 20), (250, 20), (300, 20), (0, 257), (5, 0)):
        page = ranged_page(spark, path, [F.desc("name"), "id"], offset, limit)
        assert [(r["id"], r["name"]) for r in page.collect()] == ordered[offset : offset + limit]
    if n > 200:
        page = ranged_page(spark, path, [F.desc("name"), "id"], 200, 20)
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan
        opened = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert opened.count(",") <= 3  # one or two of eight ranges
