"""Sinks, day reads, skewed joins and the working folder."""

import pytest
from pyspark.sql import functions as F

from tidemart.operators.dimensions import enrich
from tidemart.operators.first_order import first_order_flag
from tidemart.plans.queries import QUERIES
from tidemart.session import work_dir
from tidemart.sources import sinks
from tidemart.sources.tables import between_days, read_day, read_table, stream_table
from tidemart.sources.topics import topic_source


def day_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "dt string, id bigint, v bigint")


def stored(spark, path):
    return sorted((str(r.dt), r.id, r.v) for r in spark.read.parquet(path).select("dt", "id", "v").collect())


def test_saves_of_a_day_add_up_and_replays_replace_themselves(spark, folder):
    path = folder("index")
    grown = lambda: sorted((r.dt, r.id, r.v) for r in sinks.read_grown(spark, path, ["dt", "id"]).collect())
    first = day_rows(spark, ("2024-01-01", 1, 1), ("2024-01-01", 1, 2), ("2024-01-02", 1, 5))
    sinks.save_by_id(first, path, ["id"], newest=["v"])
    assert grown() == [("2024-01-01", 1, 2), ("2024-01-02", 1, 5)]
    again = day_rows(spark, ("2024-01-02", 1, 6), ("2024-01-02", 2, 7))
    for _ in range(2):
        sinks.save_by_id(again, path, ["id"], newest=["v"], batch_id=1)
        assert grown() == [("2024-01-01", 1, 2), ("2024-01-02", 1, 6), ("2024-01-02", 2, 7)]
    sinks.save_by_id(again.limit(0), path, ["id"], newest=["v"], batch_id=2)
    assert len(grown()) == 3


def test_batches_replace_themselves_and_can_be_hidden(spark, folder):
    path = folder("grown")
    for batch in (0, 1, 1):
        sinks.append_batch(day_rows(spark, ("2024-01-01", 1, batch), ("2024-01-01", 2 + batch, 0)), batch, path)
    now = sinks.read_grown(spark, path, ["dt", "id"])
    assert sorted((r.dt, r.id, r.v) for r in now.collect()) == [
        ("2024-01-01", 1, 1), ("2024-01-01", 2, 0), ("2024-01-01", 3, 0),
    ]
    before = sinks.read_grown(spark, path, ["dt", "id"], before_batch=1)
    assert sorted((r.id, r.v) for r in before.collect()) == [(1, 0), (2, 0)]


def test_compacting_keeps_the_rows_in_fewer_folders(spark, folder):
    path, target = folder("grown"), folder("compact")
    for batch in range(4):
        sinks.append_batch(day_rows(spark, ("2024-01-01", 1, batch), ("2024-01-01", 10 + batch, 0)), batch, path)
    sinks.compact_grown(spark, path, target, ["dt", "id"], before_batch=3)
    rows = lambda p, **kw: sorted(tuple(r) for r in sinks.read_grown(spark, p, ["dt", "id"], **kw).select("dt", "id", "v").collect())
    assert rows(target) == rows(path)
    assert rows(target, before_batch=3) == rows(path, before_batch=3)
    assert {r.batch_id for r in spark.read.parquet(target).select("batch_id").distinct().collect()} == {2, 3}
    # The job goes on with its next batch, also when it repeats the last one.
    for batch in (3, 4):
        sinks.append_batch(day_rows(spark, ("2024-01-01", 1, 100 + batch)), batch, target)
    assert ("2024-01-01", 1, 104) in rows(target)


def test_day_reads_prune_partitions(spark, folder):
    path = folder("days")
    sinks.append_batch(day_rows(spark, *[(f"2024-01-0{d}", d, d) for d in range(1, 6)]), 0, path)
    two = read_day(spark, path, "2024-01-03", prev_days=1)
    assert sorted(r.id for r in two.collect()) == [2, 3]
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cast(dt" in plan and len(two.inputFiles()) >= 2
    with pytest.raises(ValueError):
        read_day(spark, path, "03.01.2024")


def test_day_range_reaches_the_scan(spark):
    events = between_days(read_table(spark, "/root/testdata/sf0.001", "events"), "ts", "2024-01-02", "2024-01-03")
    plan = events.groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    days = {r.d for r in events.select(F.to_date("ts").cast("string").alias("d")).collect()}
    assert days == {"2024-01-02", "2024-01-03"}


def test_file_topics_need_their_settings(spark):
    with pytest.raises(ValueError):
        topic_source(spark, "t")
    with pytest.raises(ValueError):
        topic_source(spark, "t", fmt="kafka")
    with pytest.raises(ValueError):
        sinks.topic_sink(spark.range(1), fmt="kafka")


def test_topic_round_trip_in_batch(spark, folder):
    path = folder("topics")
    rows = spark.createDataFrame([("a", "k", "1"), ("b", None, "2")], "topic string, key string, value string")
    sinks.topic_sink(sinks.topic_rows(rows, "topic", "value", "key"), path)
    got = topic_source(spark, "a", path=path, stream=False).collect()
    assert [(r.key, r.value, r.topic, r.position) for r in got] == [("k", "1", "a", 0)]
    assert got[0].arrived is not None


def test_jobs_share_a_folder_of_topics_and_replace_their_batches(spark, folder):
    path = folder("topics")
    rows = spark.createDataFrame([("a", None, "1")], "topic string, key string, value string")
    for writer, batch in (("x", 0), ("x", 0), ("x", 1), ("y", 0)):
        sinks.topic_sink(rows, path, writer=writer, batch_id=batch)
    assert topic_source(spark, "a", path=path, stream=False).count() == 3
    assert topic_source(spark, "nothing yet", path=path, stream=False).count() == 0


def test_table_streams_from_one_file_or_a_folder(spark, folder):
    one = stream_table(spark, "/root/testdata/sf0.001", "nation")
    assert one.isStreaming and one.columns == ["n_nationkey", "n_name", "n_regionkey"]
    base = folder("tables")
    spark.range(5).write.parquet(f"{base}/numbers.parquet")
    assert stream_table(spark, base, "numbers").isStreaming


def test_working_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = work_dir(spark, "x")
    assert path != work_dir(spark, "x")
    if root:
        assert path.startswith(root.rstrip("/") + "/x-")


@pytest.fixture
def skewed(spark):
    """Small thresholds, so that a test's skew looks like a cluster's."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lookup_splits_a_hot_key(skewed):
    """A third of the facts under one key: the join is split, the result is whole."""
    fact = skewed.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k")
    )
    dim = skewed.range(997).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("v"))
    rich = enrich(fact, dim, {"k": "key"}, {"v": "v"})
    rows = rich.groupBy().agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.sum("k").alias("k"))
    joined = rich.select("id", "v")
    joined.write.format("noop").mode("overwrite").save()
    assert len(joined.collect()) == 60_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    r = rows.first()
    assert r.n == 60_000 and r.s == 2 * r.k


def test_first_orders_of_a_hot_user_need_no_hot_shuffle(skewed):
    """The user's orders merge before the shuffle and are found again by order id."""
    orders = skewed.range(0, 60_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"),
        F.lit("2024-01-01 00:00:00").alias("create_time"),
    )
    flagged = first_order_flag(orders)
    assert flagged.where("user_id = 0 and if_first_order = '1'").count() == 1
    assert flagged.where("if_first_order = '1'").count() == 40_001
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and "partial_min" in plan and "Window" not in plan


def test_no_plan_gathers_rows_in_one_task(spark):
    """Only counts of whole tables meet in one partition: partial sums, never rows."""
    for name in ("order_wide", "dau_first_log", "first_order_flag", "detail_amount_split", "realtime_total"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
