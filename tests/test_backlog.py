"""Streams that take a backlog in a few micro-batches leave little on disk."""

import random
from decimal import Decimal
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.plans.queries import QUERIES
from tidemart.session import STATE_BYTES, backlog_session
from tidemart.streaming.orders import save_sides
from tidemart.streaming.packed import pack_table, unpack

DAYS = 40


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Orders of four lines over forty days; every seventh order has none."""
    path = str(tmp_path_factory.mktemp("shop"))
    orders = spark.range(2000).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") * 7 % 300).alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        (F.col("id") * 13 % 9000 + 100.25).alias("o_totalprice"),
        F.expr(f"timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, cast(id % {DAYS} as int))").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    lines = orders.where("o_orderkey % 7 > 0").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("l_linenumber"))
    lines = lines.select(
        "l_orderkey",
        (F.col("l_orderkey") * 3 % 500).alias("l_partkey"),
        F.lit(1).cast("bigint").alias("l_suppkey"),
        "l_linenumber",
        F.lit(2.0).alias("l_quantity"),
        (F.col("l_orderkey") * 31 % 7000 + F.col("l_linenumber") + 0.5).alias("l_extendedprice"),
    )
    orders.coalesce(1).write.parquet(f"{path}/orders.parquet")
    lines.coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    return path


def on_disk(spark):
    """Files of the session's shuffles."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for top in blocks.localDirs() for f in Path(str(top)).rglob("shuffle_*.data")}


@pytest.mark.parametrize("name", ["order_wide_outer_stream", "detail_amount_stream"])
def test_a_backlog_leaves_no_shuffles_and_one_copy_of_its_state(spark, shop, monkeypatch, tmp_path, name):
    monkeypatch.setattr("tidemart.plans.queries.work_dir", lambda _, kind: str(tmp_path / f"{kind}-{random.randrange(1 << 60)}"))
    before = on_disk(spark)
    found = QUERIES[name](spark, shop)
    assert not on_disk(spark) - before
    # Four micro-batches: the state of the first two, whose rows have left, is gone.
    kept = [f.name for f in tmp_path.glob("checkpoint-*/state/*/[0-9]*/[0-9]*.*") if f.suffix != ".crc"]
    assert set(kept) == {"3.zip", "4.zip"}
    if name == "order_wide_outer_stream":
        sides = {r["side"]: r["count"] for r in found.groupBy("side").count().collect()}
        # The fourth line comes 20 seconds after its order.
        assert sides == {"both": 3 * 1714, "detail": 1714, "order": 286}
    else:
        assert found.count() == 4 * 1714
        sums = found.groupBy("order_id").agg(F.sum("final_detail_amount").alias("s"), F.max("final_total_amount").alias("t"))
        assert sums.where("s = t").count() == 1714


def test_state_partitions_grow_with_the_input(spark):
    cores = spark.sparkContext.defaultParallelism
    for size, partitions in ((0, cores), (200 * STATE_BYTES, 200)):
        assert backlog_session(spark, size).conf.get("spark.sql.shuffle.partitions") == str(partitions)


def test_both_sides_of_a_batch_are_not_cached(spark, folder, monkeypatch):
    def cached(*_):
        raise AssertionError("cached")

    wide, alone = folder("w"), folder("u")
    batch = spark.range(30).select(
        F.element_at(F.array(F.lit("both"), F.lit("detail"), F.lit("order")), (F.col("id") % 3 + 1).cast("int")).alias("side"),
        F.col("id").alias("order_id"),
        F.lit("2024-01-01").alias("dt"),
        F.lit(1).alias("copies"),
    )
    monkeypatch.setattr(type(batch), "persist", cached)
    monkeypatch.setattr(type(batch), "cache", cached)
    save_sides(wide, alone)(batch, 0)
    save_sides(wide, alone)(batch, 0)
    assert sorted(r["order_id"] for r in spark.read.parquet(wide).collect()) == list(range(0, 30, 3))
    rows = sorted((r["side"], r["order_id"]) for r in spark.read.parquet(alone).collect())
    assert rows == [("detail", i) for i in range(1, 30, 3)] + [("order", i) for i in range(2, 30, 3)]
    assert not Path(f"{alone}/_batch".removeprefix("file:")).exists()


def test_packs_are_small_and_give_back_their_rows():
    rng = np.random.default_rng(4)
    at = np.sort(rng.integers(0, 1000, 5000)) * 86_400_000_000
    cent = [Decimal(int(c)).scaleb(-2) for c in rng.integers(100, 500_000, 5000)]
    table = pa.table(
        {
            "id": pa.array(rng.permutation(100_000)[:5000], pa.int64()),
            "amount": pa.array(cent, pa.decimal128(18, 2)),
            "at": pa.array(at, pa.timestamp("us", "UTC")),
            "day": pd.Series(pd.to_datetime(at, unit="us")).dt.strftime("%Y-%m-%d"),
            "_at": at,
            "done": pa.array([None, True, False, True, False] * 1000),
            "void": pa.nulls(5000, pa.string()),
            "raw": pa.array([b"\0x", None] * 2500),
        }
    )
    held = pack_table(table)
    assert len(held) < 5000 * 9
    assert unpack(held).equals(table) and unpack(held, ["day", "id"]).column_names == ["day", "id"]
    empty = table.slice(0, 0)
    assert unpack(pack_table(empty)).equals(empty)
