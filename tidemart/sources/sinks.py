"""Sinks: topics, daily tables keyed by id, line archives.

None of them needs a table format. A table that a stream grows is a folder with
one sub-folder per day and micro-batch; writing a batch again replaces exactly its
own folders, and readers keep the newest row per key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter


def topic_rows(
    df: DataFrame, topic: str | Column, value: str | Column = "value", key: str | Column | None = None
) -> DataFrame:
    """Shape rows as topic records (topic, key, value); a string names a column."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    key_col = F.lit(None) if key is None else as_col(key)
    return df.select(
        as_col(topic).alias("topic"), key_col.cast("string").alias("key"), as_col(value).alias("value")
    )


def topic_sink(
    records: DataFrame,
    path: str | None = None,
    *,
    fmt: str = "parquet",
    servers: str | None = None,
    writer: str | None = None,
    batch_id: int = 0,
) -> DataStreamWriter | None:
    """Write topic records. A batch is written at once; a stream returns its writer,
    still to be given a checkpoint and started.

    Several jobs may write to one folder of file topics. Each keeps its batches in
    folders of its own, so a batch of a named `writer` that is written again replaces
    itself. Kafka gets such a batch twice; the joins drop repeated records.
    """
    if fmt == "kafka":
        if not servers:
            raise ValueError("a Kafka topic needs servers")
        options = {"kafka.bootstrap.servers": servers}
        if records.isStreaming:
            return records.writeStream.format("kafka").options(**options)
        records.write.format("kafka").options(**options).save()
        return None
    name = writer or uuid.uuid4().hex

    def save(batch: DataFrame, number: int) -> None:
        named = batch.withColumns({"writer": F.lit(name), "batch_id": F.lit(number).cast("bigint")})
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "topic", "writer", "batch_id"
        ).parquet(path)

    if records.isStreaming:
        if not writer:
            raise ValueError("a stream of records needs a writer name that survives a restart")
        return records.writeStream.foreachBatch(save)
    save(records, batch_id)
    return None


def latest_by_id(
    df: DataFrame, ids: Iterable[str], newest: Iterable[str] = (), oldest: Iterable[str] = ()
) -> DataFrame:
    """One row per id: the greatest by `newest`, or the least by `oldest`.

    An aggregate, not a window: copies of one id merge before the shuffle, so a
    third of all rows under one id is one row per input task.
    """
    ids, newest, oldest = list(ids), list(newest), list(oldest)
    rest = [c for c in df.columns if c not in ids]
    if not rest:
        return df.dropDuplicates(ids)
    order = oldest or newest
    lead = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    row = F.struct(*lead, *rest)
    best = F.min(row) if oldest else F.max(row)
    return df.groupBy(*ids).agg(best.alias("_r")).select(
        *[F.col(c) if c in ids else F.col(f"_r.{c}").alias(c) for c in df.columns]
    )


def by_day(df: DataFrame, *day_cols: str) -> DataFrame:
    """Gather rows by day for a partitioned write. A rebalance, not a repartition: AQE
    merges small days into one task and splits a day that is too large for one."""
    return df.hint("rebalance", *[F.col(c) for c in day_cols]) if day_cols else df


def save_by_id(
    df: DataFrame,
    path: str,
    ids: Iterable[str],
    day_col: str = "dt",
    newest: Iterable[str] = (),
    oldest: Iterable[str] = (),
    batch_id: int = 0,
) -> None:
    """Add the rows of one batch to a daily table, one row per (day, id).

    Days come from the rows, never from the clock, so a late row lands in its day. Other
    batches of a day stay; `read_grown` gives one row per id over all of them.
    """
    keys = [day_col, *[c for c in ids if c != day_col]]
    append_batch(latest_by_id(df, keys, newest, oldest), batch_id, path, (day_col,))


def append_batch(df: DataFrame, batch_id: int, path: str, partitions: Iterable[str] = ("dt",)) -> None:
    """Add one micro-batch to a growing table; the same batch again replaces itself."""
    partitions = list(partitions)
    (
        by_day(df, *partitions)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "batch_id")
        .parquet(path)
    )


def read_grown(
    spark: SparkSession,
    path: str,
    ids: Iterable[str],
    newest: Iterable[str] = ("batch_id",),
    oldest: Iterable[str] = (),
    before_batch: int | None = None,
    schema: str | None = None,
) -> DataFrame:
    """A table grown by `append_batch`, one row per id.

    `before_batch` hides that batch and later ones: a replayed batch then sees the
    table exactly as its first run did. A `schema` (with batch_id) also lets a table
    be read that has no rows yet.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    grown = reader.parquet(path)
    if "dt" in grown.columns:
        grown = grown.withColumn("dt", F.col("dt").cast("string"))
    if before_batch is not None:
        grown = grown.where(F.col("batch_id") < before_batch)
    return latest_by_id(grown, ids, newest, oldest).drop("batch_id")


def compact_grown(
    spark: SparkSession,
    path: str,
    target: str,
    ids: Iterable[str],
    before_batch: int,
    partitions: Iterable[str] = ("dt",),
    newest: Iterable[str] = ("batch_id",),
    oldest: Iterable[str] = (),
) -> None:
    """Copy a grown table to a new folder with its finished batches merged into one.

    Run it between two runs of the job that writes the table, with the number of the
    job's next batch, and give the job the new folder: fewer files, same rows.
    """
    grown = spark.read.parquet(path)
    done = latest_by_id(grown.where(F.col("batch_id") < before_batch), ids, newest, oldest)
    merged = done.withColumn("batch_id", F.lit(before_batch - 1).cast("bigint"))
    partitions = list(partitions)
    (
        by_day(merged.unionByName(grown.where(F.col("batch_id") >= before_batch)), *partitions)
        .write.partitionBy(*partitions, "batch_id")
        .parquet(target)
    )


def archive_lines(
    df: DataFrame, path: str, day_col: str = "dt", line_col: str = "value", batch_id: int = 0
) -> None:
    """Add the raw lines of one batch as text, one folder per day and batch."""
    lines = df.select(day_col, F.col(line_col).alias("value"))
    by_day(lines, day_col).withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(day_col, "batch_id").text(path)


def store_order_wide(wide: DataFrame, path: str, batch_id: int = 0) -> DataStreamWriter | None:
    """Add wide rows for the amount queries: a folder per month, rows in order of their day,
    so that a load of many years makes few files and a day is still read from a few row
    groups of one folder (`read_day`). A batch is written at once, beside the other batches
    of its months; a stream returns its writer, still to be given a checkpoint and started."""
    dated = wide.withColumn("month", F.substring("dt", 1, 7))
    if wide.isStreaming:
        return dated.writeStream.format("parquet").partitionBy("month").option("path", path)
    rows = by_day(dated, "month").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    (
        rows.sortWithinPartitions("month", "batch_id", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "batch_id")
        .parquet(path)
    )
    return None
