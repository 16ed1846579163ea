"""Rows that come after the watermark has passed them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.sources.sinks import append_batch
from tidemart.sources.tables import ensure_folder


def split_late(
    on_time: Callable[[DataFrame, int], None],
    late_path: str,
    clock_path: str,
    event_time: str,
    delay: str,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch function that hands the rows of a stream on, but for those that Spark's stateful
    operators would drop without trace: these go to a table, with `late_by`, the seconds by
    which the watermark had passed them, and `watermark`.

    The watermark of a batch is the greatest event time of all batches before it less
    `delay`, as Spark has it. The greatest time of every batch is one row of a table, so
    a restarted or repeated batch finds the same watermark and splits alike; on time and
    late are all rows of the batch. What follows behind, with the same delay, sees the rows
    on time only and has nothing left to drop. A row without event time is late by null.
    `keep` shapes the late rows before they are stored.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clock = spark.read.schema("greatest timestamp, batch_id bigint").parquet(ensure_folder(spark, clock_path))
        before = clock.where(F.col("batch_id") < batch_id).agg(F.max("greatest").alias("g"))
        passed = before.select(F.expr(f"g - INTERVAL {delay}").alias("watermark"))
        # One row, also before the first batch.
        marked = batch.join(F.broadcast(passed))
        at = F.col(event_time)
        too_late = at.isNull() | F.coalesce(at <= F.col("watermark"), F.lit(False))
        marked = marked.withColumn("_late", too_late).persist()
        try:
            on_time(marked.where(~F.col("_late")).drop("_late", "watermark"), batch_id)
            late_by = (F.unix_micros("watermark") - F.unix_micros(at)) / F.lit(1_000_000)
            rows = marked.where("_late").drop("_late").withColumn("late_by", late_by)
            append_batch(keep(rows) if keep else rows, batch_id, late_path, ())
            append_batch(marked.agg(F.max(at).alias("greatest")), batch_id, clock_path, ())
        finally:
            marked.unpersist()

    return save
