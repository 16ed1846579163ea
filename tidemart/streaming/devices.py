"""Daily devices from an endless log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.devices import LOG_FIELDS, dau_info
from tidemart.sources.sinks import append_batch
from tidemart.streaming.dedupe import dedupe_stream

DAU_KEYS = ("dt", "mid")


def dau_stream(
    logs: DataFrame, event_time: str = "event_time", delay: str = "1 day", day_start: str = "0 seconds"
) -> DataFrame:
    """The first log of each device and day, for output mode `update`.

    A streaming `min` rather than a stateful filter: each input task keeps one row
    per device before the shuffle, so a device with a third of all logs costs one
    row per task, and a log that arrives late but happened earlier still wins. A
    device's row is sent again when its day gets more logs; the sink keeps one.
    State of a day is dropped `delay` after its end. Days follow `day_start`, the
    offset of local midnight from UTC midnight.
    """
    day = F.window(event_time, "1 day", startTime=day_start)
    first = (
        logs.withWatermark(event_time, delay)
        .groupBy(day, "mid")
        .agg(F.min(F.struct("ts", "log_id", *LOG_FIELDS)).alias("_f"))
    )
    return dau_info(first.select("mid", "_f.*"))


def first_log_dedupe(
    logs: DataFrame, event_time: str = "event_time", delay: str = "1 day", salts: int = 1
) -> DataFrame:
    """The first arriving log of each device and day, for output mode `append`: a row
    leaves at once and never again. One day of delay covers the whole day of a key."""
    dated = logs.withColumn("dt", F.to_date(event_time).cast("string"))
    unique = dedupe_stream(dated, ["mid", "dt"], event_time, delay, salts)
    return dau_info(unique)


def save_dau(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function for `dau_stream`; read with `read_grown(..., oldest=['ts'])`."""
    return lambda batch, batch_id: append_batch(batch, batch_id, path)
