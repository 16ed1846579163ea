"""Starting streams: trigger, checkpoint and sink in one place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from tidemart.functions.text import parse_marked
from tidemart.sources.sinks import append_batch

# Fixed value: the micro-batch interval of all jobs.
INTERVAL = "5 seconds"


def start(
    writer: DataStreamWriter,
    checkpoint: str,
    trigger: str = INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a stream. The checkpoint keeps offsets and state together: a restart
    continues where the last finished batch ended. `available_now` stops after the
    data that is there; one more call goes on with what came since."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    start(writer, checkpoint, available_now=True).awaitTermination()


def each_batch(df: DataFrame, save: Callable[[DataFrame, int], None], mode: str = "append") -> DataStreamWriter:
    return df.writeStream.outputMode(mode).foreachBatch(save)


# Where a record of a topic stands.
RECORD = ("topic", "arrived", "position")


def each_parsed(
    records: DataFrame,
    schema: StructType,
    save: Callable[[DataFrame, int], None],
    rejects: str,
    valid: Column | None = None,
) -> DataStreamWriter:
    """Parse the records of a topic and give each batch of typed rows, with (topic, arrived,
    position) of their records, to `save`. Records that do not parse, or are not `valid`, go
    to the table `rejects` with the same columns, their `value` and batch: by topic and
    batch, so a batch that is repeated replaces its own. Both come from one parse."""

    def run(batch: DataFrame, batch_id: int) -> None:
        marked = parse_marked(batch, schema, keep=RECORD, valid=valid).persist()
        try:
            save(marked.where("NOT rejected").select(*schema.names, *RECORD), batch_id)
            append_batch(marked.where("rejected").select(*RECORD, "value"), batch_id, rejects, ("topic",))
        finally:
            marked.unpersist()

    return each_batch(records, run)


def table_writer(df: DataFrame, path: str, partitions: list[str] | None = None) -> DataStreamWriter:
    """Append a stream to parquet files; the sink's log makes each batch count once."""
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.partitionBy(*partitions) if partitions else writer


def console_writer(df: DataFrame, rows: int = 1000) -> DataStreamWriter:
    """Print up to `rows` rows of each batch, for looking at a running job."""
    return df.writeStream.format("console").option("numRows", rows)
