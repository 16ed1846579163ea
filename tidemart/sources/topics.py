"""Topics: Kafka on a cluster, folders of parquet files where there is no broker."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.schemas import TOPIC_RECORD
from tidemart.sources.tables import ensure_folder


def kafka_options(
    topic: str, servers: str, starting: str | dict[int, int] = "latest"
) -> dict[str, str]:
    """Reader options. `starting` is 'latest', 'earliest' or an offset per partition;
    it only counts for the first start, afterwards the checkpoint decides."""
    if isinstance(starting, dict):
        starting = json.dumps({topic: {str(p): o for p, o in sorted(starting.items())}})
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def topic_source(
    spark: SparkSession,
    topic: str,
    *,
    fmt: str = "parquet",
    path: str | None = None,
    servers: str | None = None,
    starting: str | dict[int, int] = "latest",
    stream: bool = True,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Records of a topic as (key, value, topic, arrived, position).

    `arrived` and `position` order the records of one key as they came: time and
    offset of a Kafka record, or file time and row number. `fmt='kafka'` needs
    `servers`; `fmt='parquet'` reads the folder that `topic_sink` wrote, where a new
    stream always begins with the oldest file.
    """
    if fmt == "kafka":
        if not servers:
            raise ValueError("a Kafka topic needs servers")
        reader = spark.readStream if stream else spark.read
        # A batch read of Kafka has no 'latest'.
        first = "earliest" if not stream and starting == "latest" else starting
        raw = reader.format("kafka").options(**kafka_options(topic, servers, first)).load()
        return raw.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            F.col("timestamp").alias("arrived"),
            F.col("offset").alias("position"),
        )
    if not path:
        raise ValueError("a file topic needs a path")
    reader = (spark.readStream if stream else spark.read).schema(TOPIC_RECORD)
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(ensure_folder(spark, f"{path}/topic={topic}")).select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.row_index").alias("position"),
    )
