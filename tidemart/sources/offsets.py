"""Offsets of a stream as data: what each batch of a job has read, and where to start."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemart.sources.tables import ensure_folder

OFFSETS = "topic string, group_id string, batch_id bigint, part int, offset bigint, n_rows bigint"
_FOLDERS = "part int, offset bigint, n_rows bigint, topic string, group_id string, batch_id bigint"


def progress_offsets(progress: dict[str, Any], group: str) -> list[tuple]:
    """(topic, group, batch, partition, end offset, rows of the topic) of one progress report.
    A file topic has one partition, whose offset counts its batches of files."""
    out = []
    for source in progress["sources"]:
        end = source["endOffset"]
        end = json.loads(end) if isinstance(end, str) else end
        if not end:
            continue
        if "logOffset" in end:
            found = re.search(r"topic=([^/\]]+)", source["description"])
            end = {found[1] if found else source["description"]: {"0": end["logOffset"]}}
        for topic, parts in end.items():
            for part, offset in parts.items():
                out.append((topic, group, progress["batchId"], int(part), int(offset), source["numInputRows"]))
    return out


def save_offsets(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Add end offsets; those of a batch that is reported again replace themselves."""
    if rows:
        spark.createDataFrame(rows, OFFSETS).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("topic", "group_id", "batch_id").parquet(path)


def save_query_offsets(spark: SparkSession, query: StreamingQuery, group: str, path: str) -> None:
    """Store the offsets of the batches a query has reported. A batch is reported when its
    sink is done, so no offset is stored for rows that are not."""
    reports = [json.loads(p.json) for p in query.recentProgress]
    # A batch without new data repeats the offsets of the one before.
    save_offsets(spark, [row for p in reports for row in progress_offsets(p, group)], path)


class OffsetListener(StreamingQueryListener):
    """Stores the offsets of a running job after each of its batches."""

    def __init__(self, spark: SparkSession, names: Iterable[str], path: str) -> None:
        self._spark, self._names, self._path = spark, set(names), path

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        # The name of a query is the group it reads as.
        if event.progress.name in self._names:
            report = json.loads(event.progress.json)
            save_offsets(self._spark, progress_offsets(report, event.progress.name), self._path)

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_FOLDERS).parquet(ensure_folder(spark, path)).select(
        "topic", "group_id", "batch_id", "part", "offset", "n_rows"
    )


def stored_offsets(spark: SparkSession, path: str, topic: str, group: str) -> dict[int, int]:
    """The next offset per partition of a topic, as `kafka_options` takes it; empty if the
    group has read nothing yet."""
    own = read_offsets(spark, path).where((F.col("topic") == topic) & (F.col("group_id") == group))
    last = own.groupBy("part").agg(F.max_by("offset", "batch_id").alias("offset"))
    return {r["part"]: r["offset"] for r in last.collect()}
