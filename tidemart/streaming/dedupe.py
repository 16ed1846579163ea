"""Dropping repeated records of a stream."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tidemart.streaming.packed import pack, unpack


def _first_of_batch(keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = pa.table({**{f"k{i}": batch.column(k) for i, k in enumerate(keys)}, "at": range(batch.num_rows)})
            first = named.group_by([f"k{i}" for i in range(len(keys))]).aggregate([("at", "min")])
            yield batch.take(first["at_min"].combine_chunks().sort()) if batch.num_rows else batch

    return run


def dedupe_stream(
    df: DataFrame, keys: Iterable[str], event_time: str, delay: str, salts: int = 1
) -> DataFrame:
    """The first record seen per key; a key is remembered until the watermark passes
    its first event time plus `delay`.

    Copies that lie in one Arrow batch are dropped where they are read, without state, so
    of a record that a third of all rows repeat one row a batch is shuffled. With `salts`
    > 1 the rest is first deduplicated per (key, input partition group) in a second state
    store, so that only `salts` copies reach the task that decides.
    On a batch this is a plain dropDuplicates, which Spark runs in two steps anyway.
    """
    keys = list(keys)
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    marked = df.mapInArrow(_first_of_batch(keys), df.schema).withWatermark(event_time, delay)
    if salts > 1:
        salted = marked.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        marked = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(keys)


# Sets that share one entry of the state store and one call of the processor.
LANES = 1024

_MARKS = ["lane", "seen_ms", "until_ms", "set_key", "member_key"]


class _Renewed(StatefulProcessor):
    """The members seen of the sets of one lane. Every sighting renews the life of its set.

    The live sets of a lane are one packed entry, (set, member, end of the set) each, so a
    call to the store serves many sets. Sets that have ended leave when the lane is next
    seen, or with its timer when all have.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._live = handle.getValueState("live", "ends bigint, sets binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["seen_ms", "member_key"], kind="stable", ignore_index=True)
        before, sets = None, pd.DataFrame({"set_key": [], "member_key": [], "until_ms": []})
        if self._live.exists():
            before, packed = self._live.get()
            sets = unpack(packed).to_pandas()
            sets = sets[sets["until_ms"] >= timerValues.getCurrentWatermarkInMs()]
        passed, sets = renew(batch, sets)
        ends = None if sets.empty else int(sets["until_ms"].max())
        if ends != before:
            if before is not None:
                self._handle.deleteTimer(before + 1)
            if ends is not None:
                self._handle.registerTimer(ends + 1)
        if ends is None:
            self._live.clear()
        else:
            self._live.update((ends, pack(sets)))
        yield batch.loc[passed].drop(columns=_MARKS)

    def handleExpiredTimer(
        self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        self._live.clear()
        return iter(())

    def close(self) -> None:
        pass


def renew(batch: pd.DataFrame, sets: pd.DataFrame) -> tuple[pd.Series, pd.DataFrame]:
    """Which sightings, in order of time, are of a member new to its set, and the sets after
    them. A set that was silent beyond its end starts a new life without members."""
    name = batch["set_key"]
    known = name.map(sets.drop_duplicates("set_key").set_index("set_key")["until_ms"])
    reach = batch.groupby("set_key", sort=False)["until_ms"].cummax()
    end_before = np.fmax(reach.groupby(name, sort=False).shift(), known.astype("float64"))
    life = (batch["seen_ms"] > end_before).groupby(name, sort=False).cumsum()
    marked = pd.DataFrame({"set_key": name, "life": life, "member_key": batch["member_key"]})
    pairs = ["set_key", "member_key"]
    kept = pd.MultiIndex.from_frame(marked[pairs]).isin(pd.MultiIndex.from_frame(sets[pairs]))
    passed = ~marked.duplicated() & ~(kept & (life == 0))

    last = life.groupby(name, sort=False).transform("max")
    broken = name[last > 0].unique()
    members = pd.concat([sets.loc[~sets["set_key"].isin(broken), pairs], marked.loc[passed & (life == last), pairs]])
    until = pd.concat([sets[["set_key", "until_ms"]], batch[["set_key", "until_ms"]]]).groupby("set_key")["until_ms"].max()
    members = members.assign(until_ms=members["set_key"].map(until)).dropna(subset="until_ms")
    return passed, members.astype({"until_ms": "int64"})


def dedupe_renewed(
    df: DataFrame,
    group: str,
    member: str,
    event_time: str,
    life: str = "600 seconds",
    delay: str = "600 seconds",
    lanes: int = LANES,
) -> DataFrame:
    """The rows of a stream whose member is new to the set of its group.

    A set lives for `life` after the last sighting of any of its members: each sighting,
    also of a member that is suppressed, renews it, and a group that was silent for longer
    starts anew. Times are event times; rows of one micro-batch count in their order. State
    is dropped by a timer that moves along with the sightings.

    Groups are dealt over `lanes` by hash. The rows of a lane in one micro-batch, and its
    live sets, are in memory together.
    """
    # Null is a group, and a member, of its own.
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = df.withWatermark(event_time, delay).withColumns(
        {
            "seen_ms": F.unix_millis(event_time),
            "until_ms": F.unix_millis(F.expr(f"{event_time} + INTERVAL {life}")),
            "lane": F.pmod(F.xxhash64(group), F.lit(lanes)),
            "set_key": text(group),
            "member_key": text(member),
        }
    )
    return rows.groupBy("lane").transformWithStateInPandas(
        _Renewed(), outputStructType=df.schema, outputMode="append", timeMode="eventTime"
    )
