"""Interval join of two streams in packed lanes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import ArrayType, StructType

from tidemart.streaming.packed import pack_table, unpack

# Lanes that keys are dealt over; each is one entry a side of the state store.
LANES = 128
# Rows of a task that are dealt to their lanes together, or bytes if that is less.
DEAL_ROWS, DEAL_BYTES = 262_144, 32 * 1024 * 1024
# Rows that are joined, and kept packed, together; pairs that leave in one pack.
CHUNK, PAIRS = 200_000, 4_000
# Rows whose time is up within one such time leave together.
SLICE_MS = 15_000

# The event time of a pair, for what stands behind the join.
PAIRED_AT = "paired_at"

LEFT, RIGHT = 0, 1
_AT, _DONE = "_at", "_done"
_DEALT = "lane int, side int, at timestamp, pack binary"
_OUT = f"{PAIRED_AT} timestamp, pairs binary"


@dataclass(frozen=True)
class Side:
    """One side of the join: its rows, their event time, the key they meet by, and the
    columns that name a record."""

    rows: DataFrame
    time: str
    key: str
    record: tuple[str, ...]


@dataclass(frozen=True)
class _Rule:
    """What the processor needs to know; times in microseconds. A left row's time is at most
    `reach` from its partner's, and a record is remembered for `memory`."""

    columns: tuple[tuple[str, ...], tuple[str, ...]]
    keys: tuple[str, str]
    records: tuple[tuple[str, ...], tuple[str, ...]]
    reach: int
    memory: int
    dedupe: bool
    outer: bool


def interval_join(
    left: Side,
    right: Side,
    tolerance: str,
    delay: str,
    salts: int = 4,
    dedupe: bool = True,
    outer: bool = False,
    lanes: int | None = None,
) -> DataFrame:
    """Rows of both streams with equal keys and times within `tolerance`, ends included, with
    the columns of both and `paired_at`; with `outer` also those that found no partner.

    A pair leaves as soon as both rows are there, with the later of their times, which the
    watermark has not passed, as `paired_at` or before it. A row without partner leaves when
    the watermark has passed the slice of time (`SLICE_MS`) in which its time is up. With
    `dedupe` a record that is sent again is dropped until the watermark has passed its first
    time plus `delay`. A row that the watermark has passed, or without a time, is dropped.

    A call to a state store, or a row handed to a processor, costs far more than a row of a
    join. So keys are dealt over `lanes`, rows are packed where they are read, and a lane's
    rows of a micro-batch are joined with each other and with what waits by column. The left
    rows of a key are spread over `salts` places and the right ones, the smaller side, are
    copied to each: without partner one leaves every place that saw none. In memory
    together are the right rows of a lane, and of its left rows a chunk, the records' names
    and the packs of one micro-batch.
    """
    lanes = lanes or LANES
    spark = left.rows.sparkSession
    since = "timestamp_micros(0) + INTERVAL"
    reach, memory = spark.range(1).select(
        F.unix_micros(F.expr(f"{since} {tolerance}")), F.unix_micros(F.expr(f"{since} {delay}"))
    ).first()
    rule = _Rule(
        (tuple(left.rows.columns), tuple(right.rows.columns)),
        (left.key, right.key),
        (left.record, right.record),
        reach,
        memory,
        dedupe,
        outer,
    )
    lane = lambda side: F.pmod(F.xxhash64(side.key), F.lit(lanes)).cast("int") * salts
    place = F.pmod(F.xxhash64(*left.record), F.lit(salts)).cast("int")
    spread = _dealt(left, LEFT, lane(left) + place, delay)
    copied = _dealt(right, RIGHT, lane(right), delay).withColumn(
        "lane", F.explode(F.sequence("lane", F.col("lane") + salts - 1))
    )
    # Rows without partner are older than the watermark when they leave.
    event_time = "" if outer else PAIRED_AT
    packs = spread.unionByName(copied).groupBy("lane").transformWithStateInPandas(
        _Lanes(rule), outputStructType=_OUT, outputMode="append", timeMode="eventTime", eventTimeColumnName=event_time
    )
    schema = StructType([*left.rows.schema.fields, *right.rows.schema.fields])
    opened = packs.select(PAIRED_AT, F.explode(_opened(schema)("pairs")).alias("_row"))
    return opened.select(*[F.col("_row")[name].alias(name) for name in schema.names], PAIRED_AT)


def _dealt(side: Side, number: int, lane: Column, delay: str) -> DataFrame:
    rows = side.rows.where(F.col(side.time).isNotNull()).withColumns({"_lane": lane, _AT: F.unix_micros(side.time)})
    return rows.mapInArrow(_deal(number), _DEALT).withWatermark("at", delay)


def _deal(side: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs the rows of each lane. The time of a pack is that of its latest row."""

    def packs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        table = table.sort_by([("_lane", "ascending"), (_AT, "ascending")]).combine_chunks()
        lane, at = table["_lane"].to_numpy(), table[_AT].to_numpy()
        starts = np.flatnonzero(np.append(True, lane[1:] != lane[:-1]))
        table = table.drop_columns(["_lane"])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(lane[starts], pa.int32()),
                pa.array(np.full(len(starts), side), pa.int32()),
                pa.array(np.maximum.reduceat(at, starts), pa.timestamp("us", "UTC")),
                pa.array([pack_table(table.slice(a, b - a)) for a, b in zip(starts, np.append(starts[1:], len(lane)))], pa.binary()),
            ],
            names=["lane", "side", "at", "pack"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= DEAL_ROWS or size >= DEAL_BYTES:
                yield packs(held)
                held, rows, size = [], 0, 0
        if held:
            yield packs(held)

    return run


def _opened(schema: StructType) -> Callable[[str], Column]:
    """The rows of a pack; columns that it does not have are null."""
    wanted = to_arrow_schema(schema)

    def rows(packs: pa.Array) -> pa.Array:
        tables = [unpack(pack.as_buffer()) for pack in packs]
        whole = pa.concat_tables(
            [
                pa.table([t[f.name].cast(f.type) if f.name in t.column_names else pa.nulls(t.num_rows, f.type) for f in wanted], names=wanted.names)
                for t in tables
            ]
        ).combine_chunks()
        columns = [c.chunk(0) if c.num_chunks else pa.nulls(0, c.type) for c in whole.columns]
        ends = np.cumsum([0, *(t.num_rows for t in tables)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(wanted)))

    # Annotations that the module postpones would be text.
    rows.__annotations__ = {"packs": pa.Array, "return": pa.Array}
    return F.arrow_udf(rows, ArrayType(schema))


def _ends(at: np.ndarray) -> np.ndarray:
    """The ends of the slices that times lie in, in milliseconds."""
    return (at // (SLICE_MS * 1000) + 1) * SLICE_MS


def _times(rows: pa.Table) -> np.ndarray:
    return rows[_AT].to_numpy()


def _chunks(packs: Iterable[bytes]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for pack in packs:
        table = unpack(pack)
        held.append(table)
        rows += table.num_rows
        if rows >= CHUNK:
            yield pa.concat_tables(held).combine_chunks()
            held, rows = [], 0
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _packed(rows: pa.Table) -> bytes:
    """In order of their time, in which rows take least."""
    return pack_table(rows.sort_by(_AT))


def _names(rows: pa.Table, record: tuple[str, ...]) -> pa.Table:
    return pa.table([rows[c] for c in record], names=[f"k{i}" for i in range(len(record))])


def _first(rows: pa.Table, names: pa.Table, seen: list[pa.Table]) -> np.ndarray:
    """Places of the first row of every record that was not seen."""
    known = sum(t.num_rows for t in seen)
    every = pa.concat_tables([*seen, names])
    every = every.append_column("at", pa.array(np.arange(every.num_rows)))
    first = every.group_by(names.column_names).aggregate([("at", "min")])["at_min"].to_numpy()
    return np.sort(first[first >= known]) - known


class _Lanes(StatefulProcessor):
    """The waiting rows of a lane, packed, with one timer for the earliest that leaves."""

    def __init__(self, rule: _Rule) -> None:
        self._rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._kept = [handle.getListState("left", "rows binary"), handle.getListState("right", "rows binary")]
        self._timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        came: list[list[bytes]] = [[], []]
        for frame in rows:
            for side, pack in zip(frame["side"], frame["pack"]):
                came[side].append(pack)
        old = [[chunk for (chunk,) in kept.get()] for kept in self._kept]
        ends = []

        # The right rows: what waits, and what is new.
        waiting = self._whole(old[RIGHT])
        fresh = self._whole(came[RIGHT])
        if fresh is not None:
            seen = [] if waiting is None else [self._live(waiting, RIGHT, watermark)]
            fresh = self._new(fresh, RIGHT, watermark, seen)
        right = [t for t in (waiting, fresh) if t is not None]
        right = pa.concat_tables(right).combine_chunks() if right else None
        before = 0 if waiting is None else waiting.num_rows
        found = None if right is None else self._done(right)

        # Lines that wait meet the new right rows, a chunk at a time.
        names, again = [], []
        for pack in old[LEFT] if came[LEFT] or (fresh is not None and fresh.num_rows) else ():
            chunk = unpack(pack)
            if came[LEFT] and self._rule.dedupe:
                names.append(self._live(chunk, LEFT, watermark))
            if fresh is not None and fresh.num_rows:
                at, to = self._meet(chunk, fresh)
                yield from self._pairs(chunk, at, fresh, to)
                found[before + to] = True
                chunk = self._marked(chunk, at)
            again.append(chunk)
        if self._rule.outer and fresh is not None and fresh.num_rows and again:
            self._kept[LEFT].put([(_packed(chunk),) for chunk in again])

        # New left rows meet all right rows.
        for chunk in _chunks(came[LEFT]):
            chunk = self._new(chunk, LEFT, watermark, names)
            if self._rule.dedupe:
                names.append(_names(chunk, self._rule.records[LEFT]))
            if not chunk.num_rows:
                continue
            if right is not None:
                at, to = self._meet(chunk, right)
                yield from self._pairs(chunk, at, right, to)
                found[to] = True
                chunk = self._marked(chunk, at)
            self._kept[LEFT].appendValue((_packed(chunk),))
            ends.append(self._leaves(chunk).min())

        if fresh is not None and fresh.num_rows:
            ends.append(self._leaves(self._with_done(fresh, found[before:])).min())
        if self._rule.outer and right is not None:
            self._keep(RIGHT, [self._with_done(right, found)])
        elif fresh is not None and fresh.num_rows:
            self._kept[RIGHT].appendValue((_packed(fresh),))
        if ends:
            self._wake(int(min(ends)))

    def handleExpiredTimer(
        self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        self._timer.clear()
        watermark = timerValues.getCurrentWatermarkInMs()
        ends = []
        for side in (LEFT, RIGHT):
            kept = []
            for (pack,) in self._kept[side].get():
                rows = unpack(pack)
                if self._rule.outer:
                    alone = ~self._done(rows) & (_ends(_times(rows) + self._rule.reach) < watermark)
                    yield from self._out(rows.filter(pa.array(alone)).select(self._rule.columns[side]))
                    rows = self._with_done(rows, self._done(rows) | alone)
                rows = rows.filter(pa.array(self._gone(rows) >= watermark))
                if rows.num_rows:
                    kept.append(pack_table(rows))
                    ends.append(self._leaves(rows).min())
            self._keep(side, list(_chunks(kept)))
        if ends:
            self._wake(int(min(ends)))

    def _whole(self, packs: list[bytes]) -> pa.Table | None:
        return pa.concat_tables([unpack(p) for p in packs]).combine_chunks() if packs else None

    def _live(self, rows: pa.Table, side: int, watermark: int) -> pa.Table:
        live = rows.filter(pa.array(_times(rows) + self._rule.memory > watermark))
        return _names(live, self._rule.records[side])

    def _new(self, rows: pa.Table, side: int, watermark: int, seen: list[pa.Table]) -> pa.Table:
        if watermark > 0:
            rows = rows.filter(pa.array(_times(rows) > watermark))
        if self._rule.dedupe:
            rows = rows.take(_first(rows, _names(rows, self._rule.records[side]), seen))
        return self._with_done(rows, np.zeros(rows.num_rows, bool))

    def _meet(self, left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs in both tables. A null key meets none."""
        a, b = (
            pa.table({"key": rows[key], f"{name}_at": rows[_AT], name: np.arange(rows.num_rows)})
            for rows, key, name in ((left, self._rule.keys[LEFT], "l"), (right, self._rule.keys[RIGHT], "r"))
        )
        met = a.join(b, "key", join_type="inner", use_threads=False)
        near = np.abs(met["l_at"].to_numpy() - met["r_at"].to_numpy()) <= self._rule.reach
        return met["l"].to_numpy()[near], met["r"].to_numpy()[near]

    def _pairs(self, left: pa.Table, at: np.ndarray, right: pa.Table, to: np.ndarray) -> Iterator[pd.DataFrame]:
        by_time = np.argsort(_times(left)[at], kind="stable")
        at, to = at[by_time], to[by_time]
        for i in range(0, len(at), PAIRS):
            l_rows, r_rows = left.take(at[i : i + PAIRS]), right.take(to[i : i + PAIRS])
            later = int(np.maximum(_times(l_rows), _times(r_rows)).min())
            l_rows, r_rows = (rows.select(names) for rows, names in zip((l_rows, r_rows), self._rule.columns))
            both = pa.table([*l_rows.columns, *r_rows.columns], names=[*l_rows.column_names, *r_rows.column_names])
            yield from self._out(both, later)

    @staticmethod
    def _out(rows: pa.Table, at: int | None = None) -> Iterator[pd.DataFrame]:
        time = pd.Series([at], dtype="Int64").astype("datetime64[us, UTC]")
        for i in range(0, rows.num_rows, PAIRS):
            yield pd.DataFrame({PAIRED_AT: time, "pairs": [pack_table(rows.slice(i, PAIRS))]})

    def _done(self, rows: pa.Table) -> np.ndarray:
        """Which rows had a partner, or left without one; only kept where that is asked for."""
        return rows[_DONE].to_numpy().copy() if self._rule.outer else np.zeros(rows.num_rows, bool)

    def _with_done(self, rows: pa.Table, done: np.ndarray) -> pa.Table:
        if not self._rule.outer:
            return rows
        rest = rows.drop_columns([_DONE]) if _DONE in rows.column_names else rows
        return rest.append_column(_DONE, pa.array(done))

    def _marked(self, rows: pa.Table, at: np.ndarray) -> pa.Table:
        done = self._done(rows)
        done[at] = True
        return self._with_done(rows, done)

    def _gone(self, rows: pa.Table) -> np.ndarray:
        """When rows are needed no more."""
        return _ends(_times(rows) + max(self._rule.reach, self._rule.memory if self._rule.dedupe else 0))

    def _leaves(self, rows: pa.Table) -> np.ndarray:
        """When something is to be done about rows."""
        return np.where(self._done(rows) | (not self._rule.outer), self._gone(rows), _ends(_times(rows) + self._rule.reach))

    def _keep(self, side: int, chunks: list[pa.Table]) -> None:
        if chunks:
            self._kept[side].put([(_packed(chunk),) for chunk in chunks])
        else:
            self._kept[side].clear()

    def _wake(self, end: int) -> None:
        before = self._timer.get()[0] if self._timer.exists() else None
        if before is not None and before <= end:
            return
        if before is not None:
            self._handle.deleteTimer(before)
        self._handle.registerTimer(end)
        self._timer.update((end,))

    def close(self) -> None:
        pass
