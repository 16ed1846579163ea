"""Line shares of an order's amount in a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tidemart.functions.money import cents, from_cents
from tidemart.functions.text import computed_once
from tidemart.operators.wide import wide_columns
from tidemart.schemas import LONG, MONEY, ORDER_WIDE, TEXT, struct
from tidemart.streaming.interval import PAIRED_AT
from tidemart.streaming.packed import pack, unpack

# Lines that are packed, and leave, together.
CHUNK = 10_000
# Packed chunks that are held while a slice leaves.
KEPT = 16
# Orders whose last lines can come within one such time close together.
SLICE_MS = 15_000

_STATE = "chunk binary"
_SHARE = "final_detail_amount"
# A wide row on its way: whole numbers, money in cents, and its texts as one. JSON of all its
# columns, with their names, takes twice the room in a shuffle.
_NUMBERS = [f.name for f in ORDER_WIDE.fields if f.dataType in (LONG, MONEY) and f.name != _SHARE]
_TEXTS = struct(**{f.name: TEXT for f in ORDER_WIDE.fields if f.dataType == TEXT})
_LINES = ["place", *_NUMBERS, "texts"]
_ORDER, _LINE, _WEIGHT, _TOTAL = "order_id", "order_detail_id", "sku_price", "final_total_amount"
_OUT = ", ".join([*(f"{name} bigint" for name in _NUMBERS), "texts string", "share bigint"])
_LEAST = np.iinfo(np.int64).min

_Read = Callable[[Sequence[str]], Iterator[pd.DataFrame]]


class _Shares(StatefulProcessor):
    """Gathers the lines of the orders of one slice and lane and divides their amounts when
    no more can come.

    The lines lie in the state store, on disk, as packed chunks: a call to the store and a
    timer serve many orders. When the time comes they are read through four times, a chunk
    at a time. Only a few numbers per order are in memory, however many lines it has.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._lines = handle.getListState("lines", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if not self._lines.exists():
            self._handle.registerTimer(int(key[0]) + 1)
        for chunk in rows:
            # Lines of an order agree in most columns.
            chunk = chunk[_LINES].sort_values([_ORDER, "place"], kind="stable")
            self._lines.appendList([(pack(chunk.iloc[i : i + CHUNK]),) for i in range(0, len(chunk), CHUNK)])
        return iter(())

    def handleExpiredTimer(
        self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        # Few chunks are kept packed, many are read from the store again.
        kept = list(islice(self._lines.get(), KEPT + 1))
        chunks = self._lines.get if len(kept) > KEPT else lambda: kept
        yield from _divided(lambda names: (unpack(chunk, names).to_pandas() for (chunk,) in chunks()))
        self._lines.clear()

    def close(self) -> None:
        pass


def _divided(read: _Read) -> Iterator[pd.DataFrame]:
    """The lines that `read` gives, a chunk at a time, with their shares."""
    orders, whole = _orders(read)
    # Sum of the weights, and the last line by (place, id).
    weights = np.zeros(len(orders), whole)
    place, line = np.full(len(orders), _LEAST), np.full(len(orders), _LEAST)
    for lines in read([_ORDER, "place", _LINE, _WEIGHT]):
        to = np.searchsorted(orders, lines[_ORDER])
        np.add.at(weights, to, lines[_WEIGHT].to_numpy().astype(whole))
        places, ids = lines["place"].to_numpy(), lines[_LINE].to_numpy()
        by_end = np.lexsort((ids, places, to))
        ends = by_end[np.append(np.diff(to[by_end]) != 0, True)]
        at = to[ends]
        later = (places[ends] > place[at]) | ((places[ends] == place[at]) & (ids[ends] > line[at]))
        place[at[later]], line[at[later]] = places[ends[later]], ids[ends[later]]
    divisor = np.where(weights == 0, 1, weights)

    def floors(lines: pd.DataFrame, to: np.ndarray) -> np.ndarray:
        # // rounds towards minus infinity, also for negative amounts.
        product = lines[_TOTAL].to_numpy().astype(whole) * lines[_WEIGHT].to_numpy().astype(whole)
        return np.where(weights[to] == 0, 0, product // divisor[to])

    # What the floors leave; the last line takes it on top of its own.
    rest, begun = np.zeros(len(orders), whole), np.zeros(len(orders), bool)
    for lines in read([_ORDER, _WEIGHT, _TOTAL]):
        to = np.searchsorted(orders, lines[_ORDER])
        seen, first = np.unique(to, return_index=True)
        new = ~begun[seen]
        rest[seen[new]] = lines[_TOTAL].to_numpy()[first[new]]
        begun[seen] = True
        np.subtract.at(rest, to, floors(lines, to))
    taken = np.zeros(len(orders), bool)
    for lines in read([*_NUMBERS, "texts", "place"]):
        to = np.searchsorted(orders, lines[_ORDER])
        share = floors(lines, to)
        last = np.flatnonzero((lines["place"].to_numpy() == place[to]) & (lines[_LINE].to_numpy() == line[to]))
        # Of copies of the last line the first takes it.
        ending, first = np.unique(to[last], return_index=True)
        open_ = ~taken[ending]
        share[last[first[open_]]] += rest[ending[open_]]
        taken[ending] = True
        yield lines[[*_NUMBERS, "texts"]].assign(share=share.astype("int64"))


def _orders(read: _Read) -> tuple[np.ndarray, type]:
    """The orders, ascending, and the kind of numbers that holds all sums and products of
    their lines: Python's own where 64 bits may not."""
    orders, count, lightest, weight, total = np.empty(0, np.int64), 0, 0, 0, 0
    for lines in read([_ORDER, _WEIGHT, _TOTAL]):
        orders = np.union1d(orders, lines[_ORDER].to_numpy())
        count += len(lines)
        weights = [int(lines[_WEIGHT].min()), int(lines[_WEIGHT].max())]
        lightest, weight = min(lightest, weights[0]), max(weight, *map(abs, weights))
        total = max(total, *(abs(int(x)) for x in (lines[_TOTAL].min(), lines[_TOTAL].max())))
    # Weights of both signs may leave a sum far below any of them, and shares far above the total.
    most = max(total * weight + total, total * weight * count if lightest < 0 else total + count * (total + 1), weight * count)
    return orders, (np.int64 if most < 2**62 else object)


def split_amount_stream(
    wide: DataFrame,
    order_ts: str = "order_ts",
    detail_ts: str = "detail_ts",
    wait: str = "15 seconds",
    lanes: int = 4,
) -> DataFrame:
    """Wide rows of a stream with `final_detail_amount`, the share of each line in its
    order's amount, as `split_amount` gives it with lines in order of (time, id).

    `wide` has each (order, line) pair once and the times of both. The watermark is on the
    time that `join_order_detail` gives its pairs, or on `order_ts` where there is none. A line can come until `wait`, the tolerance of the join before, after its
    order; when the watermark has passed that, and the end of the slice of time (`SLICE_MS`) it falls in, all
    rows of the order leave together, and they add up to its amount. A pair's time is that of
    its later row, so a line that the join lets pass is never too late here.

    The orders of a slice are dealt over `lanes`; their lines share the state of the lane. A
    call to the state costs far more than a line, so there are few lanes: slices are apart.
    """
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    number = lambda f: cents(zero(f.name)) if f.dataType == MONEY else zero(f.name)
    closes = F.unix_millis(F.expr(f"{order_ts} + INTERVAL {wait}"))
    # The end of a slice, not before the order closes.
    end = closes - F.pmod(closes, F.lit(SLICE_MS)) + SLICE_MS
    # Rows without an order are a group of their own.
    lane = F.when(F.col("order_id").isNotNull(), F.pmod(F.xxhash64("order_id"), F.lit(lanes))).otherwise(-1)
    narrow = wide.select(
        end.alias("closes"),
        lane.alias("lane"),
        PAIRED_AT if PAIRED_AT in wide.columns else order_ts,
        F.coalesce(F.unix_micros(detail_ts), F.lit(_LEAST)).alias("place"),
        *[number(f).cast("bigint").alias(f.name) for f in ORDER_WIDE.fields if f.name in _NUMBERS],
        F.to_json(F.struct(*_TEXTS.names)).alias("texts"),
    )
    shares = narrow.groupBy("closes", "lane").transformWithStateInPandas(
        _Shares(), outputStructType=_OUT, outputMode="append", timeMode="eventTime"
    )
    parsed = computed_once(shares, F.from_json("texts", _TEXTS), *_NUMBERS, "share")
    amounts = [f.name for f in ORDER_WIDE.fields if f.dataType == MONEY and f.name != _SHARE]
    money = {name: from_cents(F.col(name)) for name in amounts} | {_SHARE: from_cents(F.col("share"))}
    return wide_columns(parsed.withColumns(money))
