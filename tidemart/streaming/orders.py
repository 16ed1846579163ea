"""Orders and their lines as streams: interval joins, first orders."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemart.operators.first_order import first_order_flag, user_state
from tidemart.operators.wide import detail_side, order_side, wide_columns
from tidemart.schemas import FIRST_ORDER_FLAG, USER_FIRST_ORDER
from tidemart.sources.keyed import KeyedTable
from tidemart.sources.sinks import append_batch, store_order_wide
from tidemart.sources.tables import remove_folder
from tidemart.streaming.interval import PAIRED_AT, Side, interval_join

# The window of the short join and the life of the long join's buffers.
SHORT_TOLERANCE = "15 seconds"
LONG_TOLERANCE = "600 seconds"


def join_order_detail(
    orders: DataFrame,
    details: DataFrame,
    tolerance: str = SHORT_TOLERANCE,
    order_ts: str = "order_ts",
    detail_ts: str = "detail_ts",
    delay: str = LONG_TOLERANCE,
    salts: int = 4,
    dedupe: bool = True,
) -> DataFrame:
    """Wide rows of lines whose time is within `tolerance` of their order's, ends
    included; each (order, line) pair once, whichever side came first.

    Works on two batches and on two streams. In a stream (`interval_join`) both sides are
    kept until the watermark makes a match impossible, and pairs have their event time in
    `PAIRED_AT`. The lines of one order are spread over `salts` places, and orders, the
    smaller side, are copied to each. A record sent again is dropped before the join, so
    copies never multiply.
    """
    left, right = _sides(orders, details, order_ts, detail_ts)
    if orders.isStreaming:
        joined = interval_join(left, right, tolerance, delay, salts, dedupe)
        return wide_columns(joined, [order_ts, detail_ts, PAIRED_AT], complete=True)
    joined = _joined_batches(left, right, tolerance, dedupe, "inner")
    return wide_columns(joined, [order_ts, detail_ts], complete=True)


def _sides(orders: DataFrame, details: DataFrame, order_ts: str, detail_ts: str) -> tuple[Side, Side]:
    """Lines and orders as the two sides of the interval join."""
    return (
        Side(detail_side(details, [detail_ts]), detail_ts, "_order", ("_order", "order_detail_id")),
        Side(order_side(orders, [order_ts]), order_ts, "order_id", ("order_id",)),
    )


def _joined_batches(left: Side, right: Side, tolerance: str, dedupe: bool, how: str) -> DataFrame:
    lines, orders = (s.rows.dropDuplicates([*s.record]) if dedupe else s.rows for s in (left, right))
    interval = F.expr(
        f"{left.key} = {right.key} AND {left.time} >= {right.time} - INTERVAL {tolerance}"
        f" AND {left.time} <= {right.time} + INTERVAL {tolerance}"
    )
    return lines.join(orders, interval, how)


# Both sides, also without a partner ------------------------------------------------

BOTH, ORDER_ONLY, DETAIL_ONLY = "both", "order", "detail"


def outer_join_order_detail(
    orders: DataFrame,
    details: DataFrame,
    tolerance: str = SHORT_TOLERANCE,
    order_ts: str = "order_ts",
    detail_ts: str = "detail_ts",
    delay: str = LONG_TOLERANCE,
    salts: int = 4,
    dedupe: bool = True,
) -> DataFrame:
    """Wide rows with `side`: 'both', 'order' for an order that no line came for within
    `tolerance`, and 'detail' for a line without its order.

    In a stream a pair leaves as soon as both are there, and a row without a partner when
    the watermark makes one impossible. An order waits in `salts` places, each for its
    share of the lines, and is reported by every place that saw none: `copies` is the
    number of places, and `save_sides` keeps an order that all of them report. All copies
    have one time, so the watermark passes them in one micro-batch.
    """
    salted = orders.isStreaming and salts > 1
    left, right = _sides(orders, details, order_ts, detail_ts)
    if orders.isStreaming:
        joined = interval_join(left, right, tolerance, delay, salts, dedupe, outer=True)
    else:
        joined = _joined_batches(left, right, tolerance, dedupe, "full")
    side = (
        F.when(F.col("_order").isNull(), ORDER_ONLY).when(F.col("order_id").isNull(), DETAIL_ONLY).otherwise(BOTH)
    )
    # A line without its order still says which order it waited for.
    known = joined.withColumns({"side": side, "_id": F.coalesce("order_id", "_order")})
    rows = known.drop("order_id").withColumnRenamed("_id", "order_id")
    return wide_columns(rows, ["side", order_ts, detail_ts]).withColumn("copies", F.lit(salts if salted else 1))


def save_sides(wide_path: str, unmatched_path: str) -> Callable[[DataFrame, int], None]:
    """Batch function for `outer_join_order_detail`: pairs to the wide table, and what
    found no partner, with its `side`, to another."""

    def save(batch: DataFrame, batch_id: int) -> None:
        # Computed once and kept as a file: both sides of a large batch do not fit in memory.
        spark, held = batch.sparkSession, f"{unmatched_path}/_batch"
        batch.write.mode("overwrite").parquet(held)
        rows = spark.read.schema(batch.schema).parquet(held)
        pairs = rows.where(F.col("side") == BOTH)
        store_order_wide(pairs.drop("side", "copies"), wide_path, batch_id)
        append_batch(without_partner(rows), batch_id, unmatched_path, ("side",))
        remove_folder(spark, held)

    return save


def without_partner(rows: DataFrame) -> DataFrame:
    """The rows of one micro-batch, or of a whole batch join, without a partner; an order
    only if every place it waited in reports it."""
    alone = rows.where(F.col("side") != BOTH)
    kept = [c for c in rows.columns if c != "copies"]
    # A line waits in one place only.
    lines = alone.where(F.col("side") == DETAIL_ONLY).select(*kept)
    orders = alone.where(F.col("side") == ORDER_ONLY)
    whole = orders.groupBy(*kept).agg(F.count("*").alias("_n"), F.max("copies").alias("_copies"))
    return whole.where(F.col("_n") == F.col("_copies")).select(*kept).unionByName(lines)


# First orders -----------------------------------------------------------------

_CANDIDATE = 0


def _mark_candidates(lanes: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.drop_duplicates("id").reset_index(drop=True)
            ordered = rows.sort_values(["create_time", "id"], na_position="first")
            best = ordered.drop_duplicates("user_id").index
            lane = 1 + rows["id"].astype("int64") % lanes
            lane.loc[best] = _CANDIDATE
            # A row that cannot be first needs no user key: it is spread by its id.
            yield rows.assign(
                lane=lane.astype("int32"),
                lane_key=rows["user_id"].where(lane == _CANDIDATE, lane),
            )

    return mark


class _FirstOrder(StatefulProcessor):
    """Keeps the id of every user's first order, so that it keeps its flag when it is sent
    again."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getValueState("first_order", "id bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        if key[1] != _CANDIDATE:
            for row in rows:
                yield self._out(row, "0")
            return
        first = self._first.get()[0] if self._first.exists() else None
        best = None
        for row in rows:
            if first is not None:
                yield self._out(row, "1" if row["id"] == first else "0")
            elif best is None:
                best = row
            elif self._place(row) < self._place(best):
                yield self._out(best, "0")
                best = row
            else:
                yield self._out(row, "0")
        if best is not None:
            self._first.update((best["id"],))
            yield self._out(best, "1")

    @staticmethod
    def _place(row: Row) -> tuple[bool, str, int]:
        """Sorts as Spark does: a missing time comes before all others."""
        time = row["create_time"]
        return time is not None, time or "", row["id"]

    @staticmethod
    def _out(row: Row, flag: str) -> Row:
        return Row(id=row["id"], user_id=row["user_id"], create_time=row["create_time"], if_first_order=flag)

    def close(self) -> None:
        pass


def first_order_stream(orders: DataFrame, lanes: int = 64) -> DataFrame:
    """(id, user_id, create_time, if_first_order) of a stream of orders.

    Across batches the user's state decides; inside a batch the earliest order by
    (create_time, id). Built-in streaming aggregates cannot return every row with
    its flag, hence a stateful processor. Each input task first picks the one order
    per user and Arrow batch that can still be first; only those meet at the user's
    state, the others pass through lanes chosen by order id.
    """
    # A missing number is zero, as in the wide row; it also keeps pandas on integers.
    number = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c)
    narrow = orders.select(number("id"), number("user_id"), "create_time")
    marked = narrow.mapInPandas(
        _mark_candidates(lanes),
        "id bigint, user_id bigint, create_time string, lane int, lane_key bigint",
    )
    return marked.groupBy("lane_key", "lane").transformWithState(
        statefulProcessor=_FirstOrder(),
        outputStructType=FIRST_ORDER_FLAG,
        outputMode="append",
        timeMode="none",
    )


def save_first_orders(
    orders_path: str,
    state_path: str,
    partitions: Iterable[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    emit: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch function of the order job: flag, write orders, write user state.

    The same rule in table form: the state is a table kept by user, with the id of the
    user's first order and its batch, and a batch only sees the state of the batches before
    it. So running one again gives the same flags, and so does sending an order again later.
    Only the state of the buckets that the batch's users fall into is read and written.
    Everything is joined by unique keys. `prepare` may add columns to the flagged orders
    and `emit` send them on.
    """
    partitions = list(partitions)
    kept = KeyedTable(state_path, USER_FIRST_ORDER, ["user_id"], oldest=["batch_id"])

    def save(batch: DataFrame, batch_id: int) -> None:
        orders = batch.dropDuplicates(["id"])
        users = orders.select(F.col("user_id").cast("string").alias("user_id")).distinct()
        # The batch is the small side: Spark broadcasts its users while they are below the
        # threshold, and the state that is read is not shuffled.
        state = kept.read_for(users).where(F.col("batch_id") < batch_id).drop("batch_id")
        state = state.join(users, "user_id", "left_semi")
        known = state.select(F.col("order_id").alias("id"), F.lit(True).alias("_known")).distinct()
        flagged = first_order_flag(orders, state).join(known, "id", "left")
        flagged = flagged.withColumn("if_first_order", F.when(F.col("_known"), "1").otherwise(F.col("if_first_order")))
        new = (~F.coalesce("_known", F.lit(False))).alias("_new")
        flagged = flagged.select(*[c for c in flagged.columns if c != "_known"], new)
        if prepare:
            flagged = prepare(flagged)
        # Three writes from one computation.
        flagged.persist()
        try:
            append_batch(flagged.drop("_new"), batch_id, orders_path, partitions)
            if emit:
                emit(flagged.drop("_new"), batch_id)
            # Users who had a state keep it: one row per user, however often they order.
            firsts = flagged.where("if_first_order = '1' and _new")
            kept.save(user_state(firsts, F.col("id").alias("order_id")), batch_id)
        finally:
            flagged.unpersist()

    return save


def save_upserts(path: str, columns: Iterable[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function of a dimension job: keep every change, newest wins on reading."""
    return lambda batch, batch_id: append_batch(
        batch if columns is None else batch.select(*columns), batch_id, path, ()
    )
