"""The wide order row: order and line side by side, and the line's share of the amount."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.money import cents, from_cents
from tidemart.schemas import ORDER_WIDE, TEXT

# Where each wide column comes from; columns not named here have no source yet.
FROM_ORDER = {
    "order_id": "id",
    "order_status": "order_status",
    "create_time": "create_time",
    "dt": "create_date",
    "user_id": "user_id",
    "benefit_reduce_amount": "benefit_reduce_amount",
    "original_total_amount": "original_total_amount",
    "feight_fee": "feight_fee",
    "final_total_amount": "final_total_amount",
    "if_first_order": "if_first_order",
    "province_name": "province_name",
    "province_area_code": "province_area_code",
    "user_age_group": "user_age_group",
    "user_gender": "user_gender",
}
WIDE_KEYS = ("order_id", "order_detail_id")
FROM_DETAIL = {
    "order_detail_id": "id",
    "sku_id": "sku_id",
    "sku_name": "sku_name",
    "sku_price": "order_price",
    "sku_num": "sku_num",
    "final_detail_amount": "final_detail_amount",
    "spu_id": "spu_id",
    "tm_id": "tm_id",
    "category3_id": "category3_id",
    "spu_name": "spu_name",
    "tm_name": "tm_name",
    "category3_name": "category3_name",
}


def _side(df: DataFrame, names: dict[str, str], extra: Iterable[str] = ()) -> list[Column]:
    return [F.col(src).alias(out) for out, src in names.items() if src in df.columns] + [
        F.col(c) for c in extra
    ]


def order_side(orders: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    return orders.select(*_side(orders, FROM_ORDER, extra))


def detail_side(details: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    return details.select(F.col("order_id").alias("_order"), *_side(details, FROM_DETAIL, extra))


def wide_columns(joined: DataFrame, extra: Iterable[str] = (), complete: bool = False) -> DataFrame:
    """The 26 columns in order: missing numbers are zero, missing text is null.

    `complete` says that both sides are always there. Their ids then stay untouched,
    which keeps the join's partitioning usable for what follows.
    """
    out = []
    for field in ORDER_WIDE.fields:
        present = field.name in joined.columns
        value = (F.col(field.name) if present else F.lit(None)).cast(field.dataType)
        if field.dataType != TEXT and not (complete and field.name in WIDE_KEYS):
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        out.append(value.alias(field.name))
    return joined.select(*out, *extra)


def widen(
    orders: DataFrame, details: DataFrame, how: str = "inner", extra: Iterable[str] = ()
) -> DataFrame:
    """Join order headers to their lines. `extra` keeps further line columns.

    Lines are the left side, so AQE can split the partition of an order with very
    many of them. A row with no order keeps order id 0, as it has no order.
    """
    left, right = detail_side(details, extra), order_side(orders)
    how = {"left": "right", "right": "left"}.get(how, how)
    joined = left.join(right, left["_order"] == right["order_id"], how)
    return wide_columns(joined, extra, how == "inner")


def orders_without_detail(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders no line refers to; the lines are reduced to their order ids first."""
    used = details.select(F.col("order_id").alias("id")).distinct()
    return orders.join(used, "id", "left_anti")


def split_amount(
    df: DataFrame,
    total: str,
    weight: str,
    group: str,
    order_by: Iterable[str],
    out: str = "final_detail_amount",
) -> DataFrame:
    """Spread `total` of a group over its rows in proportion to `weight`, to the cent.

    Every row but the last gets floor(total * weight / sum of weights) cents, rounded
    towards minus infinity for negative amounts too; the last one gets what is left, so
    the rows add up. Where the weights add up to zero the last row gets all. The last row
    is the greatest by `order_by`, then by the hash of the row. Rows alike in every column
    are copies; one of the copies of the last row counts as last. Rows without a group
    get zero.

    One way for groups of any size: sums per group are aggregated, partly where the rows
    are, and joined back with the rows on the left, so AQE can split a very large group.
    Copies merge first, which also keeps a line that was sent very often in one row.
    """
    columns = [c for c in df.columns if c != out]
    merged = df.select(*columns).groupBy(*columns).agg(F.count("*").alias("_copies"))
    place = F.struct(*order_by, F.xxhash64(*columns))
    rows = merged.withColumns({"_total": cents(F.col(total)), "_weight": cents(F.col(weight)), "_place": place})
    weighed = rows.groupBy(group).agg(
        F.sum(F.col("_weight") * F.col("_copies")).alias("_all"), F.max("_place").alias("_end")
    )
    floors = rows.join(weighed, group, "left").withColumns(
        {"_floor": _floor_cents(), "_last": F.col("_place") == F.col("_end")}
    )
    # All floors but one of the last row's.
    others = F.col("_copies") - F.when(F.col("_last"), 1).otherwise(0)
    rest = floors.groupBy(group).agg(F.sum(F.col("_floor") * others).alias("_rest"))
    # Every copy is a row again; the first copy of the last row takes what is left.
    each = floors.join(rest, group, "left").select(
        "*", F.posexplode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_copy", "_")
    )
    takes = F.col("_last") & (F.col("_copy") == 0)
    amount = F.when(takes, F.col("_total") - F.col("_rest")).otherwise(F.col("_floor"))
    return each.withColumn(out, from_cents(amount)).select(*columns, out)


def _floor_cents() -> Column:
    down = F.expr("(_total * _weight) div _all")
    below = F.expr("(_total * _weight) % _all <> 0 AND signum(_total * _weight) <> signum(_all)")
    share = (down - F.when(below, 1).otherwise(0)).cast("decimal(20,0)")
    return F.when(F.col("_all") != 0, share).otherwise(F.lit(0).cast("decimal(20,0)"))


def collect_details(details: DataFrame, cols: Iterable[str]) -> DataFrame:
    """The set of lines of every order: one row per order and different line.

    The rows of an order are its set, for orders of any size: no row or task holds a whole
    order.
    """
    return details.select("order_id", F.struct(*cols).alias("detail")).distinct()
