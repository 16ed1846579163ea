"""Which order is the first of its user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def user_state(orders: DataFrame, *more: Column) -> DataFrame:
    """State rows of the users who ordered: (user_id as text, "1"), and further columns."""
    return orders.select(F.col("user_id").cast("string").alias("user_id"), *more).distinct().withColumn(
        "if_consumed", F.lit("1")
    )


def with_user_state(orders: DataFrame, state: DataFrame) -> DataFrame:
    """Orders with their user's state; "0" where the user has none.

    State rows are unique per user, so an order is never repeated. The orders are
    the left side: AQE splits the partition of a very busy user.
    """
    known = state.select(F.col("user_id").cast("bigint").alias("user_id"), "if_consumed")
    return orders.join(known, "user_id", "left").withColumn(
        "if_consumed", F.coalesce("if_consumed", F.lit("0"))
    )


def first_orders(orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """(user_id, id) of each user's earliest order, by (create_time, id); users who
    already have a state with "1" are left out."""
    first = orders.groupBy("user_id").agg(F.min(F.struct("create_time", "id")).alias("_f"))
    first = first.select("user_id", F.col("_f.id").alias("id"))
    if state is None:
        return first
    consumed = state.where(F.col("if_consumed") == "1").select(
        F.col("user_id").cast("bigint").alias("user_id")
    )
    return first.join(consumed, "user_id", "left_anti")


def first_order_flag(orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Orders with if_first_order: "1" on a user's first order, "0" on all others.

    The first order per user is found with partial aggregation and found again in
    the orders by order id. Ids are unique, so neither step has a hot key, however
    many orders one user has.
    """
    flags = first_orders(orders, state).select("id", F.lit("1").alias("if_first_order"))
    return orders.join(flags, "id", "left").withColumn(
        "if_first_order", F.coalesce("if_first_order", F.lit("0"))
    )
