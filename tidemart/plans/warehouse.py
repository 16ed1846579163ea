"""The layers of the warehouse put together from the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.times import age_group, order_time_parts
from tidemart.operators.dimensions import enrich, enrich_province, enrich_sku
from tidemart.operators.first_order import first_order_flag
from tidemart.operators.wide import split_amount, widen
from tidemart.sources import retail
from tidemart.sources.tables import read_table


class Warehouse:
    """Lazy access to the business tables over one folder of input tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        """An input table; file footers are only read for its schema the first time."""
        df = read_table(self.spark, self.folder, name, self._schemas.get(name))
        self._schemas[name] = df.schema
        return df

    def logs(self) -> DataFrame:
        return retail.app_logs(self.table("events"))

    def purchases(self) -> DataFrame:
        return retail.purchase_orders(self.table("events"))

    def orders(self, located: bool = False) -> DataFrame:
        customer = self.table("customer") if located else None
        return retail.orders(self.table("orders"), customer)

    def details(self) -> DataFrame:
        return retail.order_details(self.table("lineitem"))

    def users(self) -> DataFrame:
        return retail.users(self.table("customer"))

    def provinces(self) -> DataFrame:
        return retail.provinces(self.table("nation"), self.table("region"))

    def with_sku(self, details: DataFrame) -> DataFrame:
        part = self.table("part")
        return enrich_sku(
            details, retail.skus(part), retail.spus(part), retail.trademarks(part), retail.categories(part)
        )

    def rich_orders(self) -> DataFrame:
        """Orders with dates, first-order flag, province, and the user's gender and age group.

        The two customer lookups come first and share one shuffle by user; the flag's
        shuffle by order id comes last and also serves the join with the lines.
        """
        placed = with_user(order_time_parts(self.orders(located=True)), self.users())
        return first_order_flag(enrich_province(placed, self.provinces()))

    def amounts(self) -> DataFrame:
        """Wide rows without dimension columns, each line with its share of the amount."""
        return self._with_shares(order_time_parts(self.orders()), lambda details: details)

    def order_wide(self) -> DataFrame:
        return self._with_shares(self.rich_orders(), self.with_sku)

    def _with_shares(self, orders: DataFrame, rich: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Shares are found on the narrow lines, before those are widened."""
        totals = self.orders().select(F.col("id").alias("order_id"), "final_total_amount")
        shares = split_amount(
            self.details().join(totals, "order_id"),
            "final_total_amount",
            "order_price",
            "order_id",
            ["line_no", "id"],
        )
        return widen(orders, rich(shares.drop("final_total_amount")))

    def order_totals(self) -> DataFrame:
        """Days and amounts of the orders that have a line: the lines' shares of an order add
        up to its amount, so the shares themselves are not needed."""
        used = self.details().select(F.col("order_id").alias("id"))
        return order_time_parts(self.orders()).join(used, "id", "left_semi").select(
            F.col("create_date").alias("dt"), F.col("final_total_amount").alias("final_detail_amount")
        )

    def purchase_wide(self) -> DataFrame:
        """Purchases as wide rows of one line each: the share is the whole amount."""
        return order_time_parts(self.purchases()).select(
            F.col("id").alias("order_id"),
            F.col("create_date").alias("dt"),
            "create_time",
            F.col("final_total_amount").alias("final_detail_amount"),
        )


def with_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Orders with the gender of their user and the age group on the day of the order."""
    rich = enrich(orders, users, {"user_id": "id"}, {"gender": "user_gender", "birthday": "_birthday"})
    return age_group(rich, "_birthday", F.col("create_date"), "user_age_group").drop("_birthday")

