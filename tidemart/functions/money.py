"""Money as exact numbers: decimals at rest, whole cents inside divisions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.schemas import MONEY, MONEY_SUM


def money(col: Column) -> Column:
    return col.cast(MONEY)


def total(col: Column) -> Column:
    """A sum that is zero, not null, over no rows."""
    return F.coalesce(F.sum(col), F.lit(0)).cast(MONEY_SUM)


def cents(amount: Column) -> Column:
    """The amount in whole cents, wide enough for the product of two amounts."""
    return (amount.cast(MONEY) * 100).cast("decimal(19,0)")


def from_cents(value: Column) -> Column:
    return (value.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)
