"""Column expressions for days, hours and ages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the three age groups of the dashboard.
AGE_UNDER_20 = "20岁以下"
AGE_20_TO_30 = "20-30岁"
AGE_OVER_30 = "30岁以上"


def day_text(ts: Column) -> Column:
    """`yyyy-MM-dd`; a plain cast, which is far cheaper than a formatter per row."""
    return F.to_date(ts).cast("string")


def hour_text(ts: Column) -> Column:
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def minute_text(ts: Column) -> Column:
    return F.lpad(F.minute(ts).cast("string"), 2, "0")


def second_text(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss`, the time format of the order tables."""
    return F.date_trunc("second", ts).cast("string")


def order_time_parts(orders: DataFrame, time_col: str = "create_time") -> DataFrame:
    """Add create_date and create_hour, cut from the text; short text gives null."""
    parts = F.split(F.col(time_col), " ")
    clock = F.split(F.get(parts, F.lit(1)), ":")
    return orders.withColumns(
        {"create_date": F.get(parts, F.lit(0)), "create_hour": F.get(clock, F.lit(0))}
    )


def age_group(df: DataFrame, birthday: str, as_of: str | Column, out: str = "age_group") -> DataFrame:
    """Add the age group on the day `as_of`, from completed years."""
    born = F.col(birthday).cast("date")
    today = F.to_date(F.lit(as_of) if isinstance(as_of, str) else as_of)
    month_day = lambda c: F.month(c) * 100 + F.dayofmonth(c)
    had_birthday = (month_day(today) >= month_day(born)).cast("int")
    years = F.year(today) - F.year(born) - 1 + had_birthday
    return df.withColumn(
        out,
        F.when(years < 20, F.lit(AGE_UNDER_20))
        .when(years <= 30, F.lit(AGE_20_TO_30))
        .when(years > 30, F.lit(AGE_OVER_30)),
    )
