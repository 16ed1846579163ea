"""Dashboard numbers: totals, hourly series, shares, sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.money import total
from tidemart.operators.devices import dau_total, new_mid_total
from tidemart.schemas import MONEY_SUM
from tidemart.sources.tables import previous_day

# The dashboard's card ids and titles.
CARDS = {"dau": "新增日活", "new_mid": "新增设备", "order_amount": "新增交易额"}


def order_total_amount(wide: DataFrame, dt: str | None = None) -> DataFrame:
    """Amount per day; a single day always gives one row, zero if it has no orders."""
    amount = total(F.col("final_detail_amount")).alias("order_total_amount")
    if dt is None:
        return wide.groupBy("dt").agg(amount)
    return wide.where(F.col("dt") == dt).agg(amount).select(F.lit(dt).alias("dt"), "order_total_amount")


def order_hour_amount(wide: DataFrame, dt: str | None = None) -> DataFrame:
    """Amount per day and two-digit hour."""
    rows = wide if dt is None else wide.where(F.col("dt") == dt)
    hour = F.substring("create_time", 12, 2).alias("hr")
    return rows.groupBy("dt", hour).agg(total(F.col("final_detail_amount")).alias("order_amount"))


def hour_compare(hourly: DataFrame, value: str, dt: str | None = None, zero_fill: bool = True) -> DataFrame:
    """(dt, hr, yesterday, today) of an hourly series (dt, hr, value).

    Every row counts for its own day and, shifted, for the day after: one pass and
    one aggregation, no self-join. With `zero_fill` each day has hours 00 to 23.
    """
    kind = hourly.schema[value].dataType
    zero = F.lit(0).cast(kind)
    series = hourly if dt is None else hourly.where(F.col("dt").isin(dt, previous_day(dt)))
    next_day = F.date_add(F.to_date("dt"), 1).cast("string")
    both = series.select(
        F.inline(
            F.array(
                F.struct(F.col("dt").alias("dt"), "hr", F.col(value).alias("today"), zero.alias("yesterday")),
                F.struct(next_day.alias("dt"), "hr", zero.alias("today"), F.col(value).alias("yesterday")),
            )
        )
    )
    if dt is not None:
        both = both.where(F.col("dt") == dt)
    if zero_fill:
        both = both.unionByName(_hour_axis(both, dt, zero))
    return both.groupBy("dt", "hr").agg(
        F.sum("yesterday").cast(kind).alias("yesterday"), F.sum("today").cast(kind).alias("today")
    )


def _hour_axis(rows: DataFrame, dt: str | None, zero: Column) -> DataFrame:
    """24 empty hours for each day of the rows, or for the one day asked for."""
    days = (
        rows.select("dt").distinct()
        if dt is None
        else rows.sparkSession.range(1).select(F.lit(dt).alias("dt"))
    )
    hour = F.explode(F.sequence(F.lit(0), F.lit(23)))
    return days.select("dt", hour.alias("_h")).select(
        "dt",
        F.lpad(F.col("_h").cast("string"), 2, "0").alias("hr"),
        zero.alias("today"),
        zero.alias("yesterday"),
    )


def hour_map(hourly: DataFrame, value: str) -> DataFrame:
    """Per day one map hour -> value; a day has 24 hours at most."""
    return hourly.groupBy("dt").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("hr", value)))).alias("hours")
    )


def realtime_total(dau: DataFrame, wide: DataFrame, dt: str | None = None) -> DataFrame:
    """The three cards (dt, id, name, value) of every day, or of one day, where a
    card without data is zero."""
    parts = {
        "dau": dau_total(dau).select("dt", F.col("n").alias("value")),
        "new_mid": new_mid_total(dau).select("dt", F.col("n").alias("value")),
        "order_amount": order_total_amount(wide).select("dt", F.col("order_total_amount").alias("value")),
    }
    cards = None
    for card, rows in parts.items():
        if dt is not None:
            value = F.coalesce(F.sum("value"), F.lit(0))
            rows = rows.where(F.col("dt") == dt).agg(value.alias("value")).withColumn("dt", F.lit(dt))
        shaped = rows.select(
            "dt",
            F.lit(card).alias("id"),
            F.lit(CARDS[card]).alias("name"),
            F.col("value").cast(MONEY_SUM).alias("value"),
        )
        cards = shaped if cards is None else cards.unionByName(shaped)
    return cards


def share_by(df: DataFrame, col: str) -> DataFrame:
    """(col, n, share of all rows). The total is summed from the groups' counts, so
    the rows are read once and no window gathers the groups."""
    groups = df.groupBy(col).agg(F.count("*").alias("n"))
    everything = groups.agg(F.sum("n").alias("t")).scalar()
    return groups.withColumn("share", F.col("n") / everything)


def sales_by(wide: DataFrame, col: str, measure: str, out: str = "sales") -> DataFrame:
    """Sum of a measure and number of rows per value of a column."""
    decimal = wide.schema[measure].dataType.simpleString().startswith("decimal")
    amount = total(F.col(measure)) if decimal else F.coalesce(F.sum(measure), F.lit(0))
    return wide.groupBy(col).agg(amount.alias(out), F.count("*").alias("n"))


def bin_sales(sales: DataFrame, value: str, width: float = 100, bins: int = 6) -> DataFrame:
    """Number of values per bin of equal width; the last bin is open upwards."""
    number = F.least(F.lit(bins - 1), F.floor(F.col(value) / F.lit(width))).cast("int")
    return sales.groupBy(number.alias("bin")).agg(F.count("*").alias("n"))


def sliding_counts(df: DataFrame, ts: str, size: str = "15 seconds", slide: str = "5 seconds") -> DataFrame:
    """Rows per sliding time window; works on a batch and on a watermarked stream."""
    counts = df.groupBy(F.window(ts, size, slide)).agg(F.count("*").alias("n"))
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n"
    )
