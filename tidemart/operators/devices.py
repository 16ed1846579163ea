"""Daily active and new devices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import day_text, hour_text, minute_text

LOG_FIELDS = ("uid", "ar", "ch", "vc")


def dau_info(logs: DataFrame) -> DataFrame:
    """Logs with their day, hour and minute, from the epoch milliseconds `ts`."""
    at = F.timestamp_millis("ts")
    return logs.select(
        "mid",
        *LOG_FIELDS,
        day_text(at).alias("dt"),
        hour_text(at).alias("hr"),
        minute_text(at).alias("mi"),
        "ts",
    )


def first_log_per_day(logs: DataFrame, tie: str = "log_id") -> DataFrame:
    """The first log of every device and day, with the fields of that log.

    A `min` over (ts, tie, fields) instead of a ranking window: each task keeps one
    row per device and day before the shuffle, so a very busy device costs nothing.
    """
    day = F.to_date(F.timestamp_millis("ts")).alias("_day")
    first = logs.groupBy("mid", day).agg(F.min(F.struct("ts", tie, *LOG_FIELDS)).alias("_f"))
    return dau_info(first.select("mid", "_f.*")).select(
        "mid", *LOG_FIELDS, "dt", "hr", "mi", "ts"
    )


def device_days(logs: DataFrame) -> DataFrame:
    """Device, day and hour of the first log: all that the counts below need.

    Only a number is aggregated, so this stays a hash aggregate.
    """
    day = F.to_date(F.timestamp_millis("ts")).alias("dt")
    first = logs.groupBy("mid", day).agg(F.min("ts").alias("ts"))
    return first.select(
        "mid", F.col("dt").cast("string").alias("dt"), hour_text(F.timestamp_millis("ts")).alias("hr"), "ts"
    )


def dau_total(dau: DataFrame, dt: str | None = None) -> DataFrame:
    """Active devices per day; a single day always gives one row, zero if empty."""
    if dt is None:
        return dau.groupBy("dt").agg(F.count("*").alias("n"))
    return dau.where(F.col("dt") == dt).agg(F.count("*").alias("n")).select(F.lit(dt).alias("dt"), "n")


def dau_hour_count(dau: DataFrame, dt: str | None = None) -> DataFrame:
    """Active devices per hour of their first log; a single day keeps its top 24 groups."""
    if dt is None:
        return dau.groupBy("dt", "hr").agg(F.count("*").alias("n"))
    hours = dau.where(F.col("dt") == dt).groupBy("dt", "hr").agg(F.count("*").alias("n"))
    return hours.orderBy(F.desc("n"), "hr").limit(24)


def new_mid_total(dau: DataFrame) -> DataFrame:
    """Devices per day of their first appearance ever."""
    first = dau.groupBy("mid").agg(F.min("dt").alias("dt"))
    return first.groupBy("dt").agg(F.count("*").alias("n"))
