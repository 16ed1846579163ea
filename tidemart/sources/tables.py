"""Table scans: whole tables, single days, streams over table files, SQL rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.text import json_text


def previous_day(day: str) -> str:
    """The day before; text that is not a `yyyy-MM-dd` day is an error."""
    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Make the folder if nothing has been written to it yet, so that it reads as empty."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files of a folder."""
    fs, target = _file_system(spark, path)
    return fs.getContentSummary(target).getLength()


def read_table(
    spark: SparkSession, folder: str, name: str, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as a stream of its files (one file or a folder of files)."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    fs, target = _file_system(spark, path)
    if fs.getFileStatus(target).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def read_day(spark: SparkSession, path: str, day: str, prev_days: int = 0) -> DataFrame:
    """One day of a table partitioned by `dt`, or by `month` with a column `dt`, with the
    days before it if asked.

    The predicate is on the partition column, so other days or months are never listed.
    """
    last = dt.date.fromisoformat(day)
    days = [(last - dt.timedelta(days=i)).isoformat() for i in range(prev_days + 1)]
    rows = spark.read.parquet(path)
    # Days and months stay text even where Spark would infer a date from folder names.
    if "month" in rows.columns:
        rows = rows.where(F.col("month").cast("string").isin(sorted({d[:7] for d in days})))
        return rows.where(F.col("dt").isin(days)).drop("month")
    return rows.where(F.col("dt").cast("string").isin(days))


def between_days(df: DataFrame, ts_col: str, first: str, last: str) -> DataFrame:
    """Rows of whole days, as a range on the time column that the scan can push down."""
    end = (dt.date.fromisoformat(last) + dt.timedelta(days=1)).isoformat()
    ts_type = df.schema[ts_col].dataType.simpleString()
    return df.where(
        (F.col(ts_col) >= F.lit(first).cast(ts_type)) & (F.col(ts_col) < F.lit(end).cast(ts_type))
    )


def sql_to_json_rows(spark: SparkSession, sql: str) -> DataFrame:
    """Run a query and return every row as one JSON object, as a table."""
    return spark.sql(sql).select(json_text().alias("json"))
