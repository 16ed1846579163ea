"""Pages far into a large sorted table.

A top-k for page n reads everything and keeps n pages. A table that is paged often is stored
in ranges of its order instead, split by a sample, with the number of rows of each: a page
then opens the one or two ranges that hold it.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

Order = Iterable[str | Column]


def store_ranges(df: DataFrame, path: str, order_by: Order, ranges: int = 64) -> None:
    """Store the rows in about `ranges` folders of neighbouring rows, and their counts.
    `order_by` must be a total order, so that rows with one value of its first column, however
    many, are split as well."""
    order = list(order_by)
    dealt = df.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id())
    dealt.sortWithinPartitions("part", *order).write.mode("overwrite").partitionBy("part").parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("part", IntegerType())])).parquet(f"{path}/rows")
    counts = stored.groupBy("part").agg(F.count("*").alias("n"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")
    # An empty table has no folders that would tell its columns.
    df.limit(0).write.mode("overwrite").parquet(f"{path}/shape")


def ranged_page(spark: SparkSession, path: str, order_by: Order, offset: int, limit: int) -> DataFrame:
    """The rows `offset` to `offset + limit` of a table kept by `store_ranges` in the same
    order. The counts, one row per range, come to the driver."""
    counts = sorted((r["part"], r["n"]) for r in spark.read.schema("part int, n bigint").parquet(f"{path}/counts").collect())
    ends = list(accumulate(n for _, n in counts))
    inside = [
        (part, end - n) for (part, n), end in zip(counts, ends) if end > offset and end - n < offset + limit
    ]
    shape = spark.read.parquet(f"{path}/shape").schema
    stored = spark.read.schema(StructType([*shape.fields, StructField("part", IntegerType())])).parquet(f"{path}/rows")
    rows = stored.where(F.col("part").isin([part for part, _ in inside])).drop("part")
    before = inside[0][1] if inside else 0
    return rows.orderBy(*order_by).offset(offset - before if inside else 0).limit(limit)
