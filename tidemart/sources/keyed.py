"""Tables kept by key: one row per key, in folders by hash of the key.

A micro-batch reads and rewrites only the buckets its keys fall into, by Spark's dynamic
partition overwrite, so its cost follows the batch and not the history. A row is the least
or the greatest of all versions of its key, so merging a batch again changes nothing.

The changes of every batch are also kept, by batch. The first batch after a start merges the
kept changes of its buckets too: should the driver have been lost while it replaced
folders, the batch it repeats brings the rows back.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemart.sources.sinks import append_batch, latest_by_id
from tidemart.sources.tables import ensure_folder


class KeyedTable:
    """A table of `schema`, one row per `keys`: the greatest by `newest`, or the least by
    `oldest`; both may name `batch_id`. `buckets` is fixed for the life of the table: about
    its size over what one task should read."""

    def __init__(
        self,
        path: str,
        schema: StructType,
        keys: Iterable[str],
        newest: Iterable[str] = (),
        oldest: Iterable[str] = (),
        buckets: int = 64,
    ) -> None:
        self.path, self.keys, self.buckets = path, list(keys), buckets
        self.newest, self.oldest = list(newest), list(oldest)
        self.schema = StructType([*schema.fields, StructField("batch_id", LongType())])
        self._stored = StructType([*self.schema.fields, StructField("bucket", IntegerType())])
        self._started = False

    def _bucket(self, keys: Iterable[Column]) -> Column:
        # As text, so that keys of another number type meet the same bucket.
        return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(self.buckets)).cast("int")

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._stored).parquet(ensure_folder(spark, f"{self.path}/rows"))

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table, with the batch of every row."""
        return self._rows(spark).drop("bucket")

    def read_for(self, keys: DataFrame) -> DataFrame:
        """The rows of the buckets that the keys (columns named as the table's) fall into:
        other folders are not listed. At most `buckets` numbers pass the driver."""
        return self._touched(keys.sparkSession, keys).drop("bucket")

    def _touched(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        numbers = keys.select(self._bucket([F.col(k) for k in self.keys]).alias("b")).distinct().collect()
        return self._rows(spark).where(F.col("bucket").isin(sorted(r["b"] for r in numbers)))

    def save(self, batch: DataFrame, batch_id: int) -> None:
        """Merge the rows of one micro-batch."""
        spark = batch.sparkSession
        names = [f.name for f in self.schema.fields if f.name != "batch_id"]
        own = batch.select(*names).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        own = latest_by_id(own, self.keys, self.newest, self.oldest)
        append_batch(own.drop("batch_id"), batch_id, f"{self.path}/changes", ())
        kept = spark.read.schema(self.schema).parquet(f"{self.path}/changes")
        bucket = self._bucket([F.col(k) for k in self.keys])
        new = kept.where(F.col("batch_id") == batch_id)
        old = self._touched(spark, new)
        if self._started:
            changes = new.withColumn("bucket", bucket)
        else:
            numbers = new.select(bucket.alias("bucket")).distinct()
            changes = kept.withColumn("bucket", bucket).join(numbers, "bucket", "left_semi")
        both = old.unionByName(changes.select(*self._stored.names))
        merged = latest_by_id(both, [*self.keys, "bucket"], self.newest, self.oldest)
        (
            merged.hint("rebalance", F.col("bucket"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(f"{self.path}/rows")
        )
        self._started = True
