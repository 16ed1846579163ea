"""Counts and amounts per day and hour, kept up to date batch by batch.

Each batch adds what it changes: plus for rows that count from now on, minus for those they
replace. The changes of a batch are a few rows (day, hour), in a folder of the batch, so a
batch that is repeated replaces its own, and the dashboard sums up small numbers instead of
reading the facts.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemart import schemas
from tidemart.schemas import T
from tidemart.sources.keyed import KeyedTable
from tidemart.sources.sinks import append_batch, latest_by_id
from tidemart.sources.tables import ensure_folder


class RollUp:
    """Of all versions of a key one counts: the greatest by `newest` or the least by `oldest`,
    a whole number. It adds 1 and its `amount` to its (dt, hr).

    The version that counts is kept by key, in buckets, with the one that counted before its
    batch: a repeated batch then finds what its first run found. The stored state goes back
    by one batch, as a job only ever repeats its last.
    """

    def __init__(
        self,
        path: str,
        keys: Iterable[str],
        amount: DataType,
        newest: str | None = None,
        oldest: str | None = None,
        buckets: int = 64,
    ) -> None:
        if (newest is None) == (oldest is None):
            raise ValueError("a version is either the newest or the oldest that counts")
        self.path, self.keys = path, list(keys)
        self.order, self.greatest = newest or oldest, newest is not None
        self.fact = schemas.struct(dt=schemas.TEXT, hr=schemas.TEXT, amount=amount, version=schemas.LONG)
        # A key may also be the day.
        self._named = {f"key_{k}": k for k in self.keys}
        keyed = [T.StructField(k, schemas.TEXT) for k in self._named]
        shape = T.StructType([*keyed, T.StructField("now", self.fact), T.StructField("was", self.fact)])
        self.current = KeyedTable(f"{path}/current", shape, self._named, newest=["batch_id"], buckets=buckets)

    def save(self, batch: DataFrame, batch_id: int) -> None:
        """Merge a batch of (keys, dt, hr, amount, version column)."""
        spark = batch.sparkSession
        version = F.col(self.order).cast("bigint").alias("version")
        amount = F.col("amount").cast(self.fact["amount"].dataType).alias("amount")
        keys = [F.col(k).cast("string").alias(name) for name, k in self._named.items()]
        rows = batch.select(*keys, "dt", "hr", amount, version)
        rule = {"newest": ["version"]} if self.greatest else {"oldest": ["version"]}
        new = latest_by_id(rows, self._named, **rule).select(
            *self._named, F.struct("dt", "hr", "amount", "version").cast(self.fact).alias("new")
        )
        stored = self.current.read_for(new.select(*self._named))
        # What counted before this batch, also if the batch has been here.
        before = F.when(F.col("batch_id") == batch_id, F.col("was")).otherwise(F.col("now"))
        known = stored.select(F.struct(*self._named).alias("_key"), before.alias("was"))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key.{k}")) for k in self._named])
        both = new.join(known, same, "left")
        better = F.col("new.version") > F.col("was.version")
        if not self.greatest:
            better = F.col("new.version") < F.col("was.version")
        wins = F.col("was").isNull() | F.coalesce(better, F.lit(False))
        now = F.when(wins, F.col("new")).otherwise(F.col("was"))
        # A key that stays as it is is stored as well: what counted before it is known then.
        decided = both.select(*self._named, now.alias("now"), "was", wins.alias("_wins")).persist()
        try:
            change = lambda fact, sign: F.struct(
                F.col(f"{fact}.dt").alias("dt"),
                F.col(f"{fact}.hr").alias("hr"),
                F.lit(sign).cast("bigint").alias("n"),
                (F.col(f"{fact}.amount") * sign).cast(self._sum()).alias("amount"),
            )
            moved = decided.where("_wins").select(
                F.inline(F.array_compact(F.array(change("now", 1), F.when(F.col("was").isNotNull(), change("was", -1)))))
            )
            changes = moved.groupBy("dt", "hr").agg(F.sum("n").alias("n"), F.sum("amount").cast(self._sum()).alias("amount"))
            append_batch(changes, batch_id, f"{self.path}/changes", ())
            self.current.save(decided.drop("_wins"), batch_id)
        finally:
            decided.unpersist()

    def _sum(self) -> DataType:
        return schemas.MONEY_SUM if isinstance(self.fact["amount"].dataType, T.DecimalType) else schemas.LONG

    def read(self, spark: SparkSession) -> DataFrame:
        """(dt, hr, n, amount) of every hour that something counts in."""
        shape = schemas.struct(dt=schemas.TEXT, hr=schemas.TEXT, n=schemas.LONG, amount=self._sum())
        changes = spark.read.schema(shape).parquet(ensure_folder(spark, f"{self.path}/changes"))
        sums = changes.groupBy("dt", "hr").agg(F.sum("n").alias("n"), F.sum("amount").cast(self._sum()).alias("amount"))
        return sums.where(F.col("n") != 0)
