"""Dimension tables: upserts by key and lookups."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_latest(
    snapshot: DataFrame,
    changes: DataFrame,
    keys: Iterable[str],
    version_cols: Iterable[str],
    deletes: str = "upsert",
    type_col: str = "type",
) -> DataFrame:
    """The table after the changes: per key the row with the greatest version.

    A snapshot without version columns counts as older than any change. With
    deletes='upsert' a delete record is a row like any other; with 'remove' a key
    whose newest record is a delete disappears. Versions of one key merge before
    the shuffle.
    """
    if deletes not in ("upsert", "remove"):
        raise ValueError(f"unknown delete mode: {deletes}")
    keys, versions = list(keys), list(version_cols)
    data = [c for c in snapshot.columns if c not in keys and c not in versions]
    kind = F.lower(F.col(type_col)) if type_col in changes.columns else F.lit(None)
    missing = [v for v in versions if v not in snapshot.columns]
    dated = snapshot.withColumns(
        {v: F.lit(None).cast(changes.schema[v].dataType) for v in missing}
    )
    shape = [*keys, *versions, *data]
    rows = dated.select(*shape, F.lit(0).alias("_new"), F.lit(False).alias("_gone")).unionByName(
        changes.select(
            *shape,
            F.lit(1).alias("_new"),
            F.coalesce(kind == "delete", F.lit(False)).alias("_gone"),
        )
    )
    newest = F.max(F.struct(*versions, "_new", "_gone", *data)).alias("_r")
    merged = rows.groupBy(*keys).agg(newest)
    if deletes == "remove":
        merged = merged.where(~F.col("_r._gone"))
    return merged.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*versions, *data]])


def enrich(fact: DataFrame, dim: DataFrame, on: dict[str, str], cols: dict[str, str]) -> DataFrame:
    """Left-join dimension columns to a fact: on={fact column: dim key}, cols={dim
    column: new name}.

    Key types of facts and dimensions differ, so a dimension key is cast to the fact's
    type; one that cannot be is a key no fact has.
    No broadcast is forced: Spark broadcasts a dimension only below its size
    threshold, measured at run time, and shuffles beyond it. The fact is the left
    side, which AQE splits where one key is hot. Dimension keys must be unique.
    """
    small = dim.select(
        *[F.col(key).try_cast(fact.schema[c].dataType).alias(f"_k_{c}") for c, key in on.items()],
        *[F.col(c).alias(new) for c, new in cols.items()],
    )
    condition = reduce(and_, [fact[c] == small[f"_k_{c}"] for c in on])
    kept = [fact[c] for c in fact.columns if c not in cols.values()]
    return fact.join(small, condition, "left").select(*kept, *[small[new] for new in cols.values()])


def enrich_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    return enrich(
        orders,
        provinces,
        {"province_id": "id"},
        {
            "name": "province_name",
            "area_code": "province_area_code",
            "iso_3166_2": "province_iso_3166_2",
        },
    )


def enrich_sku(
    details: DataFrame, skus: DataFrame, spus: DataFrame, trademarks: DataFrame, categories: DataFrame
) -> DataFrame:
    """Order lines with their sku's ids and the names behind them."""
    # The small tables are joined to the skus first: one pass over the lines, and a
    # join between tables that are far smaller than the lines.
    sku = skus.select("id", "spu_id", "tm_id", "category3_id", F.col("sku_name").alias("_name"))
    sku = enrich(sku, spus, {"spu_id": "id"}, {"spu_name": "spu_name"})
    sku = enrich(sku, trademarks, {"tm_id": "tm_id"}, {"tm_name": "tm_name"})
    sku = enrich(sku, categories, {"category3_id": "id"}, {"name": "category3_name"})
    added = ("spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name", "_name")
    rich = enrich(details, sku, {"sku_id": "id"}, {c: c for c in added})
    return rich.withColumn("sku_name", F.coalesce("sku_name", "_name")).drop("_name")
