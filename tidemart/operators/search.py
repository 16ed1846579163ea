"""Paged search with an optional keyword."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.text import highlight


def search_page(
    df: DataFrame,
    filters: Column | None = None,
    keyword: str = "",
    keyword_col: str | None = None,
    order_by: Iterable[str] = (),
    offset: int = 0,
    limit: int = 20,
    match_mode: str = "score",
) -> DataFrame:
    """One page of the matching rows in a total order, with the number of all hits.

    match_mode 'score': the keyword only marks rows (columns `highlighted` and
    `matched`), it does not drop any. 'filter': rows without the keyword are
    dropped. `offset` counts rows. The page is a top-k, so no full sort is run, and
    the hits are counted by an aggregate of their own.
    """
    if match_mode not in ("score", "filter"):
        raise ValueError(f"unknown match mode: {match_mode}")
    hits = df if filters is None else df.where(filters)
    if keyword and keyword_col:
        found = F.contains(F.lower(F.col(keyword_col)), F.lit(keyword.lower()))
        if match_mode == "filter":
            hits = hits.where(found)
    total = hits.agg(F.count("*").alias("n")).scalar()
    page = hits.orderBy(*order_by).offset(offset).limit(limit)
    if keyword and keyword_col:
        page = page.withColumns(
            {
                "highlighted": highlight(F.col(keyword_col), keyword),
                "matched": F.coalesce(found, F.lit(False)),
            }
        )
    return page.withColumn("total", total)


def sale_detail_page(
    wide: DataFrame, dt: str | None, keyword: str = "", offset: int = 0, limit: int = 20
) -> DataFrame:
    """Lines of a day (or of all days) whose sku name contains the keyword."""
    return search_page(
        wide,
        filters=None if dt is None else F.col("dt") == dt,
        keyword=keyword,
        keyword_col="sku_name",
        order_by=("dt", "order_id", "order_detail_id"),
        offset=offset,
        limit=limit,
        match_mode="filter",
    )
