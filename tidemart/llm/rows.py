"""Rows that pass a Python task: the text beside all other columns, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, text): every column but the text in one struct, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    row = F.struct(*rest) if rest else F.struct(F.lit(None).cast("int").alias("_"))
    return docs.select(row.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))


def unpacked(rows: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The columns that `packed` was given, in their order."""
    return rows.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in columns])


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo `parts`."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(False))


def may_train(doc_id: Column, parts: int = 5) -> Column:
    """The documents that may be learned from; one without id may not."""
    return doc_id.isNotNull() & (F.crc32(doc_id.cast("string").cast("binary")) % parts != 0)
