"""Columns of vectors as whole numbers, inside tasks.

A vector that is null, or holds a null or a component that is not finite, is not usable. A
component becomes floor(factor * x); beyond 62 bits it counts as plus or minus 2^62. Shorter
vectors are filled up with zeros. An empty table has no usable rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP = float(1 << 62)


def usable_vectors(rows: DataFrame, vector: Column, *columns: Column) -> DataFrame:
    """`columns` and `vector` (doubles) of the rows whose vector is usable."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    narrow = rows.select(*columns, vector.cast("array<double>").alias("vector"))
    return narrow.where(F.col("vector").isNotNull() & F.forall("vector", finite))


def extent(rows: DataFrame) -> tuple[int, float]:
    """(components of the longest vector, greatest absolute component); (-1, 0) without rows."""
    largest = F.greatest(F.array_max("vector"), -F.array_min("vector"))
    size, top = rows.agg(F.max(F.size("vector")), F.max(largest)).first()
    return (-1, 0.0) if size is None else (size, top or 0.0)


def integers(column: pa.Array, factor: float, dims: int) -> np.ndarray:
    """(rows, dims) whole numbers of an Arrow column of usable vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), dims), dtype=np.int64)
    if not len(column):
        return out
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.float64)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(values * factor), -TOP, TOP).astype(np.int64)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(whole)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = whole
    return out


def smallest_type(top: float) -> np.dtype:
    """The narrowest type for whole numbers of up to `top` in size, with room for the floor."""
    return np.dtype(next((t for t, bits in (("<i2", 15), ("<i4", 31)) if top + 1 < 2**bits), "<i8"))
