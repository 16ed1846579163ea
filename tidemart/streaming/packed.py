"""Rows as bytes, so that many of them lie in one entry of a state store."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq


def pack(rows: pd.DataFrame) -> bytes:
    return pack_table(pa.Table.from_pandas(rows, preserve_index=False))


def pack_table(table: pa.Table) -> bytes:
    """Whole numbers and times are kept as differences, so rows in order of their time take
    about half the bytes."""
    table = table.replace_schema_metadata()
    steps = {f.name: "DELTA_BINARY_PACKED" for f in table.schema if pa.types.is_integer(f.type) or pa.types.is_timestamp(f.type)}
    sink = pa.BufferOutputStream()
    pq.write_table(
        table, sink, compression="zstd", use_dictionary=False, column_encoding=steps, write_statistics=False, store_schema=False
    )
    return sink.getvalue().to_pybytes()


def unpack(data: bytes, columns: Sequence[str] | None = None) -> pa.Table:
    with pq.ParquetFile(pa.py_buffer(bytes(data))) as file:
        return file.read(columns, use_threads=False)
