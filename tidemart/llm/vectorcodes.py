"""Vectors as short codes: product quantisation over dictionaries of whole numbers.

A vector becomes whole numbers floor(factor * x) and is cut into equal parts; every part
position has a codebook, and a vector's code is the number of the nearest entry (squared
Euclidean distance, ties to the lower number) for each part. Codebooks start as the parts of
the vectors with the least ids; a round assigns all parts and moves every entry to the
floored mean of its parts. Entries without parts stay.

No difference is computed twice. Vectors are stored once, in chunks: each dimension of a
chunk keeps the sorted dictionary of its different whole numbers and one short number a
vector. For every dictionary value the squared differences to all entries are tabulated, and
a part's distances are rows of those tables, gathered by dictionary number and added up. A
chunk's tables are bounded by its rows, whatever the range of values. Sums of a round leave
each task as one row per entry and component, merge in Spark, and the driver only sees the
codebooks.

Results for odd input: vectors that are null or hold null or non-finite components are
dropped; shorter vectors, and a length that does not divide by the parts, are filled up with
zeros; with fewer vectors than entries the codebooks have as many entries as there are
vectors; repeated rows count as often as they stand; rows without id come last in the choice
of first entries; whole numbers are exact at any size, and an error beyond 64 bits stops at
the greatest 64-bit number; other columns are not looked at; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.components import written
from tidemart.llm.vectors import extent, integers, usable_vectors
from tidemart.session import work_dir

CHUNK = 8192
_MOST = (1 << 63) - 1
_LOW = (1 << 32) - 1


# Inside tasks ----------------------------------------------------------------------------


def dictionaries(whole: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different numbers of every dimension, and (dimensions, rows) numbers into them."""
    values, codes = [], np.zeros(whole.shape[::-1], dtype=np.uint16)
    for j in range(whole.shape[1]):
        found, codes[j] = np.unique(whole[:, j], return_inverse=True)
        values.append(found)
    return values, codes


def _chunks(dims: int, factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(low, CHUNK)
                values, codes = dictionaries(integers(batch.column("vector"), factor, dims))
                one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
                flat = np.concatenate(values) if values else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        one(batch.column("vec_id")),
                        one(batch.column("label")),
                        pa.array([[len(v) for v in values]], pa.list_(pa.int32())),
                        pa.array([flat.tobytes()], pa.binary()),
                        pa.array([codes.tobytes()], pa.binary()),
                    ],
                    names=["vec_id", "label", "sizes", "dictionary", "codes"],
                )

    return run


def _stored(batch: pa.RecordBatch, i: int) -> tuple[list[np.ndarray], np.ndarray]:
    sizes = batch.column("sizes")[i].as_py()
    flat = np.frombuffer(batch.column("dictionary")[i].as_py(), dtype=np.int64)
    codes = np.frombuffer(batch.column("codes")[i].as_py(), dtype=np.uint16)
    n = len(batch.column("vec_id")[i])
    return np.split(flat, np.cumsum(sizes)[:-1]) if sizes else [], codes.reshape(len(sizes), n)


def _wide(values: list[np.ndarray], books: np.ndarray) -> bool:
    """Whether sums of squared differences, or of a chunk's numbers, may leave 64 bits."""
    top = max([int(np.abs(v).max(initial=0)) for v in values] + [abs(int(x)) for x in books.ravel()], default=0)
    return (2 * top) ** 2 * max(books.shape[2], 1) >= 1 << 62 or top * CHUNK >= 1 << 62


def assign(values: list[np.ndarray], codes: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, its squared distance) of every part and row; `books` holds the entries
    by part, number and component."""
    parts, entries, width = books.shape
    kind = object if _wide(values, books) else np.int64
    n = codes.shape[1]
    nearest = np.zeros((parts, n), dtype=np.int64)
    error = np.zeros((parts, n), dtype=kind)
    for p in range(parts):
        far = np.zeros((n, entries), dtype=kind)
        for k in range(width):
            j = p * width + k
            table = (values[j].astype(kind)[:, None] - books[p, :, k].astype(kind)) ** 2
            far += table[codes[j]]
        nearest[p] = far.argmin(axis=1)
        error[p] = far[np.arange(n), nearest[p]]
    return nearest, error


def _sums(books: np.ndarray):
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), dtype=object)  # the last is the count
        for batch in batches:
            for i in range(batch.num_rows):
                values, codes = _stored(batch, i)
                kind = object if _wide(values, books) else np.int64
                nearest, _ = assign(values, codes, books)
                for p in range(parts):
                    own = range(p * width, (p + 1) * width)
                    numbers = np.stack([values[j].astype(kind)[codes[j]] for j in own], axis=1) if width else None
                    for e in range(entries):
                        rows = nearest[p] == e
                        total[p, e, width] += int(np.count_nonzero(rows))
                        if width:
                            total[p, e, :width] += numbers[rows].sum(axis=0).astype(object)
        flat = [int(x) for x in total.ravel()]
        # In two halves, so that sums of any size add up in 64 bits.
        columns = [range(len(flat)), [x >> 32 for x in flat], [x & _LOW for x in flat]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cell", "high", "low"])

    return run


def _coded(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                nearest, error = assign(*_stored(batch, i), books)
                total = [min(int(x), _MOST) for x in error.sum(axis=0)]
                offsets = np.arange(nearest.shape[1] + 1, dtype=np.int32) * len(nearest)
                code = pa.ListArray.from_arrays(pa.array(offsets), pa.array(nearest.T.ravel().astype(np.int32)))
                ids, labels = (batch.column(c)[i].values for c in ("vec_id", "label"))
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, code, pa.array(total, pa.int64())], names=["vec_id", "label", "code", "error"]
                )

    return run


# The operator ----------------------------------------------------------------------------


def moved(books: np.ndarray, sums: dict[int, int]) -> np.ndarray:
    """The codebooks after a round, from the sums and counts by cell."""
    parts, entries, width = books.shape
    out = books.copy()
    for p in range(parts):
        for e in range(entries):
            cell = (p * entries + e) * (width + 1)
            count = sums.get(cell + width, 0)
            if count:
                out[p, e] = [sums[cell + k] // count for k in range(width)]
    return out


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    factor: float = 4096,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error) of every usable vector, the codebooks): code holds the
    number of an entry per part, error the sum of the squared distances to them. Codebooks
    are whole numbers by part, entry and component."""
    spark = vectors.sparkSession
    usable = usable_vectors(
        vectors,
        F.col(f"`{vector_col}`"),
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.col(f"`{label_col}`").alias("label"),
    )
    label = T.StructField("label", usable.schema["label"].dataType)
    number = T.StructField("vec_id", T.LongType())
    shape = T.StructType(
        [number, label, T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())]
    )
    size, _ = extent(usable)
    if size < 0:
        return spark.createDataFrame([], shape), np.zeros((parts, 0, 0), dtype=object)
    dims = -(-size // parts) * parts
    width = dims // parts
    first = usable.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    start = integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), factor, dims)
    books = start.astype(object).reshape(len(first), parts, width).transpose(1, 0, 2)

    many = lambda f: T.StructField(f.name, T.ArrayType(f.dataType))
    packed = T.StructType(
        [
            many(number),
            many(label),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("dictionary", T.BinaryType()),
            T.StructField("codes", T.BinaryType()),
        ]
    )
    chunks = written(usable.mapInArrow(_chunks(dims, factor), packed), f"{work_dir(spark, 'vectorcodes')}/chunks")
    for _ in range(rounds):
        cells = chunks.mapInArrow(_sums(books), "cell bigint, high bigint, low bigint")
        found = cells.groupBy("cell").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
        books = moved(books, {r["cell"]: (r["high"] << 32) + r["low"] for r in found})
    return chunks.mapInArrow(_coded(books), shape), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Rows with `label_error`, the sum of the errors under their label; rows without label
    are one group. Errors merge before the shuffle, and the rows are the left side of the
    join, which AQE splits where a label has very many."""
    coded = written(coded, work_dir(coded.sparkSession, "coded"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(total.cast("bigint").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
