"""Documents like a target set, by importance resampling over hashed n-grams.

Target and raw text are bags of hashed byte n-grams, each drawn from one distribution over
BUCKETS. The importance weight of a text is the ratio of its probabilities under the two,
as if it had NOMINAL n-grams, so that long and short texts compare. Adding Gumbel noise
to the log weights and keeping the largest k draws k documents without replacement in
proportion to their weights.

The raw model counts all documents. The target model counts TARGETS documents at most,
those with the least hash of their id among the target's. The k-th largest key is found
by narrowing histograms, so no task sorts all keys.

Results for odd input: a text shorter than an n-gram, or null, has log weight 0; repeated
rows of an id get equal keys; documents whose keys equal the last one drawn are all kept;
without a target every log weight is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.components import written
from tidemart.llm.words import PIECE_BYTES, text_bytes
from tidemart.session import work_dir

BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
NOMINAL = 100
TARGETS = 20_000
SMOOTHING = 1.0
BINS = 4096
SORTED_ROWS = 10_000


def gram_counts(text: np.ndarray | None) -> np.ndarray:
    """How often each bucket's n-grams occur in a text."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    longest = max(ORDERS)
    for at in range(0, 0 if text is None else len(text), PIECE_BYTES):
        # The next bytes complete the n-grams that begin in this piece.
        piece = text[at : at + PIECE_BYTES + longest - 1].astype(np.uint32)
        h = piece + np.uint32(1)
        for order in range(2, longest + 1):
            h = h[: max(len(piece) - order + 1, 0)] * np.uint32(0x01000193) ^ piece[order - 1 :]
            if order in ORDERS and len(h):
                spread = (h * np.uint32(0x9E3779B1)) >> np.uint32(16)
                out += np.bincount(spread[:PIECE_BYTES].astype(np.int64), minlength=BUCKETS)
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for text in text_bytes(batch.column("text")):
            total += gram_counts(text)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def _model(texts: DataFrame) -> np.ndarray:
    """Counts per bucket: each task sums its own, BUCKETS rows reach the driver at most."""
    sums = texts.select("text").mapInArrow(_sums, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS)
    for r in sums.toLocalIterator():
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of the ratio of the two smoothed distributions, per bucket."""
    if not target.sum():
        return np.zeros(BUCKETS)
    share = lambda n: np.log((n + SMOOTHING) / (n.sum() + SMOOTHING * BUCKETS))
    return share(target) - share(raw)


def train(docs: DataFrame, target_ids: DataFrame, targets: int = TARGETS) -> np.ndarray:
    """The log ratios of the target's documents (`doc_id`) to all documents."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    some = target_ids.select("doc_id").where("doc_id is not null").distinct()
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(targets)
    return log_ratio(_model(texts.join(F.broadcast(some), "doc_id", "left_semi")), _model(texts))


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, n_grams, log_weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights = [], []
            for text in text_bytes(batch.column("text")):
                n = gram_counts(text)
                sizes.append(int(n.sum()))
                weights.append(float(n @ shared.value) / sizes[-1] * NOMINAL if sizes[-1] else 0.0)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(weights, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_grams", "log_weight"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    out = [T.StructField("n_grams", T.LongType()), T.StructField("log_weight", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *out]))


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise that depends on key and seed alone."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(unit))


def kth_largest(rows: DataFrame, col: str, k: int) -> float | None:
    """The k-th largest value of a column of numbers; None if there are fewer rows.

    Counts per bin narrow the range until few rows are left in it, which are sorted.
    """
    ends = rows.agg(F.min(col).alias("low"), F.max(col).alias("high"), F.count(col).alias("n")).first()
    low, high = ends["low"], ends["high"]
    if k < 1 or ends["n"] < k:
        return None
    inside = rows.select(col)
    left = ends["n"]
    while left > SORTED_ROWS and low < high:
        width = (high - low) / BINS
        place = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).alias("bin")
        bins = inside.groupBy(place).agg(F.count("*").alias("n"), F.min(col).alias("a"), F.max(col).alias("b"))
        for r in bins.orderBy(F.desc("bin")).collect():  # BINS rows at most
            if k <= r["n"]:
                break
            k -= r["n"]
        if (r["a"], r["b"]) == (low, high):
            break
        low, high, left = r["a"], r["b"], r["n"]
        inside = rows.select(col).where((F.col(col) >= low) & (F.col(col) <= high))
    if low == high:
        return low
    counts = inside.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc(col)).limit(k)
    for r in counts.toLocalIterator():
        k -= r["n"]
        if k <= 0:
            return r[col]
    return low


def resample(docs: DataFrame, ratios: np.ndarray, share: float, seed: int = 7) -> DataFrame:
    """(doc_id, n_grams, log_weight, gumbel_key, kept) of every row: kept marks the draw of
    `share` of the rows."""
    keyed = weigh(docs, ratios).withColumn("gumbel_key", F.col("log_weight") + gumbel(F.col("doc_id"), seed))
    keyed = written(keyed, work_dir(docs.sparkSession, "resample"))
    least = kth_largest(keyed, "gumbel_key", round(share * keyed.count()))
    kept = F.lit(False) if least is None else F.col("gumbel_key") >= F.lit(least)
    return keyed.withColumn("kept", kept)
